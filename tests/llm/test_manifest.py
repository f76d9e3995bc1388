import hashlib
import zlib

import pytest

from strata.llm import manifest as M
from tests.llm import nasty


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    def field(c):
        v = row[c]
        if v is None:
            return "-"
        v = str(v + more if c == "n_chars" else v)
        return f"{len(v.encode())}:{v}"

    return sha("".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))


def levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, at):
    for level in tree[:-1]:
        other = at ^ 1
        yield (level[other] if other < len(level) else "", other < at)
        at //= 2


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    for k in order:
        langs[k].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {k: levels([leaf(r) for r in langs[k]]) for k in order}
    top = levels([trees[k][-1][0] for k in order])
    out = []
    for place, k in enumerate(order):
        for at, r in enumerate(langs[k]):
            way = [*siblings(trees[k], at), *siblings(top, place)]
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = leaf(r, int(tampered))
            for other, left in way:
                folded = sha(other + folded if left else folded + other)
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r), trees[k][-1][0], root, sha("".join(h for h, _ in way)), folded, folded == root))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, M.manifest_digests(df).collect()), key=str)


@pytest.mark.parametrize("height", [1, 4])
def test_awkward_rows_equal_brute_force_at_any_height(spark, monkeypatch, height):
    monkeypatch.setattr(M, "HEIGHT", height)  # 18 rows in 3 languages: 1 to 5 tiers
    docs = nasty.docs(spark)
    assert got(docs) == brute([r.asDict() for r in docs.collect()])


def test_many_languages_and_a_hot_one_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(M, "HEIGHT", 2)
    monkeypatch.setattr(M, "RANGE_ROWS", 10)
    rows = [(k % 5 if k % 3 else 7, f"text {k % 50}", None if k % 3 == 0 else f"l{k % 11}", "s", k) for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert got(df) == brute([r.asDict() for r in df.collect()])


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(1, "a", "en", "x", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    [row] = M.manifest_digests(df).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == sha("")
    assert M.manifest_digests(nasty.empty(spark)).count() == 0


def test_only_tampered_rows_fail(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = M.manifest_digests(docs).collect()
    assert len({r.root for r in rows}) == 1
    for r in rows:
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)
    assert 0 < sum(not r.verified for r in rows) < len(rows) / 3


def test_proofs_are_steps_that_fold_to_the_root(spark):
    docs = nasty.docs(spark)
    for r in M.manifest(docs).filter("folded = root").collect():
        own = r.leaf.hex()
        for s in r.proof:
            other = s.hash.hex() if s.hash is not None else ""
            own = sha(other + own if s.left else own + other)
        assert own == r.root.hex()


def test_the_limit_on_rows_is_put_back(spark):
    before = spark.conf.get(M.ROW_LIMIT)
    with pytest.raises(ZeroDivisionError), M._any_number_of_rows(spark):
        assert spark.conf.get(M.ROW_LIMIT) == "-1"
        raise ZeroDivisionError
    assert spark.conf.get(M.ROW_LIMIT) == before
