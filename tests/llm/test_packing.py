import random
import zlib

import numpy as np
import pytest

from strata.llm import packing as pk
from tests.llm import nasty


def pieces_of(text):
    from tokenizers import Tokenizer
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [*t.encode(text or "", add_special_tokens=False).ids, pk.END]
    out, start = [], 0
    first = len(ids) % 1024 or 1024
    for end in range(first, len(ids) + 1, 1024):
        out.append((start, end - start, zlib.crc32(np.array(ids[start:end], dtype="<u4").tobytes())))
        start = end
    return out


def check(rows, texts):
    """The contract, against the reference tokenizer."""
    want = sorted((str(i), k, *p) for i, t in texts for k, p in enumerate(pieces_of(t)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(by)


def test_packing_of_awkward_texts(spark):
    df = nasty.docs(spark)
    rows = pk.pack_documents(df).collect()
    check(rows, [(r[0], r[1]) for r in nasty.rows()])
    assert pk.pack_documents(nasty.empty(spark)).count() == 0


def test_ids_equal_the_reference_tokenizer(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    odd = [(10_000 + k, t) for k, t in enumerate(["don't we'll I'd", "a  b\t\tc\n\n d ", "<|endoftext|>", "x" * 3000, "  é́ 漢字"])]
    df = docs.union(spark.createDataFrame(odd, "doc_id bigint, text string"))
    bins = check(pk.pack_documents(df, group_rows=40).collect(), [tuple(r) for r in df.collect()])
    lengths = np.array([p[1] for r in df.collect() for p in pieces_of(r.text)])
    assert pk.lower_bound(lengths) <= bins
    whole = {r.sequence_id for r in pk.pack_documents(df).collect()}
    assert len(whole) <= 1.02 * pk.lower_bound(lengths) + 1


def optimum(sizes, capacity):
    """Fewest bins, by search."""
    best = len(sizes)

    def place(i, free):
        nonlocal best
        if len(free) >= best:
            return
        if i == len(sizes):
            best = len(free)
            return
        for k in sorted({f: k for k, f in enumerate(free) if f >= sizes[i]}.values()):
            place(i + 1, [*free[:k], free[k] - sizes[i], *free[k + 1 :]])
        place(i + 1, [*free, capacity - sizes[i]])

    place(0, [])
    return best


def test_bounds_never_exceed_the_optimum():
    r = random.Random(3)
    tight = 0
    for _ in range(150):
        sizes = sorted((r.randint(1, 60) for _ in range(r.randint(1, 9))), reverse=True)
        bins, offsets, free = pk.best_fit_decreasing(np.array(sizes), 60)
        best, bound = optimum(sizes, 60), pk.lower_bound(np.array(sizes), 60)
        assert bound <= best <= len(free)
        tight += bound == best
        assert all(f == 60 - sum(s for s, b in zip(sizes, bins) if b == k) for k, f in enumerate(free))
    assert tight > 130


@pytest.mark.parametrize("rows", [200, 10_000])
def test_exchange_saves_bins_and_certificates_hold(spark, rows):
    r = random.Random(7)
    items = [(k, r.randint(200, 700)) for k in range(1500)]
    df = spark.createDataFrame(items, "row bigint, length bigint")
    out = pk.placed(df, 1024, rows).collect()
    assert sorted(x.row for x in out) == list(range(1500))
    bins = len({x.sequence_id for x in out})
    first = pk._pack(df, 1500, 0, 1024, rows).select("sequence_id").distinct().count()
    assert pk.lower_bound(np.array([n for _, n in items])) <= bins <= first


def test_added_tokens_have_the_contracts_ids():
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    with open(path, "rb") as f:
        added = [a["content"] for a in json.load(f)["added_tokens"]]
    assert added
    texts = [x for a in added for x in (a, f"a {a} b", f"{a}{a}", f"x{a}y", f" {a}\n{a} ", f"{a[:-1]} {a[1:]}", f"é{a}漢  {a}  end.")]
    for x in texts:
        assert list(pk.token_ids(x)) == [*t.encode(x, add_special_tokens=False).ids, pk.END], x
    assert any(t.token_to_id(added[0]) in pk.token_ids(x) for x in texts)
