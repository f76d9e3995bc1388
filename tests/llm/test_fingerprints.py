import hashlib
import random
from collections import Counter

from strata.llm import fingerprints as fp
from tests.llm import nasty


def test_equal_roots_for_equal_texts_only():
    a = nasty.prose(1, 300)
    texts = [a, a + " ", a.replace(". ", ".\n"), "", " ", "\n", "\n\n", a[:-1]]
    prints = [fp.fingerprint(t) for t in texts]
    assert len({p.partition("|")[0] for p in prints}) == len(texts)
    assert fp.fingerprint(a) == fp.fingerprint("" + a) and fp.fingerprint(None) == fp.fingerprint("")


def test_parts_are_the_text():
    for t in (nasty.prose(3, 500), "a b  c " * 100, "x" * 300, "no end", "Is it? Yes... so!  ", " lead"):
        assert "".join(fp._parts(t)) == t


def test_edits_are_located():
    lines = [nasty.prose(k, 40) for k in range(30)]
    before, after = "\n".join(lines), "\n".join([*lines[:17], "changed entirely here", *lines[18:]])
    start = len("\n".join(lines[:17])) + 1
    spans = fp.differing(fp.fingerprint(before), fp.fingerprint(after))
    assert spans and all(start <= s and s + n <= start + len(lines[17]) for s, n in spans)
    assert fp.likeness(fp.fingerprint(before), fp.fingerprint(after)) > 0.9
    assert fp.differing(fp.fingerprint(before), fp.fingerprint(before)) == []


def brute_likeness(a, b):
    """From the texts: equal lines first, then equal parts of the other lines that have parts."""
    if a == b:
        return 1.0
    x, y = (Counter(t.split("\n")) for t in (a, b))
    both = x & y
    parts = [
        Counter(v for p in (c - both).elements() if len(p) > fp.SHORT or len(t) <= fp.SHORT_TEXT for v in fp._parts(p))
        for c, t in ((x, a), (y, b))
    ]
    common = sum(map(len, both.elements())) + sum(map(len, (parts[0] & parts[1]).elements()))
    every = len(a) - a.count("\n") + len(b) - b.count("\n")
    return 2 * common / every if every else 0.0


def variants(seed):
    """A text of several lines and an edited one."""
    rnd = random.Random(seed)
    lines = [nasty.prose(seed * 50 + k, rnd.choice([0, 1, 4, 30, 90])) for k in range(rnd.randint(1, 12))]
    lines += rnd.sample(lines, min(2, len(lines)))
    other = list(lines)
    for _ in range(rnd.randint(1, 3)):
        at = rnd.randrange(len(other))
        other[at : at + rnd.randint(0, 1)] = [nasty.prose(rnd.randrange(999), rnd.choice([1, 5, 40]))]
    if seed % 3 == 0:
        other[0] = other[0][: len(other[0]) // 2] + " something else. " + other[0][len(other[0]) // 2 :]
    return "\n".join(lines), "\n".join(other)


def test_likeness_equals_brute_force():
    for seed in range(60):
        a, b = variants(seed)
        assert abs(fp.likeness(fp.fingerprint(a), fp.fingerprint(b)) - brute_likeness(a, b)) < 1e-12
    # the same line in a short text (with parts) and in a long one (without)
    line = nasty.prose(5, 8)[:50]
    long = "\n".join([line, nasty.prose(6, 300)])
    assert abs(fp.likeness(fp.fingerprint(line), fp.fingerprint(long)) - brute_likeness(line, long)) < 1e-12
    assert fp.likeness(fp.fingerprint("\n"), fp.fingerprint("\n\n")) == 0.0


def test_what_is_outside_the_located_edits_stands_in_the_other_text():
    for seed in range(60):
        a, b = variants(seed)
        spans = fp.differing(fp.fingerprint(a), fp.fingerprint(b))
        assert all(n > 0 for _, n in spans) and spans == sorted(spans)
        assert all(s + n < t for (s, n), (t, _) in zip(spans, spans[1:]))  # joined where they touch
        lost = {k for s, n in spans for k in range(s, s + n)}
        at, theirs = 0, set(b.split("\n")) | {v for p in b.split("\n") for v in fp._parts(p)}
        for p in a.split("\n"):
            if p not in b.split("\n"):
                start = at
                for v in fp._parts(p) if len(p) > fp.SHORT or len(a) <= fp.SHORT_TEXT else [p]:
                    if not lost & set(range(start, start + len(v))):
                        assert not v or v in theirs
                    start += len(v)
            else:
                assert not lost & set(range(at, at + len(p)))
            at += len(p) + 1


def test_a_fingerprint_is_smaller_than_its_text():
    for k in range(20):
        text = "\n".join(nasty.prose(k * 9 + j, 60) for j in range(5))
        assert len(fp.fingerprint(text)) < len(text) / 2


def brute(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in ordered]
    return [(i, t or "", texts[(k + 1) % len(texts)]) for k, (i, t) in enumerate(ordered)]


def test_next_documents_and_edits_over_many_ranges(spark):
    rows = [(i * 7 - 500, nasty.prose(i, 5 + i % 40)) for i in range(300)] + [(9999, None), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r for r in fp.fingerprints(df, range_rows=20).collect()}
    assert len(got) == len(rows)
    for i, text, following in brute(rows):
        r, new = got[i], fp.edited(text, following)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert r.fingerprint == fp.fingerprint(text) and r.edited_fingerprint == fp.fingerprint(new)
        assert abs(r.near_edited - brute_likeness(text, new)) < 1e-12
        assert abs(r.near_next - brute_likeness(text, following)) < 1e-12
        assert [tuple(e) for e in r.edits] == fp.differing(r.fingerprint, r.edited_fingerprint)
        # nothing before the replaced third is lost, but for the part or line that it begins in
        assert all(s + n > len(text) - len(text) // 3 for s, n in r.edits[:1])


def test_an_id_on_a_third_of_all_rows_is_dealt_over_many_ranges(spark):
    """Its rows follow each other by hash; equal rows each get their row."""
    rows = [(i, nasty.prose(i, 12)) for i in range(300)]
    rows += [(150, f"text {k % 90}") for k in range(180)] + [(150, "the same")] * 40 + [(None, f"none {k % 30}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    hashes = dict(df.selectExpr("text", "xxhash64(text)").collect())
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]]))
    want = Counter((i, t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered))
    cuts, without_id = fp._cuts(df, 20)
    assert cuts.count(150) > 5 and without_id == 4
    found = fp.with_next(df, range_rows=20).collect()
    got = Counter()
    for r in found:
        got[(r.doc_id, r.text, r.next_text)] += r.copies
    assert got == want
    assert len(fp.fingerprints(df, range_rows=20).collect()) == len(rows)


def test_awkward_tables(spark):
    assert fp.fingerprints(nasty.empty(spark)).count() == 0
    assert fp.fingerprints(nasty.docs(spark)).count() == len(nasty.rows())
    one = fp.fingerprints(nasty.docs(spark).filter("doc_id = 7")).first()
    # a lone document is its own next one
    assert one.near_next == 1.0
    assert (one.near_edited == 1.0) == (one.edited_fingerprint == one.fingerprint) == (one.edits == [])
