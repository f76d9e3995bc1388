import math
import random

import numpy as np

from strata.llm import common
from strata.llm import minhash as mh
from tests.llm import nasty


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """(doc_id, size, component id) of every row, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(root(i)))) for i, (d, _) in enumerate(rows))


def edit(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


def near_rows():
    """Groups of copies and chains of edits around the threshold."""
    rows, k = [], 0
    for g in range(6):
        base = nasty.prose(100 + g, 150)
        for n in (0, 0, 1, 2, 3, 4, 5, 6, 8):
            rows.append((k, edit(base, n, k)))
            k += 1
        chain = base
        for _ in range(6):
            chain = edit(chain, 2, k)
            rows.append((k, chain))
            k += 1
    rows += [(k + i, nasty.prose(900 + i, 40)) for i in range(30)]
    random.Random(1).shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rows = near_rows() + [(r[0], r[1]) for r in nasty.rows() if r[0] not in (3, 5)]
    rows = [(None if d is None else d + 1000 * (k >= len(near_rows())), t) for k, (d, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = mh.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_rounds_and_blocks_lose_no_link(spark, monkeypatch):
    """A large family of random edits: few are like any one centre, many are linked through others."""
    base = nasty.prose(5, 120)
    rows = [(k, edit(base, 3, k)) for k in range(60)] + [(100 + k, edit(nasty.prose(6, 120), 12, k)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    monkeypatch.setattr(mh, "BLOCK", 7)  # every open bucket is cut into blocks
    monkeypatch.setattr(common, "HOT", 4)  # few keys are hot, the others meet in joins
    got = mh.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == want


def test_a_repeated_row_and_an_empty_table(spark):
    df = nasty.docs(spark)
    got = mh.near_duplicates(df).collect()
    assert len(got) == len(nasty.rows())
    three = [r for r in got if r.doc_id == 3]
    assert [r.component_id for r in three] == [1, 1] and not any(r.kept for r in three)
    assert mh.near_duplicates(nasty.empty(spark)).count() == 0


def test_one_of_each_keeps_columns_and_wordless_texts(spark):
    df = nasty.docs(spark)
    kept = mh.one_of_each(df)
    assert kept.columns == df.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    gone = {"2", "3", "9"}
    assert ids == sorted(str(r[0]) for r in nasty.rows() if str(r[0]) not in gone)
    twice = df.filter("doc_id = 1").union(df.filter("doc_id = 1"))
    assert mh.one_of_each(twice).count() == 1


def test_least_matches_prunes_at_the_chosen_miss_probability():
    r = np.random.default_rng(0)
    for n in (34, 170, mh.N_COMPARED):
        at_threshold = r.binomial(n, 0.75, 200_000)
        assert (at_threshold < mh.least_matches(n)).mean() < 1e-3
        assert mh.least_matches(n) > 0.4 * n


def test_all_looks_together_prune_less_than_the_bands_miss():
    step = np.array([math.comb(mh.BATCH, k) * 0.75**k * 0.25 ** (mh.BATCH - k) for k in range(mh.BATCH + 1)])
    alive, pruned = np.ones(1), 0.0
    for end in range(mh.BATCH, mh.N_COMPARED + 1, mh.BATCH):
        alive = np.convolve(alive, step)
        least = mh.least_matches(end)
        pruned += alive[:least].sum()
        alive[:least] = 0
    bands = (1 - 0.75**mh.ROWS) ** mh.BANDS
    assert pruned < bands < 1e-4 and bands + pruned < 1.3e-4


def test_signatures_estimate_similarity():
    a = nasty.prose(11, 400)
    for n in (5, 20, 60):
        x, y = mh.shingles(a), mh.shingles(edit(a, n, n))
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs((mh.signature(x) == mh.signature(y)).mean() - true) < 0.12
