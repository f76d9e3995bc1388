from strata.llm import mixing as mx
from tests.llm import nasty


def brute_targets(sizes):
    """Shares by weight; what exceeds twice a source is shared again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mx.WEIGHTS[k % 3] for k, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] >= 2 * sizes[s]}
        if not over:
            return target | {s: unit * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def check(rows, got):
    sizes = {}
    for _, text, _, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    want, taken = brute_targets(sizes), {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * (1 + r.target)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(int(want[s] + 1e-6) - 1 <= taken[s] <= want[s] + 1e-6 for s in sizes)
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)


def with_sizes(df):
    return df.select("doc_id", "source", mx.n_words(df.text).alias("size"))


def test_budgets_are_met_exactly_and_reruns_agree(spark):
    rows = nasty.rows()
    once = mx.mix(with_sizes(nasty.docs(spark))).collect()
    check(rows, once)
    again = mx.mix(with_sizes(nasty.docs(spark).repartition(7))).collect()
    key = lambda x: sorted(map(repr, ((r.doc_id, r.size, r.taken) for r in x)))
    assert key(once) == key(again)
    assert mx.mix(with_sizes(nasty.empty(spark))).count() == 0


def test_a_hot_source_and_many_small_ones(spark):
    rows = [(k, "w " * (k % 7), None, "hot" if k % 3 else f"s{k % 40}") for k in range(1500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    check(rows, mx.mix(with_sizes(df)).collect())


def test_mixed_documents_hold_the_words_that_were_taken(spark):
    df = nasty.docs(spark)
    plan = mx.mix(with_sizes(df)).collect()
    out = mx.mixed_documents(df)
    assert out.columns == df.columns
    words = lambda t: len((t or "").encode().split())
    got = out.collect()
    assert sum(words(r.text) for r in got) == sum(r.taken for r in plan)
    assert all(r.n_chars == len(r.text) for r in got)
    whole = {t for _, t, *_ in nasty.rows() if t}
    cut = [r.text for r in got if r.text not in whole]
    assert len(cut) <= 5 and all(any(t.startswith(c) for t in whole) for c in cut)  # one a source at most
    assert mx.mixed_documents(nasty.empty(spark)).count() == 0
