import random

import pytest
from pyspark.sql import functions as F

from strata.llm import common


@pytest.mark.parametrize("hot", [1, 4, 1024])
def test_look_up_is_an_inner_join(spark, monkeypatch, hot):
    """A key on a third of all rows, keys without a match on either side, a NULL key."""
    monkeypatch.setattr(common, "HOT", hot)
    keys = ["hot"] * 300 + [f"k{k % 90}" for k in range(590)] + ["alone"] * 9 + [None]
    random.Random(3).shuffle(keys)
    rows = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "key string, n int")
    table = [(k, keys.count(k), f"of {k}") for k in {*keys} - {None, "alone"}] + [("unused", 0, "x")]
    lookup = spark.createDataFrame(table, "key string, weight bigint, value string")
    got = common.look_up(rows, lookup, "key", "weight")
    assert got.columns == ["key", "n", "value"]
    want = sorted((k, n, f"of {k}") for n, k in enumerate(keys) if k not in (None, "alone"))
    assert sorted(map(tuple, got.collect())) == want
    assert common.look_up(rows.limit(0), lookup.limit(0), "key", "weight").count() == 0


@pytest.mark.parametrize("most", [1 << 15, 1 << 28])
def test_marked_misses_no_member(spark, monkeypatch, most):
    """At its greatest size the bitmap lets more rows through, but never holds a member back."""
    monkeypatch.setattr(common, "MAX_BITS", most)
    rows = spark.range(40_000).select(F.col("id").alias("_place"), F.lit("x").alias("_BLOCK"))
    members = spark.range(0, 40_000, 8).union(spark.range(0, 40_000, 8))
    out = common.marked(rows, F.xxhash64("_place"), members, F.xxhash64("id"), "_in")
    assert out.columns == ["_place", "_BLOCK", "_in"]
    got = {r._place: r._in for r in out.collect()}
    assert len(got) == 40_000 and all(got[k] for k in range(0, 40_000, 8))
    wrong = sum(v for k, v in got.items() if k % 8)
    assert wrong < (35_000 / 5 if most == 1 << 15 else 35_000 / 12)
    assert not any(r._in for r in common.marked(rows, F.xxhash64("_place"), members.limit(0), F.xxhash64("id"), "_in").collect())
