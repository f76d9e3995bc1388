"""Operators: de-duplication, imputation, quality reports, joins."""

import pytest
from pyspark.sql import functions as F

from strata.operators import (
    drop_null,
    duplicate_keys,
    fill_constant,
    fill_mean,
    filter_null,
    keep_one,
    null_profile,
    row_counts,
    schema_report,
    unmatched,
)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_one_smallest_struct_nulls_first(spark):
    df = spark.createDataFrame(
        [("1", "b", "x"), ("1", "a", "z"), ("1", "a", "y"), ("2", None, "q"), ("2", "a", "p")],
        "id string, event string, other string",
    )
    got = {r.id: (r.event, r.other) for r in keep_one(df, ["id"]).collect()}
    assert got == {"1": ("a", "y"), "2": (None, "q")}
    assert keep_one(df, ["id"]).columns == df.columns


def test_keep_one_custom_order(spark):
    df = spark.createDataFrame([("1", "b", 1), ("1", "a", 2)], "id string, e string, n int")
    assert keep_one(df, ["id"], order=["n"]).collect()[0].e == "b"


def test_fill_mean_truncates_and_uses_remaining_rows(spark):
    # The mean is taken after NULL-born rows are gone; 171.5 → 171
    df = spark.createDataFrame(
        [(1, None, 300), (2, "x", 170), (3, "x", 173), (4, "x", None)], "id int, born string, h int"
    )
    kept = drop_null(df, ["born"])
    got = {r.id: r.h for r in fill_mean(kept, ["h"]).collect()}
    assert got == {2: 170, 3: 173, 4: 171}


def test_fill_mean_all_null_stays_null(spark):
    # No error, still NULL
    df = spark.createDataFrame([(1, None), (2, None)], "id int, h int")
    assert [r.h for r in fill_mean(df, ["h"]).collect()] == [None, None]


def test_fill_mean_is_lazy_scalar_subquery(spark):
    df = spark.createDataFrame([(1, None), (2, 4)], "id int, h int")
    plan = plan_text(fill_mean(df, ["h"]))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fill_constant(spark):
    df = spark.createDataFrame([(None,), ("Gold",)], "medal string")
    assert [r[0] for r in fill_constant(df, {"medal": "NoMedal"}).collect()] == ["NoMedal", "Gold"]


def test_duplicate_keys_and_null_profile(spark):
    df = spark.createDataFrame([("ROC", "a"), ("ROC", "b"), ("GRE", None)], "noc string, country string")
    assert [(r.noc, r["count"]) for r in duplicate_keys(df, ["noc"]).collect()] == [("ROC", 2)]
    prof = null_profile(df).collect()[0].asDict()
    assert prof == {"noc": 0, "country": 1}
    assert [r.noc for r in filter_null(df, "country").collect()] == ["GRE"]


def test_row_counts(spark):
    a = spark.range(3)
    b = spark.range(5)
    assert sorted(map(tuple, row_counts({"a": a, "b": b}).collect())) == [("a", 3), ("b", 5)]


def test_drop_null_reaches_parquet_scan(spark, sf_small):
    df = drop_null(spark.read.parquet(f"{sf_small}/customer.parquet"), ["c_name"])
    assert "IsNotNull(c_name)" in plan_text(df)


def test_unmatched_reports_dropped_rows(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a",)], "k string")
    assert sorted(r.v for r in unmatched(left, right, ["k"], ["k"]).collect()) == [2, 3]


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    rows = [tuple(r) for r in schema_report(spark, df).collect()]
    assert rows == [(0, "a", "int", True), (1, "b", "string", True)]


def test_fill_mean_from_another_frame(spark):
    df = spark.createDataFrame([(1, None), (2, 10)], "id int, h int")
    ref = spark.createDataFrame([(7,), (8,)], "h int")
    assert {r.id: r.h for r in fill_mean(df, ["h"], source=ref).collect()} == {1: 7, 2: 10}
