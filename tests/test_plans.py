"""Physical-plan checks: the plan shapes the design relies on at scale."""

import re

import pytest

from strata.plans import gold, silver
from strata.plans.oracle_sql import ORACLE
from strata.plans.queries import QUERIES
from strata.sources import roles
from tests.oracle import compare


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def no_broadcast(spark):
    """The joins as they are planned when no side is small."""
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_mart_combines_per_athlete_before_the_join(spark, sf_small):
    plan = executed(QUERIES["participation_mart"](spark, sf_small))
    sort_aggs = re.findall(r"SortAggregate\(key=\[([^\]]*)\]", plan)
    assert all("AthleteID" not in keys and "GoldMedals" not in keys for keys in sort_aggs), sort_aggs
    assert "HashAggregate(keys=[AthleteID" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", ["participation_mart", "participation_mart_unique_country", "grouped_count_nonnull"])
def test_without_broadcast_joins_the_rows_are_the_same(spark, sf_small, no_broadcast, key):
    df = QUERIES[key](spark, sf_small)
    assert "BroadcastHashJoin" not in executed(df)
    res = compare(spark, QUERIES[key], ORACLE[key], sf_small)
    assert res["values_match"], res


def test_building_the_mart_runs_no_job(spark, sf_small):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    try:
        t = roles.Tables(spark, sf_small)
        for name in ("customer", "orders", "lineitem", "nation"):
            t(name)  # opening a Parquet table reads a footer
        opened = len(tracker.getJobIdsForGroup("plan-only"))
        games, country = roles.games(t), roles.country(t)
        gold.participation_mart(
            silver.fact_table(roles.event_results(t), roles.medal_tally(t)), silver.athlete_dim(roles.athlete_bio(t)),
            silver.country_dim(country), silver.games_dim(games, country), silver.date_dim(games),
        )
        assert len(tracker.getJobIdsForGroup("plan-only")) == opened
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_scans_read_only_needed_columns(spark, sf_small):
    plan = executed(QUERIES["participation_mart"](spark, sf_small))
    for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
        assert "l_extendedprice" not in schema and "c_acctbal" not in schema and "o_totalprice" not in schema


def test_mean_imputation_has_no_cross_join(spark, sf_small):
    plan = executed(QUERIES["silver_athlete_dim"](spark, sf_small))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_keep_one_is_one_aggregation_per_key(spark, sf_small):
    plan = executed(QUERIES["keep_one_per_key"](spark, sf_small))
    # a hash distinct first: the sort-based pick sees distinct rows only
    assert plan.count("partial_min") == 1
    first = plan.rindex("Aggregate(")  # the plan prints top down: the last aggregate sees the raw rows
    assert plan[first - 4 : first] == "Hash"


def test_no_task_holds_the_distinct_and_the_sort_of_the_pick(spark, sf_small):
    lines = executed(QUERIES["keep_one_per_key"](spark, sf_small)).splitlines()
    pick = next(k for k, line in enumerate(lines) if "partial_min" in line)
    distinct = next(k for k, line in enumerate(lines) if k > pick and "HashAggregate(" in line)
    assert any("Exchange" in line for line in lines[pick:distinct]), lines[pick : distinct + 1]


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "GlobalLimit", "CollectLimit", "LocalLimit", "Sample")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_query_plan_cross_joins_udfs_or_caps_rows(spark, sf_small, key):
    plan = executed(QUERIES[key](spark, sf_small))
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, (key, found)
