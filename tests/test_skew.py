"""Skew, measured: one athlete holds a third of all fact rows; no task may receive them whole.

Shuffle records read per task come from Spark's event log of this test session.
"""

import glob
import json

import pytest
from pyspark.sql import functions as F

from strata.plans import gold, queries, silver
from strata.sources import roles

SF = "/root/testdata/sf0.01"


def shuffle_records_per_task(spark, log_dir, group):
    """Max shuffle records read by one task, over the jobs of ``group``."""
    [path] = glob.glob(f"{log_dir}/{spark.sparkContext.applicationId}*")
    stages, most = set(), 0
    with open(path, encoding="utf-8") as f:
        for line in f:
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart" and (e.get("Properties") or {}).get("spark.jobGroup.id") == group:
                stages.update(s["Stage ID"] for s in e["Stage Infos"])
            elif e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
                read = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                most = max(most, read.get("Total Records Read", 0))
    return most


def run_in_group(spark, group, df):
    # partition coalescing off: with 60k rows AQE would merge every shuffle into one task,
    # which would hide (for the control) or fake (for the mart) what the hot key does
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return df.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        sc.setJobGroup("", "")


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    """The fact as the silver stage writes it, plain and with one athlete on a third of its rows.

    Written, so that what is measured is the mart's own plan and not the joins that build the fact.
    """
    plain = queries.fact_of(roles.Tables(spark, SF))
    hot = plain.withColumn("AthleteID", F.when(F.col("ResultID") % 3 == 0, F.lit(1)).otherwise(F.col("AthleteID")))
    folder = tmp_path_factory.mktemp("facts")
    out = {}
    for name, df in (("plain", plain), ("hot", hot)):
        df.write.parquet(str(folder / name))
        out[name] = spark.read.parquet(str(folder / name))
    return out


@pytest.mark.parametrize("threshold", ["-1", "10m"], ids=["sort-merge", "broadcast"])
def test_hot_athlete_never_lands_whole_in_one_task(spark, event_log_dir, facts, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    t = roles.Tables(spark, SF)
    n, hot = facts["hot"].count(), facts["hot"].filter("AthleteID = 1").count()
    assert hot > n / 4  # the fixture really is skewed
    games, country = roles.games(t), roles.country(t)
    bio = queries.athlete_dim_of(t).select(F.col("AthleteID").alias("k"), "Height")
    most = {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for name, fact in facts.items():
            mart = gold.participation_mart(
                fact, queries.athlete_dim_of(t), silver.country_dim(country), silver.games_dim(games, country),
                silver.date_dim(games),
            )
            group = f"skew-mart-{name}-{threshold}"
            run_in_group(spark, group, mart)
            most[name] = shuffle_records_per_task(spark, event_log_dir, group)
        # control: a plain shuffled join of the raw rows gives one task the whole hot key
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for name, fact in facts.items():
            joined = fact.join(bio, F.col("AthleteID") == F.col("k"), "left")
            group = f"skew-naive-{name}-{threshold}"
            run_in_group(spark, group, joined.groupBy("CountryNOC").agg(F.avg("Height")))
            most[f"naive {name}"] = shuffle_records_per_task(spark, event_log_dir, group)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    print(f"fact rows {n}, hot athlete rows {hot}, most shuffle records read by one task: {most}")
    assert 0 < most["hot"] < hot / 2, (most, hot, n)
    # the hot athlete adds no more to any task than an even share of the rows
    assert most["hot"] <= most["plain"] + n / 8, (most, hot, n)
    assert most["naive plain"] < hot <= most["naive hot"], (most, hot, n)


def test_hot_result_id_is_collapsed_before_the_results_join(spark, event_log_dir):
    t = roles.Tables(spark, SF)
    events = roles.event_results(t).withColumn(
        "result_id", F.when(F.col("pos").cast("int") % 3 == 0, F.lit("7")).otherwise(F.col("result_id"))
    )
    hot = events.filter("result_id = '7'").count()
    assert hot > events.count() / 5
    run_in_group(spark, "skew-results", silver.results_dim(roles.results(t), events))
    most = shuffle_records_per_task(spark, event_log_dir, "skew-results")
    print(f"hot result rows {hot}, most shuffle records read by one results-dim task {most}")
    assert 0 < most < hot / 2, (most, hot)
