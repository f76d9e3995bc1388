"""A named run that failed is taken up where it stopped; layout for point reads."""

import os

import pytest
from pyspark.sql import functions as F

from strata.__main__ import main
from strata.config import GOLD, SILVER, LakePaths
from strata.plans import gold, stages
from strata.plans.ledger import Ledger
from strata.session import scratch_path
from strata.sinks import save_clustered, save_csv
from strata.sources import roles


def parts(paths):
    """Names of all Parquet files by output; every write gives its files new names."""
    places = {("silver", k): paths.silver(k) for k in SILVER} | {("gold", k): paths.gold(k) for k in GOLD}
    places |= {("bronze", n): paths.bronze(n) for n in roles.BUILDERS}
    found = {}
    for key, place in places.items():
        folder = place.removeprefix("file:")
        found[key] = sorted(n for n in os.listdir(folder) if n.endswith(".parquet")) if os.path.isdir(folder) else None
    return found


def landed(spark, sf):
    paths = LakePaths.under(scratch_path(spark, "ledger"))
    t = roles.Tables(spark, sf)
    for name, build in roles.BUILDERS.items():
        save_csv(build(t), f"{paths.csv_root}/{name}.csv")
    return paths


def test_a_rerun_makes_only_what_is_missing(spark, sf_small, monkeypatch):
    paths = landed(spark, sf_small)
    whole = gold.participation_mart

    def fails(*args, **kwargs):
        bad = F.raise_error(F.lit("lost")).cast("int")
        return whole(*args, **kwargs).withColumn("lost", bad)

    monkeypatch.setattr(gold, "participation_mart", fails)
    with pytest.raises(Exception, match="lost"):
        stages.run_stages(spark, paths, database="gold_ledger", run="load-1")
    ledger = Ledger(spark, paths.runs_root, "load-1")
    assert not ledger.is_finished("gold", "mart") and ledger.is_finished("gold", "fact")
    before = parts(paths)
    monkeypatch.setattr(gold, "participation_mart", whole)
    mart = stages.run_stages(spark, paths, database="gold_ledger", run="load-1")
    after = parts(paths)
    assert after[("gold", "mart")] and {k for k in after if after[k] != before[k]} == {("gold", "mart")}
    # a third time nothing is written; a new run writes everything, to the same result
    rows = sorted(map(repr, mart.collect()))
    lake = paths.gold_root.rsplit("/", 1)[0]
    assert main(["all", "--lake", lake, "--csv", paths.csv_root, "--database", "gold_ledger", "--run", "load-1"], spark) == 0
    assert parts(paths) == after
    again = stages.run_stages(spark, paths, database="gold_ledger", run="load-2")
    assert sorted(map(repr, again.collect())) == rows
    assert all(parts(paths)[k] != after[k] for k in after)


def test_a_table_lost_with_its_session_is_published_again(spark, sf_small):
    paths = landed(spark, sf_small)
    n = stages.run_stages(spark, paths, database="gold_lost", run="r").count()
    spark.sql("DROP TABLE gold_lost.BusinessLogic")
    assert stages.run_stages(spark, paths, database="gold_lost", run="r").count() == n
    assert spark.table("gold_lost.BusinessLogic").count() == n


def test_an_unfinished_marker_does_not_count(spark):
    root = scratch_path(spark, "marks")
    ledger = Ledger(spark, root, "r.1")
    ledger.note("silver", "fact")
    assert ledger.is_finished("silver", "fact") and not ledger.is_finished("gold", "fact")
    os.remove(f"{root}/r.1/silver/fact/_SUCCESS".removeprefix("file:"))
    assert not ledger.is_finished("silver", "fact")
    ran = []
    for job in ledger.missing("silver", {"fact": lambda: ran.append(1)}).values():
        job()
    assert ran == [1] and ledger.is_finished("silver", "fact")
    for bad in ("", "a/b", "..", "a b"):
        with pytest.raises(ValueError):
            Ledger(spark, root, bad)


def scanned_rows(df):
    """Rows that the scan of ``df`` gave to its filter."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    leaf = execution.executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_point_reads_skip_row_groups(spark):
    """Keys without order and too many for a dictionary: only the Bloom filter can tell that one is absent."""
    df = spark.range(400_000).select("id", F.xxhash64("id").alias("key"))
    absent = F.col("key") == spark.range(1).select(F.xxhash64(F.lit(-5).cast("bigint"))).first()[0]
    present = F.col("key") == df.filter("id = 77777").first().key
    plain = save_clustered(df, scratch_path(spark, "plain"), ["id"])
    bloom = save_clustered(df, scratch_path(spark, "bloom"), ["id"], ["key"])
    read = spark.read.parquet
    assert scanned_rows(read(plain).filter(absent)) == 400_000
    assert scanned_rows(read(bloom).filter(absent)) < 100_000
    assert [r.id for r in read(bloom).filter(present).collect()] == [77777]
    assert scanned_rows(read(plain).filter("id between 5 and 9")) < 100_000  # by minima and maxima
    assert read(bloom).exceptAll(df).isEmpty() and read(bloom).count() == 400_000
