"""Publications that never show half a table, appends that can be repeated, counts from the write itself, checked keys."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.operators.quality import require_unique
from strata.plans import gold, queries, silver
from strata.session import scratch_path
from strata.sinks import (
    append_run, compute_statistics, ensure_database, list_catalog, list_statistics, publish, publish_version, read_back, rewrite_partitions, save_counted,
    save_parquet, versions,
)
from strata.sources import roles
from strata.sources.files import read_csv_by_name


def local(path):
    return path.removeprefix("file:")


def failing(df):
    """``df``, whose write fails after some of its tasks are done."""
    bad = F.when(F.col("k") == 900, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("k"))
    return df.repartition(8, "k").withColumn("k", bad)


def ks(rows):
    return sorted(r.k for r in rows)


def test_a_publication_that_fails_half_way_leaves_the_old_table(spark):
    ensure_database(spark, "sinks_test")
    root, table = scratch_path(spark, "versions"), "sinks_test.half_way"
    publish_version(spark, spark.range(10).withColumnRenamed("id", "k"), table, root)
    with pytest.raises(Exception, match="lost"):
        publish_version(spark, failing(spark.range(1000).withColumnRenamed("id", "k")), table, root)
    assert ks(spark.table(table).collect()) == list(range(10))
    publish_version(spark, spark.range(20).withColumnRenamed("id", "k"), table, root)
    assert ks(spark.table(table).collect()) == list(range(20))


def test_a_running_reader_keeps_its_version_and_old_ones_go(spark):
    ensure_database(spark, "sinks_test")
    root, table = scratch_path(spark, "versions"), "sinks_test.readers"
    paths = [publish_version(spark, spark.range(5).withColumnRenamed("id", "k"), table, root)]
    reader = spark.table(table)  # its files are listed
    assert reader.count() == 5
    paths.append(publish_version(spark, spark.range(7).withColumnRenamed("id", "k"), table, root))
    assert ks(spark.read.parquet(paths[0]).collect()) == list(range(5))
    assert ks(spark.table(table).collect()) == list(range(7))
    paths.append(publish_version(spark, spark.range(9).selectExpr("id AS k", "'new' AS more"), table, root))
    assert spark.table(table).columns == ["k", "more"] and spark.table(table).count() == 9
    assert [v.rsplit("/", 1)[1] for v in versions(spark, root)] == [p.rsplit("/", 1)[1] for p in paths[1:]]


def test_a_managed_table_is_not_replaced(spark):
    ensure_database(spark, "sinks_test")
    root, df = scratch_path(spark, "managed"), spark.range(3).withColumnRenamed("id", "k")
    publish(spark, df, "sinks_test.owned", f"{root}/k", managed=True)
    with pytest.raises(ValueError, match="managed"):
        publish_version(spark, df, "sinks_test.owned", f"{root}/v")
    assert spark.table("sinks_test.owned").count() == 3


def test_a_repeated_run_adds_nothing(spark):
    path = scratch_path(spark, "runs")
    first, second = spark.range(10).withColumnRenamed("id", "k"), spark.range(10, 15).withColumnRenamed("id", "k")
    for run, df in (("a", first), ("b", second), ("a", first), ("b", second)):
        append_run(df, path, run)
    assert ks(spark.read.parquet(path).collect()) == list(range(15))
    append_run(first.limit(0), path, "a")
    append_run(first.filter("k < 2"), path, "a=/ é")
    assert ks(spark.read.parquet(path).filter("run_id = 'a=/ é'").collect()) == [0, 1]
    assert spark.read.parquet(path).count() == 17
    with pytest.raises(ValueError):
        append_run(first.withColumn("RUN_ID", F.lit(1)), path, "c")


def test_a_failed_append_leaves_the_run_as_it_was(spark):
    path = scratch_path(spark, "runs")
    append_run(spark.range(10).withColumnRenamed("id", "k"), path, "a")
    with pytest.raises(Exception, match="lost"):
        append_run(failing(spark.range(1000).withColumnRenamed("id", "k")), path, "a")
    assert ks(spark.read.parquet(path).collect()) == list(range(10))


def test_only_the_given_partitions_are_rewritten(spark):
    path = scratch_path(spark, "editions")
    df = spark.range(30).selectExpr("id AS k", "id % 3 AS edition")
    save_parquet(df, path, partition_by=["edition"])
    kept = {e: sorted(os.listdir(f"{local(path)}/edition={e}")) for e in (0, 1)}
    rewrite_partitions(df.filter("edition = 2 AND k > 20"), path, ["edition"])
    assert ks(spark.read.parquet(path).filter("edition = 2").collect()) == [23, 26, 29]
    assert kept == {e: sorted(os.listdir(f"{local(path)}/edition={e}")) for e in (0, 1)}


@pytest.mark.parametrize("write", [rewrite_partitions, lambda df, path, by: save_parquet(df, path, partition_by=by)])
def test_rows_that_shrink_in_a_shuffle_still_go_to_several_tasks(spark, write):
    path = scratch_path(spark, "folders")
    # 600 MB in the sort of the write, a few in the shuffle: one key, equal rows, and a folder for NULL
    df = spark.range(2_000_000).selectExpr("repeat('x', 250) AS v", "map('a', 1) AS m", "if(id < 10, NULL, 7) AS e")
    write(df, path, ["e"])
    files = {n: len([f for f in os.listdir(f"{local(path)}/{n}") if f.endswith(".parquet")]) for n in os.listdir(local(path)) if "=" in n}
    assert files["e=7"] in (2, 3, 4) and files["e=__HIVE_DEFAULT_PARTITION__"] == 1
    back = spark.read.parquet(path)
    assert back.count() == 2_000_000 and back.filter("e IS NULL").count() == 10
    assert back.select("v").distinct().count() == 1
    write(df.limit(0), f"{path}-none", ["e"])
    assert save_counted(df.limit(1000), f"{path}-counted", partition_by=["e"]) == 1000


def test_rows_counted_by_the_write_reveal_a_lost_part(spark):
    path = scratch_path(spark, "counted")
    df = spark.range(1000).repartition(4)
    rows = save_counted(df, path)
    assert rows == 1000 and read_back(spark, path, df.schema, rows).count() == 1000
    part = next(f for f in sorted(os.listdir(local(path))) if f.endswith(".parquet"))
    os.remove(f"{local(path)}/{part}")
    with pytest.raises(ValueError, match="1000 were written"):
        read_back(spark, path, df.schema, rows)
    assert save_counted(df.limit(0), scratch_path(spark, "none")) == 0


def test_catalog_listing_has_databases_without_tables(spark):
    ensure_database(spark, "sinks_empty")
    ensure_database(spark, "sinks_test")
    root = scratch_path(spark, "list")
    publish(spark, spark.range(2), "sinks_test.listed", f"{root}/a b")
    rows = {(r.database_name, r.table_name): r for r in list_catalog(spark, "sinks*").collect()}
    assert ("sinks_empty", None) in rows and not any(db == "default" for db, _ in rows)
    listed = rows["sinks_test", "listed"]
    assert (listed.table_type, listed.provider.lower()) == ("EXTERNAL", "parquet") and "a" in listed.location


def test_a_repeated_key_fails_inside_the_plan(spark, sf_small):
    t = roles.Tables(spark, sf_small)
    games, country = roles.games(t), roles.country(t)
    fact, athlete = queries.fact_of(t), queries.athlete_dim_of(t)
    dims = (silver.country_dim(country), silver.games_dim(games, country), silver.date_dim(games))
    plain = sorted(map(str, gold.participation_mart(fact, athlete, *dims).collect()))
    assert sorted(map(str, gold.participation_mart(fact, athlete, *dims, check_keys=True).collect())) == plain
    [seen] = fact.groupBy("AthleteID").count().orderBy(F.desc("count"), "AthleteID").limit(1).collect()
    twice = athlete.unionByName(athlete.filter(F.col("AthleteID") == seen.AthleteID))
    assert twice.count() == athlete.count() + 1
    assert sorted(map(str, gold.participation_mart(fact, twice, *dims).collect())) != plain  # silently wrong
    with pytest.raises(PySparkException, match="repeated key: AthleteID="):
        gold.participation_mart(fact, twice, *dims, check_keys=True).collect()


def test_require_unique_keeps_rows_and_null_keys(spark):
    rows = [(1, "a", 1.0), (2, None, 2.0), (None, "n", 3.0), (None, "n", 4.0)]
    df = spark.createDataFrame(rows, "k int, v string, `odd name` double")
    assert sorted(map(tuple, require_unique(df, ["k"]).collect()), key=str) == sorted(rows, key=str)
    with pytest.raises(PySparkException, match="repeated key: k=1, v=a"):
        require_unique(df.union(df), ["k", "v"]).collect()


def test_the_check_shares_the_join_s_exchange(spark):
    left = spark.range(1000).selectExpr("id % 7 AS k", "id AS n").hint("merge")
    right = require_unique(spark.range(7).selectExpr("id AS k", "id * 2 AS w"), ["k"]).filter("k IS NOT NULL")
    plain = spark.range(7).selectExpr("id AS k", "id * 2 AS w")
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert left.join(right, "k").count() == 1000
    assert count(left.join(right.hint("merge"), "k")) <= count(left.join(plain.hint("merge"), "k")) + 1


def test_each_join_s_drops_count_once(spark):
    stats = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), ("X", 1), ("X", 9), ("A", 9)], "CountryNOC string, EditionID int")
    country = spark.createDataFrame([("A", "a"), ("A", "again"), ("B", "b")], "noc string, country string")
    games = spark.createDataFrame([(1,), (2,)], "EditionID int")
    date = spark.createDataFrame([(1,), (9,)], "Date_id int")
    got = {r["join"]: r.dropped_rows for r in gold.dropped_keys(stats, country, games, date).collect()}
    assert got == {"mart_without_country": 2, "mart_without_edition": 1, "mart_without_date": 1}
    none = gold.dropped_keys(stats.limit(0), country, games, date).collect()
    assert [r.dropped_rows for r in none] == [0, 0, 0]


def test_headers_by_name_over_odd_file_names_and_headers(spark, tmp_path):
    root = tmp_path / "in" / "Q.csv"
    (root / "year=2020").mkdir(parents=True)
    (root / "year=2021").mkdir()
    (root / "year=2020" / "a b.csv").write_text('noc,"coun,try"\nFRA,"Fra,nce"\nnoc,"coun,try"\n')
    (root / "year=2020" / "100%é+.csv").write_text('\n\n"coun,try",noc\nItaly,ITA\n')
    (root / "year=2021" / "part#1.csv").write_text('noc,"coun,try",,x\nJPN,Japan,u,\nUSA\n')
    (root / "year=2021" / "none.csv").write_text("")
    df = read_csv_by_name(spark, str(root))
    assert sorted(df.columns) == sorted(["noc", "coun,try", "_c2", "x", "year"])
    assert all(f.dataType.simpleString() == "string" for f in df.schema)
    got = sorted(map(tuple, df.select("noc", "`coun,try`", "_c2", "x", "year").collect()), key=str)
    assert got == sorted([
        ("FRA", "Fra,nce", None, None, "2020"), ("noc", "coun,try", None, None, "2020"),  # a data row like the header stays
        ("ITA", "Italy", None, None, "2020"), ("JPN", "Japan", "u", None, "2021"), ("USA", None, None, None, "2021"),
    ], key=str)


def innermost(df):
    """Tables of the join of two that the optimized plan does first."""
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        found = {t for t in ("star_fact", "star_wide", "star_small") if t in node.toString()}
        if node.nodeName() == "Join" and len(found) == 2:
            return found
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return set()


def test_statistics_let_the_planner_order_a_star_join(spark):
    ensure_database(spark, "sinks_test")
    n = 20_000
    fact = spark.range(n).select((F.col("id") % 5000).alias("w"), (F.col("id") % 1000).alias("s"), "id")
    frames = {
        "star_fact": fact,
        "star_wide": spark.range(5000).select(F.col("id").alias("wk"), F.lit("x").alias("name")),
        "star_small": spark.range(1000).select(F.col("id").alias("sk"), (F.col("id") % 500).alias("kind")),
    }
    for name, df in frames.items():
        publish(spark, df, f"sinks_test.{name}", scratch_path(spark, name))
    query = """SELECT f.id, name FROM sinks_test.star_fact f JOIN sinks_test.star_wide ON w = wk
        JOIN sinks_test.star_small ON s = sk WHERE kind = 7"""
    conf = ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled")
    for c in conf:
        spark.conf.set(c, "true")
    try:
        before = spark.sql(query)
        assert innermost(before) == {"star_fact", "star_wide"}  # as written
        rows = sorted(map(tuple, before.collect()))
        for name in frames:
            compute_statistics(spark, f"sinks_test.{name}")
        after = spark.sql(query)
        assert innermost(after) == {"star_fact", "star_small"}  # the filtered dimension first
        assert sorted(map(tuple, after.collect())) == rows and len(rows) == n // 500
    finally:
        for c in conf:
            spark.conf.unset(c)


def test_a_new_publication_drops_old_statistics(spark):
    ensure_database(spark, "sinks_test")
    table, root = "sinks_test.stale", scratch_path(spark, "stale")
    for first in (0, 100):
        publish_version(spark, spark.range(first, first + 10).withColumnRenamed("id", "k"), table, root)
        assert [tuple(r) for r in list_statistics(spark, table).collect()] == [("k", "bigint", None, None, None)]
        compute_statistics(spark, table, ["k"])
        want = ("k", "bigint", str(first), str(first + 9), 0)
        assert [tuple(r) for r in list_statistics(spark, table).collect()] == [want]
