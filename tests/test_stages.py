"""Sources, sinks, the staged lake and the streaming landing, in fresh scratch folders."""

import os

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.config import DATASETS, GOLD, LakePaths, bronze_name
from strata.plans import stages
from strata.session import scratch_path
from strata.sinks import external_table, list_statistics, list_tables, publish, read_back, save_csv
from strata.sources import list_entries, read_csv_by_name, read_csv_strings
from strata.sources import roles
from strata.streaming import land_available


def local(path: str) -> str:
    return path.replace("file:", "", 1) if path.startswith("file:") else path


def test_layer_naming_rule():
    assert bronze_name("Olympics_Games.csv") == "Olympics_Games_parquet"
    paths = LakePaths.under("hdfs://nn/data")
    assert paths.bronze("Olympics_Games") == "hdfs://nn/data/bronze/Olympics_Games_parquet"
    assert paths.gold("mart") == "hdfs://nn/data/gold/BusinessLogic_Parquet"
    env = LakePaths.from_env({"STRATA_LAKE_ROOT": "s3a://b/lake", "STRATA_CSV_ROOT": "s3a://b/in"})
    assert env.csv_root == "s3a://b/in" and env.silver("fact") == "s3a://b/lake/silver/Fact_Table_parquet"


def test_missing_input_folder_fails_fast(spark):
    with pytest.raises(FileNotFoundError):
        list_entries(spark, scratch_path(spark, "absent"))


def test_csv_file_read_as_strings_with_defaults(spark):
    root = local(scratch_path(spark, "csv"))
    os.makedirs(root)
    with open(f"{root}/Olympics_Country.csv", "w", encoding="utf-8", newline="") as f:
        f.write('noc,country,extra\r\nAFG,Afghanistan,1\r\nBAH,"Bahamas, The",\r\nROC, ROC team,2\r\n')
    df = read_csv_strings(spark, f"{root}/Olympics_Country.csv")
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(c, StringType()) for c in ("noc", "country", "extra")]
    rows = [tuple(r) for r in df.collect()]
    assert rows == [("AFG", "Afghanistan", "1"), ("BAH", "Bahamas, The", None), ("ROC", " ROC team", "2")]
    assert list_entries(spark, root) == {"Olympics_Country.csv": False}


def test_lake_end_to_end_and_catalog(spark, sf_small):
    paths = LakePaths.under(scratch_path(spark, "lake-test"))
    t = roles.Tables(spark, sf_small)
    for name, build in roles.BUILDERS.items():
        save_csv(build(t), f"{paths.csv_root}/{name}.csv")
    mart = stages.run_stages(spark, paths, database="gold_test")
    assert mart.count() > 0
    tables = {r.tableName.lower() for r in list_tables(spark, "gold_test").collect()}
    assert {GOLD[k][0].lower() for k in GOLD} <= tables
    # the catalog table and the Parquet files hold the same rows (written once)
    assert spark.table("gold_test.BusinessLogic").count() == mart.count()
    # bronze kept every column as a string, including the leading blank of a date
    games = spark.read.parquet(paths.bronze("Olympics_Games"))
    assert all(isinstance(f.dataType, StringType) for f in games.schema.fields)
    assert games.filter("start_date LIKE ' %'").count() > 0
    # K7: a typed external table over the written mart, counts declared BIGINT
    ext = external_table(spark, "gold_test.BusinessLogic_ext", paths.gold("mart"), mart.schema)
    assert ext.count() == mart.count()
    # K8: read-back with the expected schema passes, a wrong one raises
    read_back(spark, paths.gold("mart"), mart.schema)
    wrong = StructType([StructField("EditionID", LongType())])
    with pytest.raises(ValueError):
        read_back(spark, paths.gold("mart"), wrong)


def test_publish_managed_copy(spark):
    root = scratch_path(spark, "pub")
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    df = spark.range(5).withColumnRenamed("id", "k")
    back = publish(spark, df, "gold_test.managed_k", f"{root}/k", managed=True)
    assert back.count() == 5 and spark.table("gold_test.managed_k").count() == 5


def test_stream_lands_each_file_once(spark, sf_small):
    root = scratch_path(spark, "stream-test")
    cols = DATASETS["Olympic_Games_Medal_Tally"]
    tally = roles.medal_tally(roles.Tables(spark, sf_small))
    n = tally.count()
    save_csv(tally, f"{root}/in")
    landed = land_available(spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt", cols)
    assert spark.read.parquet(landed).count() == n
    # nothing new: a second run lands nothing twice
    land_available(spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt", cols)
    assert spark.read.parquet(landed).count() == n
    # new part files appended to the watched folder are landed, and only they
    save_csv(tally.filter("country_noc = 'NATION_3'"), f"{root}/in", mode="append")
    land_available(spark, f"{root}/in", f"{root}/bronze", f"{root}/ckpt", cols)
    extra = tally.filter("country_noc = 'NATION_3'").count()
    assert extra > 0 and spark.read.parquet(landed).count() == n + extra


def test_rerun_is_idempotent_and_partitioned_fact_prunes(spark, sf_small):
    paths = LakePaths.under(scratch_path(spark, "rerun"))
    t = roles.Tables(spark, sf_small)
    for name, build in roles.BUILDERS.items():
        save_csv(build(t), f"{paths.csv_root}/{name}.csv")
    first = sorted(map(tuple, stages.run_stages(spark, paths, database="gold_rerun").collect()))
    again = stages.run_stages(spark, paths, database="gold_rerun", fact_partition_by=("EditionID",), statistics=True)
    assert sorted(map(tuple, again.collect())) == first
    known = {r.column_name: r.n_null for r in list_statistics(spark, "gold_rerun.Olympics_Fact").collect()}
    assert known["EditionID"] == 0 and None not in known.values()
    fact = spark.table("gold_rerun.Olympics_Fact")
    one = fact.filter("EditionID = 3")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(EditionID" in plan and "(EditionID" in plan
    assert one.count() == spark.read.parquet(paths.gold("fact")).filter("EditionID = 3").count() > 0


def test_cli_runs_each_stage_and_fails_cleanly(spark, sf_small, capsys):
    from strata.__main__ import main

    lake = scratch_path(spark, "cli")
    csv_root = f"{lake}/csv"
    t = roles.Tables(spark, sf_small)
    for name, build in roles.BUILDERS.items():
        save_csv(build(t), f"{csv_root}/{name}.csv")
    for stage in ("bronze", "silver", "gold"):
        assert main([stage, "--lake", lake, "--csv", csv_root, "--database", "gold_cli"], spark=spark) == 0
    assert spark.table("gold_cli.BusinessLogic").count() > 0
    missing = scratch_path(spark, "cli-missing")
    assert main(["bronze", "--lake", missing, "--csv", f"{missing}/nothing"], spark=spark) == 1
    assert "FileNotFoundError" in capsys.readouterr().err


def test_csv_datasets_with_relative_root(spark, tmp_path):
    (tmp_path / "in" / "B.csv").mkdir(parents=True)
    (tmp_path / "in" / "A.csv").write_text("a\n1\n")
    (tmp_path / "in" / "B.csv" / "part-0.csv").write_text("b\n2\n")
    (tmp_path / "in" / "notes.txt").write_text("x")
    # relative to the working directory the JVM was started in (the test process's)
    found = stages.csv_datasets(spark, os.path.relpath(tmp_path / "in"))
    assert sorted(found) == ["A", "B"]
    assert read_csv_strings(spark, found["B"]).collect()[0].b == "2"


def test_external_table_from_ddl_text(spark):
    root = scratch_path(spark, "ddl")
    df = spark.createDataFrame([(1, 5)], "EditionID int, TotalAthletes bigint")
    from strata.sinks import save_parquet

    save_parquet(df, root)
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    t = external_table(spark, "gold_test.ddl_typed", root, "EditionID INT, TotalAthletes BIGINT")
    assert [tuple(r) for r in t.collect()] == [(1, 5)]


def test_fact_stream_appends_only_new_bronze_files(spark, sf_small):
    from strata.plans import silver
    from strata.sinks import save_parquet
    from strata.streaming import read_fact, update_fact

    root = scratch_path(spark, "fact-stream-test")
    t = roles.Tables(spark, sf_small)
    events, tally = roles.event_results(t), roles.medal_tally(t)
    early = events.filter("edition_id IN ('1', '2', '3')")
    late = events.filter("edition_id NOT IN ('1', '2', '3')")
    save_parquet(early, f"{root}/bronze")
    parts = (f"{root}/bronze", f"{root}/fact", f"{root}/ckpt")

    def update(tally):
        update_fact(spark, parts[0], lambda: tally, *parts[1:])
        return read_fact(spark, *parts[1:])

    assert update(tally).count() == silver.fact_table(early, tally).count() > 0
    save_parquet(late, f"{root}/bronze", mode="append")
    some = tally.filter("edition_id <= '4'")
    assert update(some).count() < silver.fact_table(events, tally).count()  # the rest is parked
    update(tally)  # no new events, but their tally came
    fact = update(tally)  # nothing new: no change
    got = sorted(map(tuple, fact.collect()), key=repr)
    want = sorted(map(tuple, silver.fact_table(events, tally).collect()), key=repr)
    assert got == want


GAMES_CSV = (
    "edition,edition_id,edition_url,year,city,country_flag_url,country_noc,start_date,end_date,competition_date,isHeld\r\n"
    "1896 Summer Olympics,1,/editions/1,1896,Athina,GRE.png,GRE, 6 April,15 April,6 – 13 April,\r\n"
    "1900 Summer Olympics,2,/editions/2,1900,Paris,FRA.png,FRA,,,14 May – 28 October,\r\n"
    "1904 Summer Olympics,3,/editions/3,1904,St. Louis,USA.png,USA,14 May,, 1 July – 26 November,\r\n"
    "1906 Intercalated,4,/editions/4,1906,Athina,GRE.png,GRE,22 April, 2 May,22 April –  2 May,\r\n"
    "1956 Equestrian,48,/editions/48,1956,Stockholm,SWE.png,SWE,10 June,17 June,11 – 17 June,\r\n"
    "2020 Summer Olympics,61,/editions/61,2020,Tokyo,JPN.png,JPN,23 July 2021, 8 August 2021,21 July –  8 August 2021,\r\n"
)
COUNTRY_CSV = 'noc,country\r\nGRE,Greece\r\nROC,ROC\r\nKOR,"Korea, South"\r\nROC,Russian Olympic Committee\r\n'


def test_shipped_shapes_through_bronze_and_silver(spark):
    # a re-typed sample of the two shipped CSV shapes (CRLF, quoted comma, leading blanks, empty dates)
    paths = LakePaths.under(scratch_path(spark, "shipped"))
    os.makedirs(local(paths.csv_root))
    with open(f"{local(paths.csv_root)}/Olympics_Games.csv", "w", encoding="utf-8", newline="") as f:
        f.write(GAMES_CSV)
    with open(f"{local(paths.csv_root)}/Olympics_Country.csv", "w", encoding="utf-8", newline="") as f:
        f.write(COUNTRY_CSV)
    stages.land_bronze(spark, paths)
    games = spark.read.parquet(paths.bronze("Olympics_Games"))
    country = spark.read.parquet(paths.bronze("Olympics_Country"))
    from strata.operators import duplicate_keys
    from strata.plans import silver

    dates = {r.Date_id: tuple(r)[1:] for r in silver.date_dim(games).collect()}
    assert dates[1] == (1896, 6, 4, 15, 4)
    assert dates[2] == (1900, None, None, None, None)
    assert dates[3] == (1904, 14, 5, None, None)
    assert dates[4] == (1906, 22, 4, 2, 5)
    assert dates[61] == (2020, 23, 7, 8, 8)
    hosts = {r.EditionID: r.HostCountry for r in silver.games_dim(games, country).collect()}
    assert hosts == {1: "Greece", 2: None, 3: None, 4: "Greece", 48: None, 61: None}
    assert [(r.noc, r["count"]) for r in duplicate_keys(country, ["noc"]).collect()] == [("ROC", 2)]
    assert country.filter("noc = 'KOR'").collect()[0].country == "Korea, South"


def test_external_table_declared_narrower_than_the_files_fails(spark):
    # Counts are BIGINT in the files; declaring INT is a read error, not a silent cast
    import pyspark.errors

    root = scratch_path(spark, "t12")
    from strata.sinks import save_parquet

    save_parquet(spark.createDataFrame([(1, 5)], "EditionID int, TotalAthletes bigint"), root)
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    t = external_table(spark, "gold_test.t12_narrow", root, "EditionID INT, TotalAthletes INT")
    with pytest.raises((pyspark.errors.PySparkException, Exception)):
        t.collect()


def test_publish_managed_and_partitioned(spark):
    root = scratch_path(spark, "pub-part")
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "EditionID int, v string")
    publish(spark, df, "gold_test.managed_parts", f"{root}/p", managed=True, partition_by=("EditionID",))
    t = spark.table("gold_test.managed_parts")
    assert sorted((r.EditionID, r.v) for r in t.collect()) == [(1, "a"), (2, "b"), (2, "c")]
    assert "EditionID" in [c.name for c in spark.catalog.listColumns("gold_test.managed_parts") if c.isPartition]


def test_parts_under_any_name_and_headers_by_name(spark, tmp_path):
    import gzip

    root = tmp_path / "in"
    (root / "G.csv").mkdir(parents=True)
    (root / "Q.csv").mkdir()
    (root / "P.csv" / "year=2020").mkdir(parents=True)
    (root / "notes.txt").write_text("x")
    with gzip.open(root / "G.csv" / "part-0.csv.gz", "wt") as f:
        f.write("noc,country\nGRE,Greece\n")
    (root / "Q.csv" / "part-0").write_text("noc,country\nFRA,France\n")
    (root / "Q.csv" / "part-1").write_text("country,noc\nItaly,ITA\n")
    (root / "Q.csv" / "part-2").write_text("noc,country,continent\nJPN,Japan,Asia\n")
    (root / "P.csv" / "year=2020" / "part-0.csv").write_text("noc\nUSA\n")
    paths = LakePaths.under(str(tmp_path / "lake"), str(root))
    assert sorted(stages.csv_datasets(spark, paths.csv_root)) == ["G", "P", "Q"]
    landed = stages.land_bronze(spark, paths)
    rows = lambda k, *c: sorted(map(tuple, spark.read.parquet(landed[k]).select(*c).collect()), key=repr)
    assert rows("G", "noc", "country") == [("GRE", "Greece")]
    assert rows("P", "noc", "year") == [("USA", "2020")]
    assert rows("Q", "noc", "country", "continent") == [
        ("FRA", "France", None), ("ITA", "Italy", None), ("JPN", "Japan", "Asia")
    ]
    assert all(isinstance(f.dataType, StringType) for f in spark.read.parquet(landed["P"]).schema.fields)
    assert read_csv_by_name(spark, f"{root}/Q.csv").count() == 3


def test_stream_keeps_extra_columns_and_refuses_other_headers(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("noc,country,continent\nJPN,Japan,Asia\n")
    where = (str(source), str(tmp_path / "bronze"), str(tmp_path / "ckpt"))
    landed = land_available(spark, *where, ["noc", "country"])
    assert [tuple(r) for r in spark.read.parquet(landed).collect()] == [("JPN", "Japan", "Asia")]
    with pytest.raises(ValueError, match="missing"):
        land_available(spark, *where, ["noc", "city"])
    (source / "b.csv").write_text("country,noc,continent\nItaly,ITA,Europe\n")
    with pytest.raises(Exception):
        land_available(spark, str(source), str(tmp_path / "bronze2"), str(tmp_path / "ckpt2"))


def test_no_key_and_no_publication_drops_a_callers_table(spark, sf_small):
    from strata.plans.queries import QUERIES

    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    spark.sql("DROP TABLE IF EXISTS gold.Athlete_Dim")
    spark.range(3).write.saveAsTable("gold.Athlete_Dim")
    for key in ("publish_round_trip", "publish_managed", "external_typed_table", "list_gold_tables"):
        assert QUERIES[key](spark, sf_small).count() > 0
    assert spark.table("gold.Athlete_Dim").count() == 3
    with pytest.raises(ValueError, match="managed"):
        publish(spark, spark.range(5), "gold.Athlete_Dim", f"{scratch_path(spark, 'refused')}/x")
    assert spark.table("gold.Athlete_Dim").count() == 3
    # an external table is pointed at the new files
    for n in (4, 6):
        publish(spark, spark.range(n), "gold.moving", f"{scratch_path(spark, 'moving')}/x")
        assert spark.table("gold.moving").count() == n


def test_scratch_needs_a_shared_folder_outside_local_mode():
    from strata import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(Session(), "x")
