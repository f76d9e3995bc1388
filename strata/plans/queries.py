"""Query catalogue: each key builds one operator or layer over the test tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables in ``sf_dir`` (through the bronze roles of ``strata.sources.roles``).
The SQL twin of each key is in ``strata.plans.oracle_sql``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import sinks, streaming
from strata.config import DATASETS, GOLD, GOLD_DATABASE, LakePaths
from strata.functions import columns as X
from strata.operators import dedupe, impute, quality
from strata.plans import gold, silver, stages
from strata.session import scratch_path
from strata.sources import roles
from strata.sources.files import list_entries, load_parquet, rename

Query = Callable[[SparkSession, str], DataFrame]


# --- layers -------------------------------------------------------------------


def _tables(spark: SparkSession, d: str) -> roles.Tables:
    return roles.Tables(spark, d)


def athlete_dim_of(t: roles.Tables) -> DataFrame:
    return silver.athlete_dim(roles.athlete_bio(t))


def fact_of(t: roles.Tables) -> DataFrame:
    return silver.fact_table(roles.event_results(t), roles.medal_tally(t))


def silver_athlete_dim(spark: SparkSession, d: str) -> DataFrame:
    return athlete_dim_of(_tables(spark, d))


def silver_games_dim(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    return silver.games_dim(roles.games(t), roles.country(t))


def silver_results_dim(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    return silver.results_dim(roles.results(t), roles.event_results(t))


def silver_country_dim(spark: SparkSession, d: str) -> DataFrame:
    return silver.country_dim(roles.country(_tables(spark, d)))


def silver_date_dim(spark: SparkSession, d: str) -> DataFrame:
    return silver.date_dim(roles.games(_tables(spark, d)))


def silver_fact(spark: SparkSession, d: str) -> DataFrame:
    return fact_of(_tables(spark, d))


def gold_fact_with_date(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    return gold.fact_with_date(fact_of(t), silver.date_dim(roles.games(t)))


def participation_mart(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    games, country = roles.games(t), roles.country(t)
    return gold.participation_mart(
        fact_of(t),
        athlete_dim_of(t),
        silver.country_dim(country),
        silver.games_dim(games, country),
        silver.date_dim(games),
    )


def participation_mart_unique_country(spark: SparkSession, d: str) -> DataFrame:
    """P14 with T3's option: one row per country code (the smallest name) instead of the fan-out."""
    t = _tables(spark, d)
    games, country = roles.games(t), roles.country(t)
    return gold.participation_mart(
        fact_of(t),
        athlete_dim_of(t),
        silver.country_dim(country),
        silver.games_dim(games, country),
        silver.date_dim(games),
        dedupe_country=True,
    )


# --- single operators ----------------------------------------------------------


def cast_int_lenient(spark: SparkSession, d: str) -> DataFrame:
    """Bronze text → int with the non-ANSI cast result."""
    bio = roles.athlete_bio(_tables(spark, d))
    return bio.select(
        "athlete_id",
        "height",
        "weight",
        X.to_int_lenient("athlete_id").alias("athlete_id_int"),
        X.to_int_lenient("height").alias("height_int"),
        X.to_int_lenient("weight").alias("weight_int"),
    )


def cast_boolean(spark: SparkSession, d: str) -> DataFrame:
    """Text → boolean."""
    ev = roles.event_results(_tables(spark, d))
    return ev.select("result_id", "pos", "isTeamSport", X.to_bool("isTeamSport").alias("is_team_sport"))


def parse_text_date(spark: SparkSession, d: str) -> DataFrame:
    """First ``d Month yyyy`` inside free text, parsed; NULL when absent or invalid."""
    res = roles.results(_tables(spark, d))
    return res.select(
        "result_id",
        "result_date",
        X.extract_date_text("result_date").alias("date_text"),
        X.parse_text_date("result_date").alias("result_day"),
    )


def year_less_day_month(spark: SparkSession, d: str) -> DataFrame:
    """Trimmed year-less dates, day and month."""
    games = roles.games(_tables(spark, d))
    start, end = X.parse_day_month("start_date"), X.parse_day_month("end_date")
    return games.select(
        "edition_id",
        "start_date",
        "end_date",
        F.trim("start_date").alias("start_trimmed"),
        start.alias("start_day"),
        end.alias("end_day"),
        F.dayofmonth(start).alias("start_dom"),
        F.month(start).alias("start_month"),
        F.dayofmonth(end).alias("end_dom"),
        F.month(end).alias("end_month"),
    )


def sex_flag(spark: SparkSession, d: str) -> DataFrame:
    """1 for 'Male', 0 for anything else including NULL."""
    bio = roles.athlete_bio(_tables(spark, d))
    return bio.select("athlete_id", "sex", X.male_flag("sex").alias("sex_flag"))


def filter_numeric_id(spark: SparkSession, d: str) -> DataFrame:
    """Keep rows whose id is all digits (NULL ids are dropped)."""
    res = roles.results(_tables(spark, d))
    return res.filter(F.col("result_id").rlike(silver.NUMERIC_ID)).select("result_id", "edition_id", "sport")


def drop_null_subset(spark: SparkSession, d: str) -> DataFrame:
    """drop rows with a NULL birth text."""
    bio = roles.athlete_bio(_tables(spark, d))
    return quality.drop_null(bio, ["born"]).select("athlete_id", "born")


def select_is_null(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose birth text is NULL."""
    bio = roles.athlete_bio(_tables(spark, d))
    return quality.filter_null(bio, "born").select("athlete_id", "name", X.is_null_flag("born").alias("born_missing"))


def drop_and_rename(spark: SparkSession, d: str) -> DataFrame:
    """Replace columns in place, drop three, rename one."""
    bio = roles.athlete_bio(_tables(spark, d))
    typed = bio.withColumns({"athlete_id": X.to_int_lenient("athlete_id"), "sex": X.male_flag("sex")})
    dropped = typed.drop("country_noc", "description", "special_notes")
    return dropped.withColumnRenamed("country", "Nationality")


def distinct_projection(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (result, team flag, event) rows."""
    ev = roles.event_results(_tables(spark, d))
    return dedupe.distinct_rows(ev, ["result_id", "isTeamSport", "event"])


def keep_one_per_key(spark: SparkSession, d: str) -> DataFrame:
    """One (team flag, event) per result id, smallest first."""
    return silver.event_per_result(roles.event_results(_tables(spark, d)))


def keep_one_per_composite(spark: SparkSession, d: str) -> DataFrame:
    """D3: one medal tally per (country, edition) out of the repeated fact rows."""
    fact = fact_of(_tables(spark, d))
    return dedupe.keep_one(
        fact.select("CountryNOC", "EditionID", "GoldMedals", "SilverMedals", "BronzeMedals"),
        ["CountryNOC", "EditionID"],
        dedupe_first=True,
    )


def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Result ids with more than one distinct (team flag, event) row."""
    ev = roles.event_results(_tables(spark, d))
    distinct = dedupe.distinct_rows(ev, ["result_id", "isTeamSport", "event"])
    return quality.duplicate_keys(distinct, ["result_id"])


def null_profile(spark: SparkSession, d: str) -> DataFrame:
    """NULL count of every bronze athlete column, one pass."""
    return quality.null_profile(roles.athlete_bio(_tables(spark, d)))


def row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows per bronze dataset."""
    return quality.row_counts(roles.all_roles(_tables(spark, d)))


def mean_impute(spark: SparkSession, d: str) -> DataFrame:
    """NULL height/weight ← truncated column mean (one lazy scalar subquery)."""
    bio = roles.athlete_bio(_tables(spark, d))
    typed = bio.select(
        X.to_int_lenient("athlete_id").alias("athlete_id"),
        X.to_int_lenient("height").alias("height"),
        X.to_int_lenient("weight").alias("weight"),
    )
    return impute.fill_mean(typed, ["height", "weight"])


def fill_constant(spark: SparkSession, d: str) -> DataFrame:
    """NULL medal ← 'NoMedal'."""
    ev = roles.event_results(_tables(spark, d)).select("result_id", "athlete_id", "pos", "medal")
    return impute.fill_constant(ev, {"medal": X.NO_MEDAL})


def grouped_sum(spark: SparkSession, d: str) -> DataFrame:
    """Medal totals per (country, edition), one tally per key."""
    return gold.medals_per_key(fact_of(_tables(spark, d)))


def grouped_count_nonnull(spark: SparkSession, d: str) -> DataFrame:
    """Athlete-event rows and rows with a known athlete, per (country, edition)."""
    t = _tables(spark, d)
    fact = fact_of(t)
    bio = athlete_dim_of(t).select(F.col("AthleteID").alias("__athlete_key"))
    # count(AthleteID) per athlete first, combined map-side: a hot id collapses before the join
    per_athlete = fact.groupBy("CountryNOC", "EditionID", "AthleteID").agg(F.count("AthleteID").alias("__n"))
    joined = per_athlete.join(bio, F.col("AthleteID") == F.col("__athlete_key"), "left")
    zero = F.lit(0).cast("long")
    return joined.groupBy("CountryNOC", "EditionID").agg(
        F.coalesce(F.sum("__n"), zero).alias("athlete_rows"),
        F.coalesce(F.sum(F.when(F.col("__athlete_key").isNotNull(), F.col("__n"))), zero).alias("known_athlete_rows"),
    )


def grouped_avg(spark: SparkSession, d: str) -> DataFrame:
    """A4: average height and weight per nationality (NULLs ignored)."""
    athlete = athlete_dim_of(_tables(spark, d))
    return athlete.groupBy("Nationality").agg(
        F.avg("Height").alias("mean_height"), F.avg("Weight").alias("mean_weight")
    )


def conditional_count(spark: SparkSession, d: str) -> DataFrame:
    """Male and female athletes per nationality; 0, not NULL, when none."""
    athlete = athlete_dim_of(_tables(spark, d))
    return athlete.groupBy("Nationality").agg(
        X.count_where(F.col("Sex") == 1).alias("men"),
        X.count_where(F.col("Sex") == 0).alias("women"),
    )


def results_event_join(spark: SparkSession, d: str) -> DataFrame:
    """Numeric results ⟕ one event row per result id (raw string keys)."""
    t = _tables(spark, d)
    res = roles.results(t).filter(F.col("result_id").rlike(silver.NUMERIC_ID))
    events = silver.event_per_result(roles.event_results(t))
    joined = res.join(events, F.col("result_id") == F.col("event_result_id"), "left")
    return joined.select("result_id", "result_location", "event_result_id", "isTeamSport", "event")


def unmatched_keys(spark: SparkSession, d: str) -> DataFrame:
    """Rows each inner join of the pipeline drops, as (join, dropped_rows); the mart's three in one pass."""
    t = _tables(spark, d)
    events, tally = roles.event_results(t), roles.medal_tally(t)
    games, country = roles.games(t), roles.country(t)
    no_tally = quality.unmatched(events, tally, ["country_noc", "edition_id"], ["country_noc", "edition_id"])
    stats = gold.participation_stats(fact_of(t), athlete_dim_of(t))
    dims = (silver.country_dim(country), silver.games_dim(games, country), silver.date_dim(games))
    return quality.row_count(no_tally, "fact_without_tally").select(
        F.col("dataset").alias("join"), F.col("rows").alias("dropped_rows")
    ).unionByName(gold.dropped_keys(stats, *dims))


# --- sources, sinks and the whole lake (they write to a fresh scratch folder) -------


def _write_role_csvs(spark: SparkSession, t: roles.Tables, csv_root: str, names) -> None:
    stages.run_together(
        {name: (lambda name=name: sinks.save_csv(roles.BUILDERS[name](t), f"{csv_root}/{name}.csv")) for name in names}
    )


def bronze_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Results as CSV → discovered, landed as all-string Parquet, read back."""
    paths = LakePaths.under(scratch_path(spark, "bronze"))
    _write_role_csvs(spark, _tables(spark, d), paths.csv_root, ["Olympic_Results"])
    landed = stages.land_bronze(spark, paths)
    return load_parquet(spark, landed["Olympic_Results"])


def stream_bronze_landing(spark: SparkSession, d: str) -> DataFrame:
    """P10 as a stream: event-result CSV files landed once each through a checkpointed stream."""
    root = scratch_path(spark, "stream")
    name = "Olympic_Athlete_Event_Results"
    sinks.save_csv(roles.event_results(_tables(spark, d)), f"{root}/incoming")
    landed = streaming.land_available(
        spark, f"{root}/incoming", f"{root}/bronze", f"{root}/_checkpoint", DATASETS[name]
    )
    return load_parquet(spark, landed)


def stream_silver_fact(spark: SparkSession, d: str) -> DataFrame:
    """P11f incrementally: event CSV → landing stream → bronze → fact stream (⋈ tally) → silver fact.

    The tally of half the editions is there when the events come, the whole one only afterwards.
    """
    root = scratch_path(spark, "stream-fact")
    t = _tables(spark, d)
    name = "Olympic_Athlete_Event_Results"
    sinks.save_csv(roles.event_results(t), f"{root}/incoming")
    bronze = streaming.land_available(spark, f"{root}/incoming", f"{root}/bronze", f"{root}/_ckpt_land", DATASETS[name])
    tally = roles.medal_tally(t)
    early = sinks.save_parquet(tally.filter("edition_id <= '3'"), f"{root}/tally_early")
    late = sinks.save_parquet(tally, f"{root}/tally")
    for path in (early, late):
        streaming.update_fact(
            spark, bronze, lambda path=path: load_parquet(spark, path), f"{root}/silver_fact", f"{root}/_ckpt_fact"
        )
    return streaming.read_fact(spark, f"{root}/silver_fact", f"{root}/_ckpt_fact")


def bronze_part_folders(spark: SparkSession, d: str) -> DataFrame:
    """A dataset in ``key=value`` folders: gzip parts, other suffixes, a swapped header, a column more,
    and a part with a blank and other signs in its name."""
    paths = LakePaths.under(scratch_path(spark, "parts"))
    res = roles.results(_tables(spark, d)).select("result_id", "sport", "result_date")
    part = F.ascii(F.right("result_id", F.lit(1))) % 4
    folder = f"{paths.csv_root}/Parts.csv"
    plain = lambda k: res.filter(part == k)
    writer = lambda df: df.write.mode("overwrite").option("header", True)
    writer(plain(0)).option("compression", "gzip").csv(f"{folder}/year=2020")
    writer(plain(1).select("sport", "result_id", "result_date")).csv(f"{folder}/year=2021")
    writer(plain(2)).option("extension", "dat").csv(f"{folder}/year=2022")
    writer(plain(3).withColumn("venue", F.lit("extra"))).csv(f"{folder}/year=2023")
    swapped = f"{folder}/year=2021"
    part_file = next(n for n in sorted(list_entries(spark, swapped)) if n.startswith("part-"))
    rename(spark, f"{swapped}/{part_file}", f"{swapped}/a b+é%20.csv")
    landed = stages.land_bronze(spark, paths)
    return load_parquet(spark, landed["Parts"]).select("result_id", "sport", "result_date", "year", "venue")


def _own_database(purpose: str) -> str:
    """A database of this call alone: a key never touches tables that others published."""
    return f"{GOLD_DATABASE}_{purpose}_{uuid.uuid4().hex[:12]}"


def _published(spark: SparkSession, d: str, purpose: str, managed: bool = False) -> tuple[str, str]:
    """The athlete dim published in a database of its own: (table, path)."""
    database = sinks.ensure_database(spark, _own_database(purpose))
    table, path = f"{database}.{GOLD['athlete'][0]}", f"{scratch_path(spark, purpose)}/{GOLD['athlete'][1]}"
    sinks.publish(spark, athlete_dim_of(_tables(spark, d)), table, path, managed=managed)
    return table, path


def publish_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Athlete dim published once as Parquet + external catalog table, read via the catalog."""
    return spark.table(_published(spark, d, "publish")[0])


def publish_managed(spark: SparkSession, d: str) -> DataFrame:
    """K5: the same as a managed table, read via the catalog."""
    return spark.table(_published(spark, d, "managed", managed=True)[0])


def external_typed_table(spark: SparkSession, d: str) -> DataFrame:
    """K7: a table with a declared column list over written files."""
    table, path = _published(spark, d, "typed")
    schema = spark.read.parquet(path).schema
    return sinks.external_table(spark, f"{table}_typed", path, schema)


def read_back_check(spark: SparkSession, d: str) -> DataFrame:
    """K8: written files opened again, their schema checked against the frame's, their rows against the write's count."""
    dim = athlete_dim_of(_tables(spark, d))
    path = scratch_path(spark, "check")
    return sinks.read_back(spark, path, dim.schema, sinks.save_counted(dim, path))


def list_gold_tables(spark: SparkSession, d: str) -> DataFrame:
    """A database and its tables from the catalog, after publishing into it."""
    table, path = _published(spark, d, "list")
    sinks.external_table(spark, f"{table}_typed", path, spark.read.parquet(path).schema)
    found = sinks.list_catalog(spark, table.split(".")[0])
    return found.select(
        F.regexp_replace("database_name", "_[0-9a-f]{12}$", "").alias("database_name"),
        F.lower("table_name").alias("table_name"),
        "table_type",
        F.lower("provider").alias("provider"),
        F.regexp_extract("location", "[^/]+$", 0).alias("folder"),
    )


def column_statistics(spark: SparkSession, d: str) -> DataFrame:
    """The published athlete dimension's column statistics, as the planner reads them from the catalog."""
    table = sinks.compute_statistics(spark, _published(spark, d, "statistics")[0])
    found = sinks.list_statistics(spark, table).filter(F.col("column_name").isin("AthleteID", "Name", "Born", "Height", "Weight"))
    return found.select("column_name", "min_value", "max_value", "n_null")


def publish_versions(spark: SparkSession, d: str) -> DataFrame:
    """K5/K6: the fact published twice as versions, first a part of it; read via the catalog after the switch."""
    fact = fact_of(_tables(spark, d))
    database = sinks.ensure_database(spark, _own_database("versions"))
    table, root = f"{database}.{GOLD['fact'][0]}", scratch_path(spark, "versions")
    sinks.publish_version(spark, fact.filter("EditionID % 2 = 0"), table, root)
    sinks.publish_version(spark, fact, table, root)
    return spark.table(table)


def publish_append(spark: SparkSession, d: str) -> DataFrame:
    """K2: the fact appended by two runs, one of them twice, then one edition in three rewritten."""
    fact = fact_of(_tables(spark, d))
    path, by_edition = scratch_path(spark, "append"), scratch_path(spark, "editions")
    odd, even = fact.filter("EditionID % 2 = 1"), fact.filter("EditionID % 2 = 0 OR EditionID IS NULL")
    for run, rows in (("odd", odd), ("even", even), ("odd", odd)):
        sinks.append_run(rows, path, run)
    appended = load_parquet(spark, path).drop("run_id")
    sinks.rewrite_partitions(appended.withColumn("rewritten", F.lit(False)), by_edition, ["EditionID"])
    third = load_parquet(spark, path).filter("EditionID % 3 = 0").drop("run_id")
    sinks.rewrite_partitions(third.withColumn("rewritten", F.lit(True)), by_edition, ["EditionID"])
    return load_parquet(spark, by_edition)


def clustered_point_read(spark: SparkSession, d: str) -> DataFrame:
    """K1, F1: the fact laid out by result with Bloom filters on the athlete; the rows of who took part most often."""
    path = sinks.save_clustered(
        fact_of(_tables(spark, d)), scratch_path(spark, "clustered"), ["ResultID", "AthleteID"], ["AthleteID"]
    )
    fact = load_parquet(spark, path)
    often = fact.filter("AthleteID IS NOT NULL").groupBy("AthleteID").agg(F.count("*").alias("n"))
    athlete = often.orderBy(F.desc("n"), "AthleteID").first()  # one row: the id becomes a filter of the scan
    return fact.filter(F.col("AthleteID") == (athlete.AthleteID if athlete else None))


def schema_of_results(spark: SparkSession, d: str) -> DataFrame:
    """Column names and types of the results dimension, as data."""
    report = quality.schema_report(spark, silver_results_dim(spark, d))
    return report.select("position", "column", "type")


def written_codecs(spark: SparkSession, d: str) -> DataFrame:
    """K3: rows by the codec of the Parquet files they were written to."""
    path = sinks.save_parquet(athlete_dim_of(_tables(spark, d)), scratch_path(spark, "codec"))
    codec = F.regexp_extract("_metadata.file_name", r"\.([a-z0-9]+)\.parquet$", 1)
    return load_parquet(spark, path).groupBy(codec.alias("codec")).agg(F.count("*").alias("n_rows"))


def gold_dimension_rows(spark: SparkSession, d: str) -> DataFrame:
    """P12a-e: every row of the five published dimensions, as text."""
    paths = LakePaths.under(scratch_path(spark, "dims"))
    _write_role_csvs(spark, _tables(spark, d), paths.csv_root, list(roles.BUILDERS))
    stages.run_stages(spark, paths, database=_own_database("dims"))
    out = None
    for k in ("athlete", "games", "results", "country", "date"):
        df = load_parquet(spark, paths.gold(k))
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns])
        part = df.select(F.lit(k).alias("dimension"), text.alias("row_text"))
        out = part if out is None else out.unionByName(part)
    return out


def lake_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """A7 over a whole run: rows of every bronze, silver and gold output, read back from the lake."""
    paths = LakePaths.under(scratch_path(spark, "lake-counts"))
    _write_role_csvs(spark, _tables(spark, d), paths.csv_root, list(roles.BUILDERS))
    stages.run_stages(spark, paths, database=_own_database("counts"))
    return stages.layer_counts(spark, paths)


def lake_end_to_end(spark: SparkSession, d: str) -> DataFrame:
    """All six roles as CSV → bronze → silver → gold; the published mart, read back."""
    paths = LakePaths.under(scratch_path(spark, "lake"))
    _write_role_csvs(spark, _tables(spark, d), paths.csv_root, list(roles.BUILDERS))
    return stages.run_stages(spark, paths, database=_own_database("lake"))


QUERIES: dict[str, Query] = {
    "participation_mart": participation_mart,
    "participation_mart_unique_country": participation_mart_unique_country,
    "silver_athlete_dim": silver_athlete_dim,
    "silver_games_dim": silver_games_dim,
    "silver_results_dim": silver_results_dim,
    "silver_country_dim": silver_country_dim,
    "silver_date_dim": silver_date_dim,
    "silver_fact": silver_fact,
    "gold_fact_with_date": gold_fact_with_date,
    "cast_int_lenient": cast_int_lenient,
    "cast_boolean": cast_boolean,
    "parse_text_date": parse_text_date,
    "year_less_day_month": year_less_day_month,
    "sex_flag": sex_flag,
    "filter_numeric_id": filter_numeric_id,
    "drop_null_subset": drop_null_subset,
    "select_is_null": select_is_null,
    "drop_and_rename": drop_and_rename,
    "distinct_projection": distinct_projection,
    "keep_one_per_key": keep_one_per_key,
    "keep_one_per_composite": keep_one_per_composite,
    "duplicate_keys": duplicate_keys,
    "null_profile": null_profile,
    "row_counts": row_counts,
    "mean_impute": mean_impute,
    "fill_constant": fill_constant,
    "grouped_sum": grouped_sum,
    "grouped_count_nonnull": grouped_count_nonnull,
    "grouped_avg": grouped_avg,
    "conditional_count": conditional_count,
    "results_event_join": results_event_join,
    "unmatched_keys": unmatched_keys,
    "bronze_round_trip": bronze_round_trip,
    "stream_bronze_landing": stream_bronze_landing,
    "stream_silver_fact": stream_silver_fact,
    "publish_round_trip": publish_round_trip,
    "bronze_part_folders": bronze_part_folders,
    "publish_managed": publish_managed,
    "publish_versions": publish_versions,
    "column_statistics": column_statistics,
    "publish_append": publish_append,
    "clustered_point_read": clustered_point_read,
    "external_typed_table": external_typed_table,
    "read_back_check": read_back_check,
    "list_gold_tables": list_gold_tables,
    "schema_of_results": schema_of_results,
    "written_codecs": written_codecs,
    "gold_dimension_rows": gold_dimension_rows,
    "lake_end_to_end": lake_end_to_end,
    "lake_row_counts": lake_row_counts,
}
