"""Stage order: bronze → silver → gold. Each stage reads only what the one before wrote.

Written Parquet is the hand-off between stages, which also cuts the lineage:
a lost executor recomputes at most one stage's tasks, never the whole chain.
Within a stage the outputs are independent, so their jobs are submitted
together and Spark runs them side by side (small dimension writes overlap the
big fact write instead of queueing behind it). A stage raises if any of its
jobs failed, so a failed stage stops the later ones. Under a named run a rerun
repeats only the outputs that are missing (``strata.plans.ledger``).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import DATASETS, GOLD, GOLD_DATABASE, SILVER, LakePaths
from strata.operators.quality import row_count
from strata.plans import gold, silver
from strata.plans.ledger import Ledger
from strata.sinks.catalog import compute_statistics, ensure_database, publish
from strata.sinks.files import save_parquet
from strata.sources.files import headers_differ, list_entries, load_parquet, read_csv_by_name, read_csv_strings


# Jobs of one stage submitted at once (Spark schedules their tasks together).
MAX_CONCURRENT_JOBS = 8


def run_together(jobs: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent Spark actions concurrently; re-raise the first failure once all have ended."""
    if not jobs:
        return {}
    with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT_JOBS, len(jobs))) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def csv_datasets(spark: SparkSession, csv_root: str) -> dict[str, str]:
    """Dataset name → location, for each ``X.csv`` entry of ``csv_root``, a file or a folder.

    The entry's name alone decides; what its part files are called is Spark's matter. Raises
    ``FileNotFoundError`` when the folder is missing.
    """
    root = csv_root.rstrip("/")
    return {n[: -len(".csv")]: f"{root}/{n}" for n in sorted(list_entries(spark, csv_root)) if n.endswith(".csv")}


def land_dataset(spark: SparkSession, location: str, target: str) -> str:
    """One CSV dataset → Parquet, every column a string.

    Part files are first read as having one header, which costs no extra pass; where a header
    differs that job fails, and the files are landed by column name instead.
    """
    try:
        return save_parquet(read_csv_strings(spark, location), target)
    except Exception as error:
        if not headers_differ(error):
            raise
    return save_parquet(read_csv_by_name(spark, location), target)


def _missing(ledger: Ledger | None, stage: str, jobs: dict[str, Callable[[], object]]) -> dict[str, Callable[[], object]]:
    return jobs if ledger is None else ledger.missing(stage, jobs)


def land_bronze(spark: SparkSession, paths: LakePaths, ledger: Ledger | None = None) -> dict[str, str]:
    """Bronze: each CSV dataset → ``X_parquet``, every column a string. One map-only job each.

    Returns what was written: with a ledger, the outputs that were missing.
    """
    jobs = {
        name: (lambda name=name, location=location: land_dataset(spark, location, paths.bronze(name)))
        for name, location in sorted(csv_datasets(spark, paths.csv_root).items())
    }
    return run_together(_missing(ledger, "bronze", jobs))


def silver_frames(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    """The six silver builders over the landed bronze Parquet (lazy)."""

    def bronze(name: str) -> DataFrame:
        return load_parquet(spark, paths.bronze(name))

    country, games = bronze("Olympics_Country"), bronze("Olympics_Games")
    events = bronze("Olympic_Athlete_Event_Results")
    return {
        "athlete": silver.athlete_dim(bronze("Olympic_Athlete_Bio")),
        "games": silver.games_dim(games, country),
        "results": silver.results_dim(bronze("Olympic_Results"), events),
        "country": silver.country_dim(country),
        "date": silver.date_dim(games),
        "fact": silver.fact_table(events, bronze("Olympic_Games_Medal_Tally")),
    }


def build_silver(spark: SparkSession, paths: LakePaths, ledger: Ledger | None = None) -> dict[str, str]:
    """The six silver outputs; with a ledger, those that are missing."""
    frames = silver_frames(spark, paths)
    jobs = {k: (lambda k=k, df=df: save_parquet(df, paths.silver(k))) for k, df in frames.items()}
    return run_together(_missing(ledger, "silver", jobs))


def build_gold(
    spark: SparkSession,
    paths: LakePaths,
    database: str = GOLD_DATABASE,
    managed: bool = False,
    fact_partition_by: tuple[str, ...] | None = None,
    dedupe_country: bool = False,
    check_keys: bool = False,
    statistics: bool = False,
    ledger: Ledger | None = None,
) -> DataFrame:
    """Gold: publish the dimensions, the dated fact and the mart (table + Parquet each).

    ``fact_partition_by=("EditionID",)`` lays the published fact out by edition
    (a few dozen folders) so per-edition readers prune partitions; off by default
    to keep the published layout flat. ``statistics`` adds column statistics of the
    published tables to the catalog, one more scan of each. Returns the published mart, read back
    from its Parquet files.
    """
    ensure_database(spark, database)

    def s(k: str) -> DataFrame:
        return load_parquet(spark, paths.silver(k))

    def pub(k: str, df: DataFrame, partition_by=None) -> DataFrame:
        return publish(
            spark, df, f"{database}.{GOLD[k][0]}", paths.gold(k), managed=managed, partition_by=partition_by
        )

    jobs: dict[str, Callable[[], DataFrame]] = {
        k: (lambda k=k: pub(k, s(k))) for k in ("athlete", "games", "results", "country", "date")
    }
    jobs["fact"] = lambda: pub("fact", gold.fact_with_date(s("fact"), s("date")), fact_partition_by)
    jobs["mart"] = lambda: pub(
        "mart",
        gold.participation_mart(s("fact"), s("athlete"), s("country"), s("games"), s("date"), dedupe_country, check_keys),
    )
    missing = _missing(ledger, "gold", jobs)
    # a catalog that lives in the session has lost the tables of an earlier one
    lost = {k: job for k, job in jobs.items() if not spark.catalog.tableExists(f"{database}.{GOLD[k][0]}")}
    run_together({**lost, **missing})
    if statistics:
        run_together({k: (lambda k=k: compute_statistics(spark, f"{database}.{GOLD[k][0]}")) for k in jobs})
    return load_parquet(spark, paths.gold("mart"))


def run_stages(
    spark: SparkSession,
    paths: LakePaths,
    database: str = GOLD_DATABASE,
    managed: bool = False,
    fact_partition_by: tuple[str, ...] | None = None,
    dedupe_country: bool = False,
    check_keys: bool = False,
    statistics: bool = False,
    run: str | None = None,
) -> DataFrame:
    """Bronze, then silver, then gold; returns the published mart.

    With a name for the ``run``, outputs that a run of this name has finished are not made again.
    """
    ledger = None if run is None else Ledger(spark, paths.runs_root, run)
    land_bronze(spark, paths, ledger)
    build_silver(spark, paths, ledger)
    return build_gold(spark, paths, database, managed, fact_partition_by, dedupe_country, check_keys, statistics, ledger)


def layer_counts(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """(layer, dataset, rows) for every bronze, silver and gold output of a run, in one plan.

    Each count is a partial count per file split; nothing but the counts moves.
    """
    outputs = (
        [("bronze", name, paths.bronze(name)) for name in DATASETS]
        + [("silver", folder, paths.silver(k)) for k, folder in SILVER.items()]
        + [("gold", folder, paths.gold(k)) for k, (_, folder) in GOLD.items()]
    )
    parts = [
        row_count(load_parquet(spark, path), name).select(F.lit(layer).alias("layer"), "dataset", "rows")
        for layer, name, path in outputs
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
