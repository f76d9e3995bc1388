"""Command line: run one stage (or all) as its own Spark application.

    spark-submit --py-files strata.zip strata/__main__.py bronze|silver|gold|all [--lake URI] [--csv URI]
    python -m strata all --master "local[*]" --lake file:/data/lake --csv file:/data/incoming

Roots default to ``STRATA_LAKE_ROOT`` / ``STRATA_CSV_ROOT``. Master, memory and
shuffle settings come from ``spark-submit`` / ``spark-defaults.conf``; nothing
is set here. Exit status 1 (message on stderr) on any failure, e.g. a missing
input folder, so a calling script can stop before the next stage.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from strata.config import GOLD_DATABASE, LakePaths
from strata.plans import stages
from strata.plans.ledger import Ledger

STAGES = ("bronze", "silver", "gold", "all")

# Target bytes per shuffle partition; AQE coalesces smaller ones at runtime.
TARGET_PARTITION_BYTES = 200 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, target: int = TARGET_PARTITION_BYTES) -> int:
    """Partitions so that each holds about ``target`` bytes of the largest shuffle."""
    return max(1, -(-shuffle_bytes // target))


def run(
    spark: SparkSession,
    stage: str,
    paths: LakePaths,
    database: str = GOLD_DATABASE,
    dedupe_country: bool = False,
    managed: bool = False,
    fact_partition_by: tuple[str, ...] | None = None,
    run_name: str | None = None,
    statistics: bool = False,
) -> None:
    ledger = None if run_name is None else Ledger(spark, paths.runs_root, run_name)
    if stage in ("bronze", "all"):
        stages.land_bronze(spark, paths, ledger)
    if stage in ("silver", "all"):
        stages.build_silver(spark, paths, ledger)
    if stage in ("gold", "all"):
        stages.build_gold(
            spark, paths, database, managed, fact_partition_by, dedupe_country, statistics=statistics, ledger=ledger
        )


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("stage", choices=STAGES)
    ap.add_argument("--lake", help="lake root (default $STRATA_LAKE_ROOT)")
    ap.add_argument("--csv", help="CSV input folder (default $STRATA_CSV_ROOT)")
    ap.add_argument("--database", default=GOLD_DATABASE)
    ap.add_argument("--master", help="only outside spark-submit, e.g. local[*]")
    ap.add_argument(
        "--dedupe-country",
        action="store_true",
        help="one mart row per country code even when the country list repeats a code",
    )
    ap.add_argument("--statistics", action="store_true", help="column statistics of the published tables, for the planner")
    ap.add_argument("--managed", action="store_true", help="publish managed tables (a copy in the warehouse)")
    ap.add_argument(
        "--partition-fact", metavar="COLUMNS", help="comma-separated columns to lay the published fact out by"
    )
    ap.add_argument("--run", metavar="NAME", help="a rerun of this name makes only the outputs that are missing")
    ap.add_argument("--hive", action="store_true", help="use the Hive metastore for the gold tables")
    ap.add_argument(
        "--shuffle-gb",
        type=float,
        help="expected size of the largest shuffle (the fact pre-aggregate) in GB; sizes the initial "
        "shuffle partition count at ~200 MB each (AQE coalesces from there)",
    )
    args = ap.parse_args(argv)

    paths = LakePaths.from_env()
    if args.lake:
        paths = LakePaths.under(args.lake, args.csv or paths.csv_root)
    elif args.csv:
        paths = LakePaths(args.csv, paths.bronze_root, paths.silver_root, paths.gold_root)

    own = spark is None
    if own:
        builder = SparkSession.builder.appName(f"strata-{args.stage}")
        if args.master:
            builder = builder.master(args.master)
        if args.shuffle_gb:
            n = shuffle_partitions_for(int(args.shuffle_gb * 1024**3))
            builder = builder.config("spark.sql.shuffle.partitions", str(n)).config(
                "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n)
            )
        spark = (builder.enableHiveSupport() if args.hive else builder).getOrCreate()
    try:
        by = tuple(args.partition_fact.split(",")) if args.partition_fact else None
        run(spark, args.stage, paths, args.database, args.dedupe_country, args.managed, by, args.run, args.statistics)
        return 0
    except Exception as exc:  # report like a batch job: one line on stderr, non-zero exit
        print(f"strata {args.stage} failed: {type(exc).__name__}: {exc}", file=sys.stderr)
        return 1
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
