"""Parquet sinks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

DEFAULT_CODEC = "snappy"
# Bytes of rows that one task of a write into folders sorts by folder.
SORTED_BYTES = 256 << 20
_FIXED = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "decimal")


def _col(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def _row_bytes(df: DataFrame) -> Column:
    """About what a row takes in a sort: eight bytes a column and for the row's place, and the text of what has no fixed width."""
    wide = [c for c, kind in df.dtypes if not kind.startswith(_FIXED)]
    text = [F.coalesce(F.octet_length(_col(c).cast("string")), F.lit(0)) for c in wide]
    return sum(text, F.lit(8 * (len(df.columns) + 4))).cast("long")


def _dealt_into_folders(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """``df`` in so many ranges of ``partition_by`` that each task of the write sorts ``SORTED_BYTES`` or so.

    The writer sorts a task's rows by folder. Parts of AQE's advisory size are measured as compressed by the shuffle,
    and rows of few values take fifteen times that in the sort; so the rows are measured first, and only that one
    number goes to the driver. The ranges end in the task the row came from and a hash of the row: a folder that
    holds many rows, even with a single key, spreads over several tasks. The frame is read once for its
    size and once for the ranges, before it is written: frames that cost much are best written out first.
    """
    size = df.agg(F.sum(_row_bytes(df))).first()[0] or 0
    row = [_col(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    marked = df.withColumn("__from", F.spark_partition_id())
    ranges = [*[_col(c) for c in partition_by], F.col("__from"), F.xxhash64(*row)]
    return marked.repartitionByRange(max(1, math.ceil(size / SORTED_BYTES)), *ranges).drop("__from")


def save_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = DEFAULT_CODEC,
    partition_by: Sequence[str] | None = None,
) -> str:
    """Write ``df`` as Parquet (codec set on the writer, the session is not touched).

    A partitioned write is dealt out by its columns first, in ranges that fit a task's sort: otherwise
    every task writes a file into every folder.
    """
    return _write(_dealt_into_folders(df, partition_by) if partition_by else df, path, mode, compression, partition_by)


def _write(df: DataFrame, path: str, mode: str, compression: str, partition_by: Sequence[str] | None) -> str:
    writer = df.write.mode(mode).option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def save_counted(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> int:
    """Write ``df`` as Parquet and return how many rows the write itself saw: no second run, no extra pass."""
    seen = Observation()
    dealt = _dealt_into_folders(df, partition_by) if partition_by else df
    counted = dealt.observe(seen, F.count(F.lit(1)).alias("rows"))
    _write(counted, path, mode, DEFAULT_CODEC, partition_by)
    return int(seen.get["rows"])


def save_clustered(
    df: DataFrame, path: str, cluster_by: Sequence[str], bloom_on: Sequence[str] = (), mode: str = "overwrite"
) -> str:
    """Write ``df`` laid out for point reads: ranges of ``cluster_by``, sorted, with Bloom filters on ``bloom_on``.

    A filter on a leading clustering column skips files and row groups by their minima and maxima; one
    on a Bloom column skips the row groups that lack the value, wherever the others lie between. Rows with one value
    in all clustering columns still spread over several files: ranges end in a hash of the whole row.
    (Equal rows stay together; so do all of a hot one.)
    """
    whole_row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    laid = df.repartitionByRange(*cluster_by, whole_row).sortWithinPartitions(*cluster_by)
    writer = laid.write.mode(mode).option("compression", DEFAULT_CODEC)
    for c in bloom_on:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)
    return path


def rewrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """Replace only the partitions that ``df`` has rows for; all others stay as they are."""
    return _replace(_dealt_into_folders(df, partition_by), path, partition_by)


def _replace(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", DEFAULT_CODEC)
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return path


def append_run(df: DataFrame, path: str, run: str, run_column: str = "run_id") -> str:
    """Append the rows of one named run; the same run written again replaces its own rows and adds none.

    Each run is a partition of the sink, so a repeat after a failure needs no look at the rows there. An
    empty frame leaves an earlier result of that run as it is.
    """
    if run_column.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"{run_column} is a column of the rows")
    # one folder, so the write sorts nothing, and AQE's parts will do
    return _replace(df.withColumn(run_column, F.lit(run)).hint("rebalance", run_column), path, [run_column])


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header CSV, values kept verbatim.

    Spark's CSV writer trims leading and trailing blanks unless told otherwise;
    bronze text such as ``' 6 April'`` must survive a round trip unchanged.
    """
    (
        df.write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
