"""Data-quality reports, each a distributed DataFrame (nothing pulled to the driver)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: number of NULLs per column, all columns in one pass."""
    cols = list(cols) if cols else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (GROUP BY … HAVING count > 1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, whose plan fails as soon as a key that isn't NULL occurs twice, naming the key.

    One hash aggregation by the keys. A join on the same keys that follows takes over its partitioning, so
    there the check moves no row more. Copies of a row are a repeated key too.
    """
    others = [c for c in df.columns if c not in keys]
    named = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.col(f"`{k}`").cast("string")) for k in keys])
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(f"`{k}`").isNotNull()
    null, known = df.filter(~whole), df.filter(whole)
    once = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), *[F.any_value(F.col(f"`{c}`")).alias(c) for c in others]
    )
    failed = F.raise_error(F.concat(F.lit("repeated key: "), named))
    checked = once.withColumn(keys[0], F.when(F.col("__n") == 1, F.col(f"`{keys[0]}`")).otherwise(failed))
    return checked.select(*df.columns).unionByName(null)


def row_count(df: DataFrame, name: str | None = None) -> DataFrame:
    """Row count as a one-row frame (lazy, composable) instead of an action."""
    out = df.agg(F.count(F.lit(1)).alias("rows"))
    return out if name is None else out.select(F.lit(name).alias("dataset"), "rows")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(dataset, rows)`` for several frames in one plan."""
    parts = [row_count(df, name) for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filter_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is NULL (e.g. to assert that none is left)."""
    return df.filter(F.col(col).isNull())


def drop_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset``.

    Same rows as ``na.drop(subset=...)``, but written as ``isNotNull`` so the
    predicate reaches the Parquet scan (``na.drop`` is not pushed down).
    """
    cond = F.lit(True)
    for c in subset:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def unmatched(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
) -> DataFrame:
    """Rows of ``left`` that an inner join on these keys would drop (NULL keys included).

    A plain anti join: AQE broadcasts the keys when they are small, and splits a hot left key
    when they are not.
    """
    pairs = list(zip(left_keys, right_keys, strict=True))
    keys = right.select(*[F.col(rk).alias(f"__rk{i}") for i, (_, rk) in enumerate(pairs)])
    cond = None
    for i, (lk, _) in enumerate(pairs):
        c = F.col(lk) == F.col(f"__rk{i}")
        cond = c if cond is None else cond & c
    return left.join(keys, cond, "left_anti")


def schema_report(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``printSchema`` as data: (position, column, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, type string, nullable boolean")
