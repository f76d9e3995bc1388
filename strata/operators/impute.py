"""NULL filling: column mean (as a lazy scalar subquery) and constants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_means(df: DataFrame, cols: Sequence[str]) -> Column:
    """One scalar subquery holding ``struct(avg(c) AS c, ...)``.

    The mean is never collected to the driver: Spark runs the one-row aggregate
    once (map-side partial sums, one tiny final task) and inlines the result.
    """
    return df.select(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()


def fill_mean(df: DataFrame, cols: Sequence[str], source: DataFrame | None = None) -> DataFrame:
    """Replace NULLs in ``cols`` with the column mean cast to the column type.

    Integer columns get the mean truncated toward zero (175.9 → 175), as a numeric
    fill into an int column does. The mean is over ``source`` (default ``df``);
    an all-NULL column has a NULL mean and stays NULL.
    """
    if not cols:
        return df
    types = dict(df.dtypes)
    means = column_means(source if source is not None else df, cols)
    return df.withColumns({c: F.coalesce(F.col(c), means.getField(c).cast(types[c])) for c in cols})


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULLs with constants, e.g. ``{"MedalAthlete": "NoMedal"}``."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})
