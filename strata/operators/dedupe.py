"""De-duplication: distinct rows and a deterministic "keep one row per key".

``dropDuplicates(keys)`` keeps an arbitrary survivor. ``keep_one`` keeps the
smallest remaining-columns struct instead (NULL fields sort first), so reruns and
other engines agree. It is one ``groupBy`` with a map-side partial ``min``: a hot
key is collapsed inside every map task before the shuffle and never lands whole
in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_KEPT, _COPIES = "__kept", "__copies"


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows over a projection (all columns by default)."""
    return (df.select(*cols) if cols else df).distinct()


def keep_one(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, dedupe_first: bool = False
) -> DataFrame:
    """One row per ``keys``: the row whose ``order`` columns (default: all others) are smallest.

    Columns come back in the input order. A ``distinct()`` in front is not needed
    for the result (``min`` is unchanged by duplicate rows). ``dedupe_first``
    adds one for speed when rows repeat a lot (a value copied onto every row of
    its key): the hash ``distinct`` collapses the copies map-side and the
    struct ``min`` — a sort-based aggregate — then sees only distinct rows. An exchange
    between the two gives each its own tasks: in one, the hash table would stand beside the
    sort of the same rows.
    """
    keys = list(keys)
    if dedupe_first:
        # a plain distinct() below a min would be optimised away as redundant; the filter keeps it
        counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_COPIES))
        # dealt by whole rows, not by key, so that the rows of a hot key stay spread until the partial min
        df = counted.filter(F.col(_COPIES) > 0).drop(_COPIES).hint("rebalance", *df.columns)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ranked = list(order) if order else rest
    carried = ranked + [c for c in rest if c not in ranked]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*carried)).alias(_KEPT))
    return kept.select(*[F.col(c) if c in keys else F.col(f"{_KEPT}.{c}").alias(c) for c in df.columns])
