"""What the training-data operators share: table access, written hand-offs, exact prefix sums."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

import strata
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.files import load_parquet

# Whitespace that separates words in the contracts: blank and \t \n \v \f \r.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A key is hot when more than one row in so many has it: fewer keys than this can be.
HOT = 1024
# Bits of a set's bitmap for each member, and at most (32 MB): beyond, it lets more rows through.
BITS_EACH, MAX_BITS = 16, 1 << 28
_BLOCK_BITS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder, and read back.

    Cuts the lineage: what follows never recomputes ``df``, and a lost executor costs only the
    tasks it ran. (``checkpoint()`` would run the plan twice, once to count and once to write.)
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package (``--py-files`` does the same), once a session."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(strata.__file__).parent
    if root.is_dir():  # not when the package itself came as a zip
        path = os.path.join(tempfile.mkdtemp(prefix="strata-py-"), "strata.zip")
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; NULL text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def documents_like(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, in order."""
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def free_name(taken: Sequence[str], name: str) -> str:
    """``name``, lengthened until it clashes with none of ``taken`` (names clash in any case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def prefix_sums(
    df: DataFrame,
    group: Sequence[str],
    bucket: str,
    order: Sequence[str],
    value: str,
    out: str,
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same ``group`` that stand before.

    Rows stand in order of (``bucket``, ``order``); the keys must not be NULL. The running sum is taken
    inside each (group, bucket), in parallel; what earlier buckets of the group hold is added from the
    table of bucket totals. ``bucket`` must be a function of the row, so that reruns deal rows alike,
    and must split every group that may be large: the second window then sees one row for each bucket.
    Columns of ``per_group`` (one row for each group) come along with the totals, so the rows
    themselves are never dealt out by a hot group alone.
    """
    keys = [*group, bucket]
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    if per_group is not None:
        totals = totals.join(per_group, list(group))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(totals, keys).withColumn(out, F.col(out) + F.col("_before")).drop("_before")


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` (written) with ``_rank``: 0, 1, ... in the given order, without one task that sorts it all.

    Rows are dealt out by range and written, so the part a row lies in is fixed; ranks are prefix
    counts over the parts.
    """
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    fixed = written(parts.withColumn("_one", F.lit(1).cast("bigint")), "ranked")
    return prefix_sums(fixed, [], "_part", list(order), "_one", "_rank").drop("_part", "_one")


def look_up(rows: DataFrame, lookup: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` with the columns of ``lookup`` for their ``key``; rows whose key it lacks go.

    ``lookup`` has one row a key, ``weight`` of which stand in ``rows``; both are read twice, so pass
    written tables. Hot keys, fewer than ``HOT`` by their weights, are broadcast, so their rows stay
    where they are; all others meet in an equi-join, in which no key has more than a ``HOT``-th of the rows.
    """
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    hot = F.col(weight) * HOT > total
    often = F.broadcast(lookup.filter(hot).drop(weight))
    rest = rows.join(F.broadcast(lookup.filter(hot).select(key)), key, "left_anti")
    return rows.join(often, key).union(rest.join(lookup.filter(~hot).drop(weight), key))


def marked(rows: DataFrame, by: Column, members: DataFrame, member: Column, out: str) -> DataFrame:
    """``rows`` with a flag ``out``: false only where the 64-bit hash ``by`` is no ``member`` of ``members``.

    The members' hashes set bits of a bitmap with ``BITS_EACH`` bits for each of them, ``MAX_BITS`` at
    most, which is broadcast. A flag that is true may be wrong, about once in ``BITS_EACH`` rows and
    more often where the bitmap has its greatest size: an exact join follows. It spares the rows that
    need none their way through it.
    """
    bits = _BLOCK_BITS
    while bits < min(MAX_BITS, BITS_EACH * members.count()):
        bits *= 2
    place, block, byte = (free_name(rows.columns, x) for x in ("_place", "_block", "_byte"))
    set_bits = members.select(F.pmod(member, F.lit(bits)).alias(place)).distinct()
    block_of = F.floor(F.col(place) / _BLOCK_BITS).cast("int")
    inside = F.col(place).bitwiseAND(F.lit(_BLOCK_BITS - 1)).cast("int")
    maps = set_bits.groupBy(block_of.alias(block)).agg(F.bitmap_construct_agg(inside.cast("bigint")).alias(byte))
    placed = rows.withColumn(place, F.pmod(by, F.lit(bits))).withColumn(block, block_of)
    found = placed.join(F.broadcast(maps), block, "left")
    of_place = F.conv(F.hex(F.substring(byte, F.shiftright(inside, 3) + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(of_place, inside.bitwiseAND(F.lit(7))) == 1
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(is_set, F.lit(False)).alias(out))
