"""Substring dedup by hashing lines and their sentences.

A text is cut at line ends and after sentence ends; each unit is normalised (lower case, single spaces)
and hashed. Digests are grouped over all documents: the occurrence that ranks first (least doc_id, then
place) stays, the later ones go when they stand in a run of repeated units with ``MIN_WORDS`` words or
more, however short its units are. Shorter runs, such as a common heading, stay. Every unit keeps its
offsets in the text. A passage that begins or ends inside a unit is found by the whole units it holds.

Narrow tables only: a first pass counts digests, partial counts combining in each task, so a line that a
third of all rows share moves as one row a task; only units whose digest repeats go on. Units meet what is
known of their digest by ``look_up``: hot digests are broadcast, so their units are not dealt out by them.

Defined cases: NULL and empty texts have no units. Units without a word are skipped. Repeated rows repeat
all units: all but the first copy go. A NULL doc_id ranks last. Repeats inside one text count like those
across texts. Extra columns are ignored by ``repeated_units`` and kept by ``without_repeats``. An empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import free_name, look_up, ship, written

MIN_WORDS = 25
# Every unit that has a word counts towards its run.
UNIT_WORDS = 1
_CUT = re.compile(r"\n|(?<=[.!?…])[ \t]+")


def units(text: str | None) -> list[tuple[int, int, int, int]]:
    """(start, length, words, digest) of each unit that has a word; offsets in code points."""
    out, start = [], 0
    if not text:
        return out
    ends = [(m.start(), m.end()) for m in _CUT.finditer(text)]
    for end, after in [*ends, (len(text), len(text))]:
        words = text[start:end].lower().split()
        if words:
            digest = xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
            out.append((start, end - start, len(words), digest))
        start = after
    return out


def _units(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        cols: list[list[np.ndarray]] = [[], [], [], []]
        for text in texts:
            found = units(text)
            for k, kind in enumerate((np.int32, np.int32, np.int32, np.uint64)):
                v = np.fromiter((u[k] for u in found), dtype=kind, count=len(found))
                cols[k].append(v.view(np.int64) if kind is np.uint64 else v)
        yield pd.DataFrame(dict(zip(("start", "length", "words", "digest"), cols, strict=True)))


def _unit_table(docs: DataFrame) -> DataFrame:
    """(row, doc_id, and arrays of the units) of each text, written; ``row`` numbers the texts."""
    ship(docs.sparkSession)
    cut = F.pandas_udf(_units, "start array<int>, length array<int>, words array<int>, digest array<bigint>")
    df = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", cut("text").alias("u"))
    return written(df.select("row", "doc_id", "u.*"), "units")


def _repeats(table: DataFrame, min_words: int) -> DataFrame:
    """(row, doc_id, unit, start, length, words, first_doc_id, first_start) of the units to remove."""
    digests = table.select(F.explode("digest").alias("digest"))
    often = written(digests.groupBy("digest").agg(F.count("*").alias("_n")).filter("_n > 1"), "often")
    each = table.select("row", "doc_id", F.posexplode("digest").alias("unit", "digest"), "start", "length", "words")
    at = lambda c: F.get(c, F.col("unit")).alias(c)
    each = each.select("row", "doc_id", "unit", "digest", at("start"), at("length"), at("words"))
    found = written(look_up(each, often, "digest", "_n"), "repeated")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "unit", "start")
    first = written(found.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("_n")), "first")
    later = look_up(found, first, "digest", "_n").filter((F.col("row") != F.col("first.row")) | (F.col("unit") != F.col("first.unit")))
    # consecutive units of a text are a run; the window holds one text
    inside = Window.partitionBy("row").orderBy("unit")
    run = later.withColumn("_run", F.col("unit") - F.row_number().over(inside))
    run = run.withColumn("_words", F.sum("words").over(Window.partitionBy("row", "_run")))
    return run.filter(F.col("_words") >= min_words).select(
        "row", "doc_id", "unit", "start", "length", "words",
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start"),
    )


def repeated_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, unit, start, length, words, first_doc_id, first_start: each unit that goes, and the one that stays."""
    return _repeats(_unit_table(docs), min_words).drop("row")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the repeated units, and ``kept_spans``: (start, length) of what is left, in the original.

    The text is the kept spans put together; ``n_chars``, where there is one, follows it.
    """
    row, spans = free_name(docs.columns, "_row"), free_name(docs.columns, "kept_spans")
    base = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    ship(docs.sparkSession)
    cut = F.pandas_udf(_units, "start array<int>, length array<int>, words array<int>, digest array<bigint>")
    table = written(base.select(F.col(row).alias("row"), "doc_id", cut("text").alias("u")).select("row", "doc_id", "u.*"), "units")
    gone = _repeats(table, min_words).groupBy(F.col("row").alias(row + "2")).agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_gone")
    )
    joined = base.join(gone, F.col(row) == F.col(row + "2"), "left")
    n = F.char_length("text")
    g = F.coalesce("_gone", F.array().cast("array<struct<start:int,length:int>>"))
    # what lies between the end of one removed unit and the start of the next
    ends = F.concat(F.array(F.lit(0)), F.transform(g, lambda s: s["start"] + s["length"]))
    starts = F.concat(F.transform(g, lambda s: s["start"]), F.array(F.coalesce(n, F.lit(0))))
    left = F.filter(
        F.zip_with(ends, starts, lambda a, b: F.struct(a.alias("start"), (b - a).alias("length"))),
        lambda s: s["length"] > 0,
    )
    joined = joined.withColumn(spans, left)
    text = F.when(
        F.col("_gone").isNull(), F.col("text")
    ).otherwise(F.array_join(F.transform(spans, lambda s: F.substring(F.col("text"), s["start"] + 1, s["length"])), ""))
    out = joined.withColumn("_new", text)
    changed = {"text": F.col("_new"), "n_chars": F.char_length("_new").cast("bigint")}
    columns = [changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]
    return out.select(*columns, spans)
