"""Benchmark decontamination: one Aho-Corasick automaton over the windows of the test items.

Every item (question and answer text) gives its windows of ``WINDOW`` consecutive normalised words; a
shorter item is one window of its own. The windows are the automaton's patterns. A document is
normalised the same way and scanned once, from end to end; the places found are mapped back to its words
and to code points of its original text.

Size bound: an automaton holds windows of at most ``BLOCK_CHARS`` code points and one window more (some
40 bytes a code point). The distinct (window, item) pairs are dealt into as many such blocks as they
need, by prefix sums, so a window that a third of the items share is split as well. Benchmarks
of one block, some 60,000 words, are done in a single pass without a shuffle of documents; each further
block is a pass over the written result of the one before. No window is ever left out.

Defined cases: NULL, blank and wordless texts have no words and are clean; wordless items give no
window. A window of an item without item_id marks words, but lists no item. Repeated items and documents
each count as they stand (items by distinct item_id). Extra columns stay as they are. An empty benchmark
finds nothing; empty documents give no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import LOWER, UPPER, free_name, lower_ascii, prefix_sums, ship, written

WINDOW = 10
BLOCK_CHARS = 1 << 22
# Words of a lower-cased text: digits, a-z and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RANGES = 256
RESULT = (
    "n_words bigint, firsts array<bigint>, lasts array<bigint>, begins array<bigint>, ends array<bigint>, "
    "items array<string>"
)

_word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before lower-casing
_lower = str.maketrans(UPPER, LOWER)
# The automaton this Python worker built last, by the name of its block.
_built: dict[str, ahocorasick.Automaton] = {}


def windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (window, item): ``WINDOW`` consecutive words joined by blanks, and the item_id as text."""
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(WORD), F.lit(0))

    def all_of(w: Column) -> Column:
        first = F.sequence(F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(1)))
        return F.when(F.size(w) > 0, F.transform(first, lambda i: F.array_join(F.slice(w, i, WINDOW), " ")))

    # the words are bound once, not computed for each window
    found = F.flatten(F.transform(F.array(words), all_of))
    return benchmark.select(F.explode(found).alias("window"), F.col("item_id").cast("string").alias("item")).distinct()


def blocks(pairs: DataFrame) -> tuple[DataFrame, int]:
    """``pairs`` with ``block``, each of at most ``BLOCK_CHARS`` code points and one window; and their number."""
    sized = pairs.select(
        "window", F.coalesce("item", F.lit("")).alias("_item"), "item", F.length("window").cast("bigint").alias("n"),
        F.pmod(F.xxhash64("window", "item"), F.lit(RANGES)).alias("_range"),
    )
    summed = prefix_sums(sized, [], "_range", ["window", "_item", F.isnull("item")], "n", "_start")
    dealt = written(summed.select("window", "item", F.floor(F.col("_start") / BLOCK_CHARS).alias("block")), "windows")
    last = dealt.agg(F.max("block")).first()[0]
    return dealt, 0 if last is None else last + 1


def automaton(name: str, patterns: list[tuple[str, list[str]]]) -> ahocorasick.Automaton:
    """The block's automaton, built once in each Python worker; values are (pattern number, words)."""
    if name not in _built:
        _built.clear()
        built = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for k, (window, _) in enumerate(patterns):
            built.add_word(f" {window} ", (k, window.count(" ") + 1))
        built.make_automaton()
        _built[name] = built
    return _built[name]


def _scan(text: str | None, found: ahocorasick.Automaton, patterns, old_firsts, old_lasts, items) -> tuple:
    """What ``RESULT`` says, the spans and items of earlier blocks included."""
    words = _word.findall(text or "")
    line = f" {' '.join(words)} "
    line = line.lower() if line.isascii() else line.translate(_lower)
    # an automaton without a pattern can't be asked
    hits = list(found.iter(line)) if words and patterns else []
    old = [] if old_firsts is None else list(zip(old_firsts, old_lasts, strict=True))
    if not hits and not old:
        return len(words), [], [], [], [], list(items) if items is not None else []
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    if hits:
        ends = np.cumsum([len(w) + 1 for w in words])  # where the blank behind each word stands
        last = np.searchsorted(ends, np.array([end for end, _ in hits]))
        size = np.array([n for _, (_, n) in hits])
        np.add.at(edge, last - size + 1, 1)
        np.add.at(edge, last + 1, -1)
    for first, end in old:
        edge[first] += 1
        edge[end + 1] -= 1
    hit = np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]]).astype(np.int8)
    firsts, lasts = np.flatnonzero(np.diff(hit) == 1), np.flatnonzero(np.diff(hit) == -1) - 1
    at = np.array([m.span() for m in _word.finditer(text)])
    listed = set() if items is None else set(items)
    for k in {k for _, (k, _) in hits}:
        listed.update(patterns[k][1])
    return len(words), firsts, lasts, at[firsts, 0], at[lasts, 1], sorted(listed)


def _pass(docs: DataFrame, text: str, out: str, patterns: list[tuple[str, list[str]]]) -> DataFrame:
    """``docs`` with ``out`` extended by one block's windows."""
    shared = docs.sparkSession.sparkContext.broadcast(patterns)
    name = uuid.uuid4().hex
    names = [c.split(" ")[0] for c in RESULT.split(", ")]

    @F.pandas_udf(RESULT)
    def scanned(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        found = automaton(name, shared.value)
        for texts, *earlier in batches:
            rows = [_scan(text, found, shared.value, *old) for text, *old in zip(texts, *earlier, strict=True)]
            yield pd.DataFrame(rows, columns=names)

    if out in docs.columns:
        old = [F.col(f"{out}.{c}") for c in ("spans.first_word", "spans.last_word", "items")]
    else:
        old = [F.lit(None).cast(t) for t in ("array<bigint>", "array<bigint>", "array<string>")]
    raw = docs.withColumn(out, scanned(F.col(f"`{text}`"), *old))
    parts = {"firsts": "first_word", "lasts": "last_word", "begins": "begin", "ends": "end"}
    spans = F.arrays_zip(*[F.col(f"{out}.{c}").alias(name) for c, name in parts.items()])
    return raw.withColumn(out, F.struct(F.col(f"{out}.n_words"), spans.alias("spans"), F.col(f"{out}.items")))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "_leaks") -> DataFrame:
    """``docs`` with ``out``: a struct of n_words, spans and items.

    ``spans`` are the longest stretches of words that lie in occurrences of windows: first_word and
    last_word from 0, and code points of the original text from ``begin`` to ``end`` (exclusive). ``items`` are
    the item_ids whose windows occur, as sorted text. ``out`` must not be a column of ``docs``.
    """
    if free_name(docs.columns, out) != out:
        raise ValueError(f"{out} is a column of the documents")
    ship(docs.sparkSession)
    pairs, n = blocks(windows(benchmark))
    for block in range(max(1, n)):
        if block:
            docs = written(docs, "scanned")
        own = pairs.filter(F.col("block") == block).groupBy("window").agg(F.collect_list("item").alias("items"))
        docs = _pass(docs, text, out, [(r["window"], r["items"]) for r in own.collect()])
    return docs


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, words, words hit, items found and their digest, and whether any word is hit."""
    found = contamination(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
    spans, items = F.col("_leaks.spans"), F.col("_leaks.items")
    n_hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["last_word"] - s["first_word"] + 1)
    return found.select(
        "doc_id",
        F.col("_leaks.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window of the benchmark occurs, their columns as they were."""
    out = free_name(docs.columns, "_leaks")
    return contamination(docs, benchmark, out=out).filter(F.size(f"{out}.spans") == 0).drop(out)
