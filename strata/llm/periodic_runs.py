"""Periodic run detection: internal pattern matching of dyadic word blocks.

A run is a stretch of consecutive words with smallest period ``q`` and at least ``max(6, 4 * q)`` words
that no neighbouring word extends. Its words are found without comparing periods one by one:

1. Words become numbers; many documents lie one behind the other, each closed by a word of its own.
   Prefix doubling sorts all suffixes, and at each length ``2**k`` gives the suffix-array interval of
   every aligned block of that length.
2. A wavelet tree over the suffix array answers range successor and predecessor queries: the next and
   the previous occurrence of each block that lie within its own length, that is in its neighbouring
   windows. Blocks that occur once are left out, as their interval holds nothing else.
3. Occurrences so near form progressions, whose difference is a candidate period. Blocks of one
   difference that touch are joined, and the places ``w[i] == w[i + d]`` are followed to both ends word by
   word, so every reported run is exact.

No run is missed: with ``q <= 2**k < 2 * q`` a run of ``4 * q`` words holds an aligned block of ``2**k``, and of
its occurrences one period earlier and later at least one lies inside the run. A nearer one would give
the run a smaller period (periodicity lemma). Of equal stretches the smallest period is kept.

Memory in a task follows ``BATCH_WORDS`` or the longest single document: the tree takes about 3/16 of a
byte a word and bit. Every text is read whole.

Defined cases: NULL and blank texts have no words and no run. Repeated rows each give their row; doc_id is
not used. Extra columns stay as they are. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, ship

MIN_WORDS, MIN_PERIODS = 6, 4
# Words that lie in one suffix array; a longer document has its own.
BATCH_WORDS = 1 << 17
# Stretches extended at a time, and words compared in one step.
SLICE, FIRST_STEP, LAST_STEP = 1 << 14, 16, 1 << 10
RESULT = (
    "n_words bigint, starts array<bigint>, lengths array<bigint>, periods array<bigint>, "
    "begins array<bigint>, ends array<bigint>, collapsed string"
)

_word = re.compile(f"[^{SPACE}]+")


class WaveletTree:
    """Order statistics of any interval of ``values`` (0 <= value < 2**bits), many queries at a time.

    Level by level the values are dealt by one bit, the highest first, zeros before ones; ranks in
    the bit vectors lead an interval down.
    """

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
            self.levels.append((bit, words, before, len(values) - int(one.sum())))
            values = np.concatenate([values[~one], values[one]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        at = end >> 6
        below = (np.uint64(1) << (end & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & below)

    def count_less(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Values below ``x`` in each interval [lo, hi)."""
        n = np.zeros(len(lo), dtype=np.int64)
        for bit, words, before, zeros in self.levels:
            lo1, hi1 = self._ones(words, before, lo), self._ones(words, before, hi)
            one = (x >> bit & 1).astype(bool)
            n += np.where(one, (hi - hi1) - (lo - lo1), 0)
            lo, hi = np.where(one, zeros + lo1, lo - lo1), np.where(one, zeros + hi1, hi - hi1)
        return n

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with ``k`` smaller ones in each interval [lo, hi); 0 <= k < hi - lo."""
        value = np.zeros(len(lo), dtype=np.int64)
        for bit, words, before, zeros in self.levels:
            lo1, hi1 = self._ones(words, before, lo), self._ones(words, before, hi)
            n0 = (hi - hi1) - (lo - lo1)
            one = k >= n0
            value |= one.astype(np.int64) << bit
            k = np.where(one, k - n0, k)
            lo, hi = np.where(one, zeros + lo1, lo - lo1), np.where(one, zeros + hi1, hi - hi1)
        return value


def sorted_suffixes(codes: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffix order by prefix doubling, and the intervals of aligned blocks that occur more than once.

    Blocks come as (length, places, lo, hi). Lengths end where a run of ``longest`` words needs no longer block.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    rank, count = np.empty(n, dtype=np.int64), np.ones(n, dtype=np.int64)
    active, places, keys = np.arange(n), order, codes[order]
    blocks, h = [], 1
    while len(active):
        # a group's rank is its first slot, so rank and count are its interval
        change = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(change, len(keys)))
        rank[places] = np.repeat(active[change], sizes)
        count[active[change]] = sizes
        at = np.arange(0, n - h + 1, h)
        at = at[count[rank[at]] > 1]
        if len(at):
            blocks.append((h, at, rank[at], rank[at] + count[rank[at]]))
        active = active[np.repeat(sizes, sizes) > 1]
        if 2 * h >= longest:
            break
        places = order[active]
        keys = rank[places] * (n + 1) + np.where(places + h < n, rank[np.minimum(places + h, n - 1)] + 1, 0)
        by = np.argsort(keys, kind="stable")
        places, keys = places[by], keys[by]
        order[active] = places
        h *= 2
    return order, blocks


def _equal_places(codes: np.ndarray, at: np.ndarray, d: np.ndarray, step: int) -> np.ndarray:
    """How many places i = at, at + step, ... in a row have codes[i] == codes[i + d]."""
    n = np.zeros(len(at), dtype=np.int64)
    for first in range(0, len(at), SLICE):
        live, width = np.arange(first, min(first + SLICE, len(at))), FIRST_STEP
        while len(live):
            i = (at[live] + step * n[live])[:, None] + step * np.arange(width)
            inside = (i >= 0) & (i + d[live, None] < len(codes))
            i = np.where(inside, i, 0)
            j = np.where(inside, i + d[live, None], 0)
            same = np.where(inside, codes[i] == codes[j], False)
            whole = same.all(axis=1)
            n[live] += np.where(whole, width, same.argmin(axis=1))
            live = live[whole]
            width = min(2 * width, LAST_STEP) if len(live) * width < SLICE * FIRST_STEP else FIRST_STEP
    return n


def find_runs(codes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of every run, by start, then period.

    ``codes`` is any sequence of whole numbers in which documents are closed by numbers that occur once.
    """
    order, blocks = sorted_suffixes(codes, longest)
    nothing = np.zeros(0, dtype=np.int64)
    if not blocks:
        return nothing, nothing, nothing
    h = np.concatenate([np.full(len(at), size, dtype=np.int64) for size, at, _, _ in blocks])
    b, lo, hi = (np.concatenate([x[k] for x in blocks]) for k in (1, 2, 3))
    tree = WaveletTree(order.astype(np.int64), max(1, len(codes).bit_length()))
    less = tree.count_less(lo, hi, b)
    left, right = less > 0, less + 1 < hi - lo
    before = b[left] - tree.kth(lo[left], hi[left], less[left] - 1)
    after = tree.kth(lo[right], hi[right], less[right] + 1) - b[right]
    d = np.concatenate([before, after])
    size = np.concatenate([h[left], h[right]])
    # the places where w[i] == w[i + d] is known
    i = np.concatenate([b[left] - before, b[right]])
    near = d <= size
    d, i, j = d[near], i[near], (i + size)[near]
    if not len(d):
        return nothing, nothing, nothing
    by = np.lexsort((i, d))
    d, i, j = d[by], i[by], j[by]
    # touching stretches of one difference are one: far apart differences never touch
    shift = d * (2 * len(codes) + 2)
    reach = np.maximum.accumulate(j + shift)
    first = np.flatnonzero(np.concatenate([[True], (i + shift)[1:] > reach[:-1]]))
    d, i, j = d[first], i[first], np.append(reach[first[1:] - 1], reach[-1]) - shift[first]
    i = i - _equal_places(codes, i - 1, d, -1)
    j = j + _equal_places(codes, j, d, 1)
    start, end = i, j + d
    long = end - start >= np.maximum(MIN_WORDS, MIN_PERIODS * d)
    start, end, d = start[long], end[long], d[long]
    by = np.lexsort((d, end, start))
    start, end, d = start[by], end[by], d[by]
    if not len(start):
        return nothing, nothing, nothing
    keep = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])
    start, end, d = start[keep], end[keep], d[keep]
    by = np.lexsort((d, start))
    return start[by], end[by], d[by]


def runs_of(documents: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(starts, lengths, periods) of each document's runs."""
    sizes = np.array([len(words) for words in documents], dtype=np.int64)
    flat = np.array([w for words in documents for w in words], dtype=object)
    own = pd.factorize(flat)[0] if len(flat) else np.zeros(0, dtype=np.int64)
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)])
    codes = np.empty(int(firsts[-1]), dtype=np.int64)
    last = firsts[1:] - 1
    is_word = np.ones(len(codes), dtype=bool)
    is_word[last] = False
    codes[is_word] = own
    codes[last] = len(flat) + np.arange(len(documents))
    start, end, period = find_runs(codes, int(sizes.max(initial=0)))
    cut = np.searchsorted(start, firsts)
    return [
        (start[a:z] - at, (end - start)[a:z], period[a:z])
        for at, a, z in zip(firsts[:-1], cut[:-1], cut[1:], strict=True)
    ]


def collapsed(words: list[str], starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> str:
    """The words that no run contains after its first period, joined by one blank."""
    if not len(starts):
        return " ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, starts + periods, 1)
    np.add.at(edge, starts + lengths, -1)
    return " ".join(words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0))


def _batches(texts: pd.Series) -> Iterator[tuple[list[str], list[list[str]]]]:
    kept, documents, n = [], [], 0
    for text in texts:
        kept.append(text or "")
        documents.append(_word.findall(kept[-1]))
        n += len(documents[-1])
        if n >= BATCH_WORDS:
            yield kept, documents
            kept, documents, n = [], [], 0
    if kept:
        yield kept, documents


def _row(text: str, words: list[str], starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> tuple:
    begins = ends = np.zeros(0, dtype=np.int64)
    if len(starts):
        spans = np.array([m.span() for m in _word.finditer(text)], dtype=np.int64)
        begins, ends = spans[starts, 0], spans[starts + lengths - 1, 1]
    return len(words), starts, lengths, periods, begins, ends, collapsed(words, starts, lengths, periods)


def periodic_runs(docs: DataFrame, text: str = "text", out: str = "_runs") -> DataFrame:
    """``docs`` with ``out``: a struct of n_words, runs and collapsed.

    ``runs`` is an array of (start, length, period, begin, end) by start, then period: words from 0, and
    the code points of the text from ``begin`` to ``end`` (exclusive). ``collapsed`` is the text's words
    without those that repeat a run's first period, joined by one blank.
    """
    ship(docs.sparkSession)
    names = [c.split(" ")[0] for c in RESULT.split(", ")]

    @F.pandas_udf(RESULT)
    def found(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            rows = [
                _row(whole, words, *runs)
                for kept, documents in _batches(texts)
                for whole, words, runs in zip(kept, documents, runs_of(documents), strict=True)
            ]
            yield pd.DataFrame(rows, columns=names)

    raw = found(F.col(f"`{text}`"))
    fields = [F.col(f"{out}.{c}s").alias(c) for c in ("start", "length", "period", "begin", "end")]
    return docs.withColumn(out, raw).withColumn(
        out,
        F.struct(F.col(f"{out}.n_words"), F.arrays_zip(*fields).alias("runs"), F.col(f"{out}.collapsed")),
    )


def _tail_repeated(h: int, text: str) -> str:
    words = _word.findall(text)
    if not words:
        return text
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    whole, rest = divmod(n - a, p)
    return " ".join(words[:a] + words[a : a + p] * whole + words[a : a + rest])


def planted(doc_id: Column, text: Column) -> Column:
    """The text whose tail repeats, for a tenth of the documents: crc32 of the decimal doc_id decides.

    With h that checksum and g = h div 10, where 10 divides h and the text has n > 0 words, each word
    i >= a = g % n becomes word a + (i - a) % p with p = 1 + (n - a) div (3 + g % 8). A NULL doc_id plants nothing.
    """

    @F.pandas_udf("string")
    def plant(checksums: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series(
            [_tail_repeated(h, t) if t is not None and h % 10 == 0 else t for h, t in zip(checksums, texts, strict=True)],
            dtype=object,
        )

    return plant(F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(1).cast("bigint")), text)


def run_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent, and the digests of the runs and of the kept words."""
    ship(docs.sparkSession)
    texts = docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(texts).select("doc_id", "_runs.*")
    runs = F.col("runs")
    # runs stand by start, then period, so of equal exponents the first stays
    best = F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)),
        lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b),
    )
    line = F.transform(runs, lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size(runs).cast("bigint").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
