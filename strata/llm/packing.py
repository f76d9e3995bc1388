"""Best-fit packing with certified bounds.

Documents become token ids with an end mark; longer ones are cut, and every piece of full length is a
sequence of its own. The rest is dealt out over groups of about ``GROUP_ROWS`` pieces, and each group is
packed by best-fit decreasing. Dual-feasible functions give a lower bound for each group's bins: where it
equals the bins used, the group is certified and done. Groups with a gap give up the documents of their
unfilled bins; these are dealt out anew, packed again, and kept if that saves bins.

Only (row number, length) goes through the packing, so its tables stay narrow; no group grows with the
input, and the number of groups follows it.

Defined cases: NULL or empty text is the end mark alone, one token. Repeated rows are packed each on
their own. An added token's string in a text is that token's one id, as the contract's file has it. Ties in length go by row number. Extra
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import array
import base64
import json
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship, written

CAPACITY = 1024
END = 2
# The same ranks as the contract's file, and the same ids (tested), at several times the speed; the added
# tokens, which the ranks don't hold, come from that file.
VOCABULARY, ADDED = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
GROUP_ROWS = 50_000
MAX_ROUNDS = 4


@lru_cache(maxsize=1)
def encoder(vocabulary: str, added: str = ADDED):
    """The byte-level BPE with its added tokens; built once in each Python worker."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    with open(public_tokenizers.path(added), "rb") as f:
        specials = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=specials
    )


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> array.array:
    """The text's ids and the end mark, as little-endian unsigned 32-bit numbers."""
    ids = array.array("I", encoder(vocabulary).encode(text, allowed_special="all") if text else ())
    ids.append(END)
    return ids


def piece_ends(n: int, capacity: int = CAPACITY) -> range:
    """Ends of the pieces of ``n`` ids: the first may be shorter, the others have full length."""
    return range((n - 1) % capacity + 1, n + 1, capacity)


def _pieces(texts: pd.Series, vocabulary: str, capacity: int) -> pd.DataFrame:
    n, sums = [], []
    for text in texts:
        ids = token_ids(text, vocabulary)
        n.append(len(ids))
        start, crcs = 0, []
        for end in piece_ends(len(ids), capacity):
            crcs.append(zlib.crc32(ids[start:end].tobytes()))
            start = end
        sums.append(crcs)
    return pd.DataFrame({"n": n, "crcs": sums})


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32), written; ``row`` numbers the pieces."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield _pieces(texts, vocabulary, capacity)

    cut = F.pandas_udf(cut, "n bigint, crcs array<bigint>")
    df = docs.select("doc_id", cut(F.col("text")).alias("t"))
    df = df.select("doc_id", F.col("t.n").alias("n"), F.posexplode("t.crcs").alias("piece", "ids_crc32"))
    first = (F.col("n") - 1) % capacity + 1
    df = df.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "piece",
        F.when(F.col("piece") == 0, F.lit(0)).otherwise(first + (F.col("piece") - 1) * capacity).cast("bigint").alias("start"),
        F.when(F.col("piece") == 0, first).otherwise(F.lit(capacity)).cast("bigint").alias("length"),
        "ids_crc32",
    )
    return written(df, "pieces")


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the free space of each bin.

    Items go by length, longest first, into the fullest bin that holds them. ``open_`` has the bins by
    free space, ``mask`` a bit for each free space that some bin has.
    """
    bins, offsets, free = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            b = open_[space].pop()
            if not open_[space]:
                mask ^= 1 << space
        else:
            b, space = len(free), capacity
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - space
        free[b] = space - size
        open_[space - size].append(b)
        mask |= 1 << (space - size)
    return bins, offsets, np.array(free, dtype=np.int64)


@lru_cache(maxsize=4)
def dual_feasible(capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Rows of dual-feasible values of the sizes 0..capacity, and each row's capacity.

    Two families. Raising to the bin what leaves less than e, and dropping what is smaller than e; and
    rounding to multiples of 1/k, where exact multiples of 1/(k+1) stay. The second is also applied,
    with k = 1, to the results of the first.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    rows, most = [x], [capacity]

    def rounded(v: np.ndarray, k: int) -> np.ndarray:
        exact = (k + 1) * v % capacity == 0
        return np.where(exact, v * k, (k + 1) * v // capacity * capacity)

    for e in range(1, capacity // 2 + 1):
        v = np.where(x > capacity - e, capacity, np.where(x < e, 0, x))
        rows += [v, rounded(v, 1)]
        most += [capacity, capacity]
    for k in range(2, 33):
        rows.append(rounded(x, k))
        most.append(capacity * k)
    return np.array(rows), np.array(most, dtype=np.int64)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing of the items needs fewer bins."""
    if len(lengths) == 0:
        return 0
    values, most = dual_feasible(capacity)
    total = values @ np.bincount(lengths, minlength=capacity + 1)
    return int((-(-total // most)).max())


def _pack_group(g: pd.DataFrame, turn: int, capacity: int) -> pd.DataFrame:
    g = g.sort_values("row", ignore_index=True)
    lengths = g["length"].to_numpy()
    bins, offsets, free = best_fit_decreasing(lengths, capacity)
    return pd.DataFrame(
        {
            "row": g["row"],
            "length": lengths,
            "sequence_id": (turn * (1 << 58)) + (int(g["g"].iloc[0]) << 24) + bins,
            "offset": offsets,
            "free": free[bins],
            "gap": len(free) - lower_bound(lengths, capacity),
        }
    )


def _pack(items: DataFrame, n: int, turn: int, capacity: int, group_rows: int) -> DataFrame:
    groups = max(1, math.ceil(n / group_rows))
    dealt = items.select("row", "length", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)).alias("g"))

    def pack(g: pd.DataFrame) -> pd.DataFrame:
        return _pack_group(g, turn, capacity)

    schema = "row bigint, length bigint, sequence_id bigint, offset bigint, free bigint, gap bigint"
    return written(dealt.groupBy("g").applyInPandas(pack, schema), "packed")


def placed(items: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(row, length, sequence_id, offset, free, gap) of every item (row, length <= capacity)."""
    n = items.count()
    done, groups = _pack(items, n, 0, capacity, group_rows), math.ceil(n / group_rows)
    for turn in range(1, MAX_ROUNDS + 1):
        unfilled = (F.col("gap") > 0) & (F.col("free") > 0)
        rest = done.filter(unfilled)
        n, bins = rest.agg(F.count("*"), F.count_distinct("sequence_id")).first()
        if groups <= 1 or n == 0:  # a lone group has nobody to exchange with
            break
        groups = math.ceil(n / group_rows)
        again = _pack(rest, n, turn, capacity, group_rows)
        if again.select("sequence_id").distinct().count() >= bins:
            break
        done = done.filter(~unfilled).unionByName(again)
    return done


def pack_documents(
    docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified: one row for each piece.

    ``certified``: the group that the piece was packed in last used as few bins as its bound.
    """
    cut = pieces(docs, vocabulary, capacity)
    full = F.col("length") == capacity
    done = placed(cut.filter(~full).select("row", "length"), capacity, group_rows)
    packed = cut.filter(~full).join(done.select("row", "sequence_id", "offset", "gap"), "row")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified"]
    whole = cut.filter(full).withColumns(
        {"sequence_id": -F.col("row") - 1, "offset": F.lit(0).cast("bigint"), "certified": F.lit(True)}
    )
    return whole.select(columns).unionByName(packed.withColumn("certified", F.col("gap") <= 0).select(columns))
