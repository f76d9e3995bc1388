"""MinHash near-dedup with sequential Bayesian verification.

1. Every text becomes its set of distinct 5-word shingles (64-bit hashes), the set's digest and its
   signature of ``N_HASHES`` min-hashes, in one pass. Documents with equal sets form one class; from
   here on a class is one node, whatever its number of copies.
2. Signatures are cut into bands; classes that share a band are candidates. A bucket names one centre,
   its class with the most company over all bands, and pairs each other class with it: n - 1 pairs.
3. Sequential Bayesian verification: pairs of impossible set sizes go; then batches of two longer
   signatures, a byte a hash, are compared, and a pair is pruned as soon as the posterior of similarity
   >= the threshold falls below ``MISS``. Survivors are verified on the full shingle sets.
4. Verified pairs are links; connected components by alternating star contraction on written tables.
5. A bucket whose classes fell into one component is done: no further pair could change the result.
   While that halves the open buckets, the others get further centres. In the end every pair of an open
   bucket that lies in two components is compared, block against block in memory, and only pairs that
   survive step 3's pruning leave the task: no candidate is dropped, no list of all pairs is made.

Classes sharing a third of all rows thus cost one pair a bucket and row. Hot buckets, centres, components
and sets meet what is known of them by ``look_up``: their few keys are broadcast, their rows stay in place.

One plan at every size: a bitmap of the candidates, of bounded size, keeps the other texts out of the
exchange in which the candidates' texts meet their numbers, and rows without a copy out of the last join.

Defined cases: a text without words, empty or NULL has no shingles, links with nothing, and is its own
component. Fewer than five words: the whole sequence is the one shingle. Repeated rows are copies of one
class; rows of one doc_id with different texts are separate nodes. A NULL doc_id joins components like
any other, names one only when no other id is in it, and then the component_id is NULL. Extra columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections import OrderedDict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, documents_like, free_name, look_up, lower_ascii, marked, ship, written

SHINGLE = 5
# Similar: PERCENT * union size <= 100 * intersection size.
PERCENT = 75
# At similarity 0.75 a pair misses all bands with probability (1 - 0.75 ** ROWS) ** BANDS = 1e-4.
BANDS, ROWS = 34, 5
N_HASHES = BANDS * ROWS
BATCH = 34
# Hashes that candidates are compared by, a byte each; two different minima share it once in 256.
N_COMPARED = 15 * BATCH
# A pair is pruned when its posterior probability of being similar falls below this. The looks add up: all
# 15 prune a pair at similarity 0.75 with probability 2.8e-5, so bands and pruning miss 1.3e-4 together.
MISS = 2.5e-6
SEED = 20240229
MAX_ROUNDS = 4
# Classes of a bucket that are compared at a time.
BLOCK = 512
# Shingles that a task keeps of the sets it used last.
CACHED = 1 << 21

_rng = np.random.default_rng(SEED)
_MUL = (_rng.integers(0, 1 << 32, N_COMPARED, dtype=np.uint64) | 1).astype(np.uint32)
_XOR = _rng.integers(0, 1 << 32, N_COMPARED, dtype=np.uint64).astype(np.uint32)
_WORD = _rng.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles' 64-bit hashes, ascending."""
    # bytes.lower and bytes.split know ASCII only: exactly A-Z and \\x20 \\x09-\\x0D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    total = np.full(n, min(len(words), SHINGLE), dtype=np.uint64)
    for k in range(min(len(words), SHINGLE)):
        total = _mixed(total + h[k : k + n] * _WORD[k])
    return np.unique(total)


def signature(s: np.ndarray, hashes: int = N_HASHES) -> np.ndarray:
    """The first ``hashes`` min-hashes, of 32 bits."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    least = np.full(hashes, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 2048):
        part = x[i : i + 2048]
        for k in range(0, hashes, BATCH):
            at = slice(k, k + BATCH)
            h = (part[None, :] ^ _XOR[at, None]) * _MUL[at, None]
            # the product's low bits hang on low bits alone; fold the high ones in before the minimum
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            np.minimum(least[at], h.min(axis=1), out=least[at])
    return least


def band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band: its number and its rows."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        key = _mixed(key + rows[:, r] * _WORD[r])
    return key.view(np.int64)


def _sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Set size, digest of the set and band keys of each text; NULL for a text without words."""
    for texts in batches:
        out = []
        for text in texts:
            s = shingles(text)
            if len(s):
                out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), band_keys(signature(s))))
            else:
                out.append((0, None, None))
        yield pd.DataFrame(out, columns=["n", "digest", "bands"])


def compared_bytes(sig: np.ndarray) -> bytes:
    """A byte of each of ``N_COMPARED`` min-hashes."""
    return (sig >> np.uint32(8)).astype(np.uint8).tobytes()


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """cid, set size, text, the text's signature and its band keys."""
    for b in batches:
        out = []
        for cid, text in zip(b["cid"], b["text"], strict=True):
            s = shingles(text)
            sig = signature(s, N_COMPARED)
            out.append((cid, len(s), text, compared_bytes(sig), band_keys(sig[:N_HASHES])))
        yield pd.DataFrame(out, columns=["cid", "n", "text", "sig", "bands"])


@lru_cache(maxsize=None)
def least_matches(compared: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Fewest matches among ``compared`` hashes that keep a pair alive.

    With a uniform prior the posterior P(similarity >= t | m of n) is P(Bin(n + 1, t) <= m).
    """
    t, below = percent / 100, 0.0
    for m in range(compared + 1):
        below += math.comb(compared + 1, m) * t**m * (1 - t) ** (compared + 1 - m)
        if below >= miss:
            return m
    return compared


def _matrix(signatures: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), dtype=np.uint8).reshape(len(signatures), N_COMPARED)


def _pruned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs that survive every batch of hashes."""
    for b in batches:
        if len(b) == 0:
            continue
        x, y = (_matrix(b[c]) for c in ("sig_a", "sig_b"))
        alive, matches = np.arange(len(b)), np.zeros(len(b), dtype=np.int64)
        for end in range(BATCH, N_COMPARED + 1, BATCH):
            at = slice(end - BATCH, end)
            matches[alive] += (x[alive, at] == y[alive, at]).sum(axis=1)
            alive = alive[matches[alive] >= least_matches(end)]
        yield b.iloc[alive][["a", "b"]]


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs that are similar on their full shingle sets."""
    known: OrderedDict[int, np.ndarray] = OrderedDict()
    held = 0

    def sets(cid: int, text: str) -> np.ndarray:
        # pairs of one class come up again and again: keep the sets last used
        nonlocal held
        if cid in known:
            known.move_to_end(cid)
            return known[cid]
        known[cid] = s = shingles(text)
        held += len(s)
        while held > CACHED and len(known) > 1:
            held -= len(known.popitem(last=False)[1])
        return s

    for b in batches:
        pairs = zip(b["a"], b["b"], b["text_a"], b["text_b"], strict=True)
        keep = np.array([similar(sets(x, s), sets(y, t)) for x, y, s, t in pairs], dtype=bool)
        yield b.loc[keep, ["a", "b"]]


def _compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(a, b) of the blocks: rows come sorted by (key, i, j), the smaller side's first.

    A block of a bucket's stray classes against a block of all its classes; only pairs in different
    components that survive the pruning come out, each from the first bucket that it shares. (A bucket
    that such a pair shares is open, so the first one is among those compared.)
    """
    rest: list[pd.DataFrame] = []
    for b in batches:
        if len(b) == 0:
            continue
        change = (b[["key", "i", "j"]].to_numpy()[1:] != b[["key", "i", "j"]].to_numpy()[:-1]).any(axis=1)
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        if rest and tuple(rest[-1][["key", "i", "j"]].iloc[-1]) != tuple(b[["key", "i", "j"]].iloc[0]):
            yield _block_pairs(pd.concat(rest))
            rest = []
        for s, e in zip(starts, [*starts[1:], len(b)], strict=True):
            part = b.iloc[s:e]
            if e == len(b):
                rest.append(part)
            else:
                yield _block_pairs(pd.concat([*rest, part]) if rest else part)
                rest = []
    if rest:
        yield _block_pairs(pd.concat(rest))


def _block_pairs(block: pd.DataFrame) -> pd.DataFrame:
    stray = block["side"].to_numpy() == 0
    left, right = block[stray], block[~stray]
    if len(left) == 0 or len(right) == 0:
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    n, m = left["n"].to_numpy()[:, None], right["n"].to_numpy()[None, :]
    apart = left["label"].to_numpy()[:, None] != right["label"].to_numpy()[None, :]
    i, j = np.nonzero(apart & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)))
    x, y = _matrix(left["sig"]), _matrix(right["sig"])
    matches = np.zeros(len(i), dtype=np.int64)
    for end in range(BATCH, N_COMPARED + 1, BATCH):
        at = slice(end - BATCH, end)
        matches += (x[i, at] == y[j, at]).sum(axis=1)
        alive = matches >= least_matches(end)
        i, j, matches = i[alive], j[alive], matches[alive]
        if end == BATCH and len(i):
            p, q = np.stack(left["bands"]), np.stack(right["bands"])
            first = np.ones(len(i), dtype=bool)
            for band in range(BANDS):
                shared = p[i, band] == q[j, band]
                first &= ~(shared & (p[i, band] < block["key"].iloc[0]))
            i, j, matches = i[first], j[first], matches[first]
    a, b = left["cid"].to_numpy()[i], right["cid"].to_numpy()[j]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def _sizes_fit(a: str, b: str) -> Column:
    """Sets can only be similar if the smaller has PERCENT of the larger's size."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def components(links: DataFrame) -> DataFrame:
    """(cid, label): the least cid reachable, for every class in a link (a, b).

    Alternating large and small stars: each round is two grouped minima and two written tables, and the
    number of rounds grows with the logarithm of the longest chain.
    """
    u, v, m = F.col("u"), F.col("v"), F.col("m")
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    while True:
        both = edges.union(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        least = written(least.select("u", F.least("u", "m").alias("m"), "n"), "least")
        # large star: greater neighbours move to the least one around
        large = look_up(both, least, "u", "n").filter(v > u).select(v.alias("u"), m.alias("v"))
        large = written(large, "large-star")
        # small star: the node and its smaller neighbours move to the least of them
        least = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "least")
        moved = look_up(large, least, "u", "n").filter(v != m).select(v.alias("u"), m.alias("v"))
        edges = written(moved.union(least.select("u", m.alias("v"))).distinct(), "small-star")
        # done when every node has one edge, and none of those it points to has an edge of its own
        ends = edges.select(u.alias("k"), F.lit(1).alias("out")).union(edges.select(v.alias("k"), F.lit(0).alias("out")))
        ends = ends.groupBy("k").agg(F.sum("out").alias("n_out"), F.count("*").alias("n"))
        if ends.filter((F.col("n_out") > 1) | ((F.col("n_out") == 1) & (F.col("n") > 1))).isEmpty():
            break
    roots = edges.select(v).distinct().select(v.alias("cid"), v.alias("label"))
    return edges.select(u.alias("cid"), v.alias("label")).union(roots)


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketch of every row, and one row for each distinct shingle set, with its number ``cid``."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sketched = F.pandas_udf(_sketch, "n bigint, digest binary, bands array<bigint>")
    sketch = rows.select("doc_id", "text_hash", sketched("text").alias("s"))
    sketch = written(
        sketch.select("doc_id", "text_hash", F.col("s.n").alias("n_shingles"), "s.digest", "s.bands"), "sketch"
    )
    sets = sketch.filter("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("least_id"),
        F.count("*").alias("copies"),
        F.first(F.struct("doc_id", "text_hash", "n_shingles", "bands")).alias("row"),
    )
    # the numbers are fixed by writing them
    classes = sets.select(
        F.monotonically_increasing_id().alias("cid"), "digest", "least_id", "copies", "row.doc_id", "row.text_hash",
        F.col("row.n_shingles").alias("n"), "row.bands",
    )
    return sketch, written(classes, "classes")


def _candidate_nodes(docs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """(cid, n, text, sig, bands) of every class that shares a bucket."""
    # an id that joins when NULL, too
    known = {"_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_null": F.col("doc_id").isNull()}
    at = ["_id", "_null", "text_hash"]
    need = rows.select("cid").distinct().join(classes.select("cid", "doc_id", "text_hash"), "cid")
    need = written(need.withColumns(known).select("cid", *at), "need")
    texts = docs.withColumn("text_hash", F.xxhash64("text")).withColumns(known).select(*at, "text")
    texts = marked(texts, F.xxhash64(*at), need, F.xxhash64(*at), "_wanted").filter("_wanted").drop("_wanted")
    # repeated rows collapse in each task; the join then finds the rows dealt by its keys
    texts = texts.dropDuplicates(at).join(need, at).select("cid", "text")
    return written(texts.mapInPandas(_signed, "cid bigint, n bigint, text string, sig binary, bands array<bigint>"), "nodes")


def _verify(alive: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of the pairs (a, b) left by the pruning, those that are similar on their full sets."""
    alive = written(alive, "alive")
    side = lambda x: nodes.select(F.col("cid").alias(x), F.col("text").alias(f"text_{x}"))
    full = alive.join(side("a"), "a").join(side("b"), "b")
    return written(full.mapInPandas(_verified, "a bigint, b bigint"), "verified")


def _links(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar: pruned by signatures, then verified on full sets."""
    pairs = pairs.filter("a <> b").distinct()
    for x in ("a", "b"):
        pairs = pairs.join(
            nodes.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")), x
        )
    return _verify(pairs.filter(_sizes_fit("n_a", "n_b")).mapInPandas(_pruned, "a bigint, b bigint"), nodes)


def _open_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, cid, label, apart, n_rows, n_apart) of the buckets that still hold several components.

    ``apart``: outside the component that most of the bucket's classes are in.
    """
    labelled = rows.select("key", "cid").join(labels, "cid", "left")
    labelled = written(labelled.withColumn("label", F.coalesce("label", "cid")), "labelled")
    parts = labelled.groupBy("key", "label").agg(F.count("*").alias("m"))
    most = parts.groupBy("key").agg(
        F.max(F.struct("m", "label")).alias("_most"), F.sum("m").alias("n_rows"), F.count("*").alias("_parts")
    )
    most = most.filter("_parts > 1").select(
        "key", F.col("_most.label").alias("_main"), "n_rows", (F.col("n_rows") - F.col("_most.m")).alias("n_apart")
    )
    most = written(most.withColumn("_weight", F.col("n_rows")), "most")
    found = look_up(labelled, most, "key", "_weight").withColumn("apart", F.col("label") != F.col("_main"))
    return written(found.drop("_main"), "open")


def _rest(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links among all pairs of the open buckets that lie in different components.

    Buckets are cut into blocks: each block of strays meets each block of all classes, so a row is sent
    once for each opposite block.
    """
    n_left = F.ceil(F.col("n_apart") / BLOCK).cast("int")
    n_right = F.ceil(F.col("n_rows") / BLOCK).cast("int")
    many = found.join(nodes.select("cid", "n", "sig", "bands"), "cid")
    number = lambda n: F.pmod(F.xxhash64("cid"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    stray = F.when(
        F.col("apart"), F.transform(every(n_right), lambda j: F.struct(F.lit(0).alias("side"), number(n_left).alias("i"), j.alias("j")))
    ).otherwise(F.array().cast("array<struct<side:int,i:int,j:int>>"))
    whole = F.transform(every(n_left), lambda i: F.struct(F.lit(1).alias("side"), i.alias("i"), number(n_right).alias("j")))
    sent = many.withColumn("p", F.explode(F.concat(stray, whole)))
    sent = sent.select("key", "p.i", "p.j", "p.side", "cid", "label", "n", "sig", "bands")
    sent = sent.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "side")
    likely = sent.mapInPandas(_compared, "a bigint, b bigint")
    return _verify(likely.distinct(), nodes)


def class_components(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sketch, classes, labels): labels has (cid, label) of the classes that have a link."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sketch, classes = _classes(docs)
    bands = classes.select("cid", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("company")).filter("company > 1")
    shared = written(shared, "shared")  # a table of its own: the join can then split a hot bucket
    rows = written(look_up(bands, shared.withColumn("_weight", F.col("company")), "key", "_weight"), "buckets")
    # the centre of a family of copies is the one that most bands agree with
    popular = rows.groupBy("cid").agg(F.sum("company").alias("score"))
    first = F.max(F.struct("score", F.col("cid"))).alias("_c")
    centres = rows.join(popular, "cid").groupBy("key").agg(first, F.count("*").alias("_weight"))
    centres = written(centres.select("key", F.col("_c.cid").alias("a"), "_weight"), "centres")
    nodes = _candidate_nodes(docs, classes, rows)
    links = _links(look_up(rows, centres, "key", "_weight").select("a", F.col("cid").alias("b")), nodes)
    labels, before = components(links), rows.count()
    for turn in range(MAX_ROUNDS + 1):
        found = _open_rows(rows, labels)
        left = found.count()
        if not left:
            break
        if turn == MAX_ROUNDS or 2 * left > before:
            labels = components(links.union(_rest(found, nodes)))
            break
        before = left
        centre = F.min(F.struct(F.xxhash64("cid", F.lit(turn)).alias("o"), F.col("cid"), F.col("label"))).alias("_c")
        centres = found.filter("apart").groupBy("key").agg(centre, F.first("n_rows").alias("_weight"))
        centres = written(centres.select("key", F.col("_c.cid").alias("a"), F.col("_c.label").alias("_la"), "_weight"), "centres")
        pairs = look_up(found, centres, "key", "_weight").filter("label <> _la").select("a", F.col("cid").alias("b"))
        links = links.union(_links(pairs, nodes))
        labels = components(links)
    return sketch, classes, labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs`` (doc_id, text)."""
    sketch, classes, labels = class_components(docs)
    of_class = classes.select("digest", "cid", "least_id", "copies").join(labels, "cid", "left")
    of_class = written(of_class.withColumn("label", F.coalesce("label", "cid")), "of-class")
    least = of_class.groupBy("label").agg(F.min("least_id").alias("_least"), F.count("*").alias("_weight"))
    ids = look_up(of_class, written(least, "least-ids"), "label", "_weight").select("digest", "_least", "copies")
    rows = sketch.select("doc_id", "n_shingles", "digest")
    alone = rows.filter("digest is null").withColumn("_least", F.col("doc_id"))
    found = look_up(rows.filter("digest is not null"), written(ids, "ids"), "digest", "copies")
    component = F.col("_least")
    return found.select(*alone.columns).union(alone).select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one for each component, and every text without words.

    Of rows that repeat an id, each different text stays (in lower case, spaces made equal).
    """
    key, empty, n, open_ = (free_name(docs.columns, x) for x in ("_id", "_empty", "_n", "_open"))
    judged = written(near_duplicates(docs), "judged")
    ids = judged.filter("kept").groupBy(F.col("doc_id").alias(key), (F.col("n_shingles") == 0).alias(empty)).agg(
        F.count("*").alias(n)
    )
    # rows that are alone and stay need no join: all but those with an id that goes or comes twice
    unsure = judged.groupBy("doc_id").agg(F.min("kept").alias("_all"), F.count("*").alias("_rows"))
    unsure = written(unsure.filter("not _all or _rows > 1").select(F.xxhash64("doc_id").alias("_h")), "unsure")
    split = marked(docs, F.xxhash64("doc_id"), unsure, F.col("_h"), open_)
    has_words = F.coalesce(F.col("text").rlike(f"[^{SPACE}]"), F.lit(False))
    kept = split.filter(open_).join(ids, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(empty) == ~has_words))
    repeated = F.col(n) > 1
    spaces = F.regexp_replace(F.trim(lower_ascii(F.col("text")), F.lit(" \t\n\x0b\f\r")), f"[{SPACE}]+", " ")
    once = kept.filter(has_words & repeated).withColumn(empty, spaces).dropDuplicates([key, empty])
    rest = documents_like(kept.filter(~has_words | ~repeated), docs).union(documents_like(once, docs))
    return documents_like(split.filter(~F.col(open_)), docs).union(rest)
