"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets.

Sources in order of code points (NULL last) weigh 5, 2, 1, repeating, and share 150 % of all words.
No target exceeds twice its source; the excess is shared again by weight. Inside a source documents
stand in the order of a hash of their id; whole epochs are taken first, and the last one is cut
where the prefix sum of words meets the budget exactly.

Hot sources: the running sum is taken inside (source, range of the hash), so a source with a third of
all rows is spread over ``BUCKETS`` groups. Reruns agree: the order hangs on ids and sizes alone.

Defined cases: NULL text has size 0 and is taken 0 words. A NULL source is a source of its own, the
last. A NULL doc_id hashes as the word ``null``. Repeated rows are separate rows; rows that tie in
hash, id and size may swap places, which changes no value of the result as a whole. A source of size 0
gets target 0. An empty table gives no rows. Extra columns ride along under their own names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, look_up, n_words, prefix_sums, ranked, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix"
# Ranges of the 60-bit hash key: each source is dealt out over so many groups.
BUCKETS = 1024
KEY_BITS = 60


def _source_key() -> Column:
    """Never NULL, and in the order of the sources: code points, NULL last."""
    return F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))


def random_key(seed: str = SEED) -> Column:
    """A 60-bit number from the md5 of seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_src, source_size, target) from (_src, source_size): one row for each source.

    Water filling: target = min(epochs * size, level * weight). Each round sums the capped sources and
    raises the level, two numbers through the driver, until no further source is capped.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    rows = written(ranked(sizes, F.col("_src")).withColumn("_weight", weight), "targets")
    total, all_weight = rows.agg(F.sum("source_size"), F.sum("_weight")).first()
    budget, most = share * (total or 0), F.col("source_size") * epochs
    level, capped = budget / all_weight if all_weight else 0.0, -1
    while True:
        is_capped = most <= F.lit(level) * F.col("_weight")
        n, words, rest = rows.agg(
            F.count_if(is_capped), F.sum(F.when(is_capped, most)), F.sum(F.when(~is_capped, F.col("_weight")))
        ).first()
        if n == capped or not rest:
            break
        capped, level = n, (budget - (words or 0)) / rest
    return rows.select("_src", "source_size", F.least(most.cast("double"), F.lit(level) * F.col("_weight")).alias("target"))


def _placed(rows: DataFrame, seed: str, weights, share: float, epochs: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with source_size, target, ``_src``, ``_key``, ``_whole`` epochs and the words of the last, ``_part``."""
    keyed = rows.withColumns({"_src": _source_key(), "_key": random_key(seed)})
    keyed = keyed.withColumn("_bucket", F.shiftright("_key", KEY_BITS - (BUCKETS - 1).bit_length()))
    sizes = keyed.groupBy("_src").agg(F.sum("size").alias("source_size"))
    placed = prefix_sums(
        keyed, ["_src"], "_bucket", ["_key", "doc_id", "size", *ties], "size", "_start",
        targets(sizes, weights, share, epochs),
    )
    budget = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rest = budget - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start")))
    return placed.withColumns({"_whole": whole, "_part": part.cast("bigint")})


def mix(rows: DataFrame, seed: str = SEED, weights=WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """``rows`` (doc_id, source, size, any others) with source_size, target and taken.

    ``rows`` is read several times: pass a written table.
    """
    placed = _placed(rows, seed, weights, share, epochs)
    taken = (F.col("_whole") * F.col("size") + F.col("_part")).cast("bigint")
    return placed.withColumn("taken", taken).drop("_src", "_key", "_bucket", "_start", "_whole", "_part")


def mixed_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix as documents: a row for each epoch of a document, with the columns of ``docs``.

    The document at the cut keeps its first words, as many as the budget leaves, in their own spacing;
    ``n_chars``, where there is one, follows the text. Only ids and sizes are sorted: what a source's order
    says is one place, its cut, and each text is held against it where it lies.
    """
    fields = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(
        fields, "doc_id", "source", n_words(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("_number")
    )
    rows = written(rows.withColumns({"_src": _source_key(), "_key": random_key(seed)}), "mix-rows")
    narrow = rows.select("doc_id", "source", "size", "_number")
    place = F.struct("_key", "doc_id", "size", "_number")
    planned = _placed(narrow, seed, WEIGHTS, SHARE, MAX_EPOCHS, ("_number",))
    last = F.max(F.when(F.col("_part") > 0, F.struct(place.alias("place"), "_part"))).alias("_cut")
    cuts = planned.groupBy("_src").agg(F.max("_whole").alias("_whole"), last, F.count("*").alias("_weight"))
    found = look_up(rows, written(cuts, "mix-cuts"), "_src", "_weight")
    part = F.when(place < F.col("_cut.place"), F.col("size")).when(place == F.col("_cut.place"), F.col("_cut._part"))
    taken = F.col("_whole") * F.col("size") + F.coalesce(part, F.lit(0))
    found = found.withColumn("taken", taken).filter("taken > 0")
    left = F.col("taken") - F.col("size") * F.col("_epoch")
    copies = found.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1)))
    words = F.regexp_extract_all(F.col("_row.text"), F.lit(f"[{SPACE}]*[^{SPACE}]+"), F.lit(0))
    text = F.when(left >= F.col("size"), F.col("_row.text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.greatest(left, F.lit(0)).cast("int")), ""))
    copies = copies.withColumn("_text", text)
    values = {"text": F.col("_text"), "n_chars": F.char_length("_text").cast("bigint")}
    return copies.select(*[values.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size), written once: the text is read in one pass."""
    return written(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
