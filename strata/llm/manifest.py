"""Merkle dataset manifest: stored levels of parent-linked nodes, and a recursive query that climbs them.

Every row is a leaf: the SHA-256 of its fields. The leaves of one language, by doc_id, form a binary
tree, and the languages' roots form another over them. Both are stored in tiers of ``HEIGHT`` levels:

* a tier cuts its leaves into chunks of ``2**HEIGHT`` neighbours; each chunk's levels are hashed from one
  bounded group and written as rows that name their parent and hold their sibling's hash;
* the chunks' roots are the leaves of the next tier, until one chunk is left.

A recursive query then ascends from every leaf to its chunk's root, step by step: it joins the node's
row, appends the sibling to the proof and folds the (perhaps tampered) hash with it. What lies above a
chunk's root is the same for all its leaves, so it comes from the tier above, climbed before by the same
query; the fold goes on along it. No node is ever met by more than ``2**HEIGHT`` leaves, however many rows
a language holds, and a tier has ``2**HEIGHT`` times fewer rows than the one below.

A node without a neighbour is still hashed (alone) until one node is left. Nothing is collected but a
count; places come from range partitions and prefix counts, with the row's number in the written table as the last
tie-breaker, so a doc_id repeated on many rows is split too.

Defined cases: a NULL field counts as ``-``; NULL doc_ids stand first. Repeated rows are leaves of their own,
equal ones in any order (their hashes are equal). A lone leaf is its language's root, a lone language's root is the
root. Only the five columns are read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import prefix_sums, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels of a tier: a chunk has up to 16 leaves. Each level of a tier deals its leaves and nodes out once
# more, while a further tier has a sixteenth of the rows, so short tiers move the least.
HEIGHT = 4
# A step of a proof while it climbs: a byte for the side of the sibling, and its hash.
STEP_BYTES, ALONE, LEFT, RIGHT = 33, "X'00'", "X'01'", "X'02'"
# Rows in a range of leaves, which one task numbers.
RANGE_ROWS = 250_000
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def digest(text: Column) -> Column:
    """SHA-256 of a text's UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def as_hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf_hash(fields: dict[str, Column]) -> Column:
    """Each field as its length in bytes, ``:`` and its value, or ``-`` for NULL; all of them hashed."""
    parts = [fields[c].cast("string") for c in FIELDS]
    marked = [F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return digest(F.concat(*marked))


def leaves(docs: DataFrame) -> DataFrame:
    """(key, doc_id, leaf, tampered): the language as a key that sorts NULL first, and both hashes.

    Where 7 divides the checksum of the doc_id, the tampered row has one character more.
    """
    own = {c: F.col(c) for c in FIELDS}
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    other = leaf_hash({**own, "n_chars": F.col("n_chars") + 1})
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("key"),
        "doc_id",
        leaf_hash(own).alias("leaf"),
        F.when(touched & F.col("n_chars").isNotNull(), other).alias("tampered"),
    )


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (written) with ``pos``, 0, 1, ... inside each ``key`` by ``order``, and ``n``, the key's rows."""
    spark = rows.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-rows.count() // RANGE_ROWS))
    one = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_one", F.lit(1).cast("bigint"))
    by = ["key", *order, "_row"]
    dealt = written(one.repartitionByRange(parts, *by).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return prefix_sums(dealt, ["key"], "_part", [*order, "_row"], "_one", "pos", sizes).drop("_row", "_one", "_part")


def _height(n: Column) -> Column:
    """Levels above the leaves in a chunk of a key that has ``n`` leaves in this tier."""
    return F.least(F.lit(HEIGHT), F.length(F.bin(n - 1)) - (n == 1).cast("int")).cast("int")


def _next_level(level: Column) -> Column:
    """Every two neighbours hashed; a last one without neighbour alone."""

    def parent(i: Column) -> Column:
        right = F.get(level, 2 * i + 1)
        return digest(F.concat(as_hex(F.get(level, 2 * i)), F.coalesce(as_hex(right), F.lit(""))))

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int")), parent)


def nodes(tier: DataFrame) -> DataFrame:
    """The rows of all chunks' levels: (key, chunk, node, parent, hash, sibling).

    Nodes are numbered as in a heap: the chunk's root is 1 and has no parent, a node's parent is half its
    number, and an odd one stands to the right of its sibling. ``sibling`` is NULL where there is none.
    """
    chunks = (
        tier.groupBy("key", F.expr(f"shiftright(pos, {HEIGHT})").alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "hash"))).alias("rows"), F.first("n").alias("n"))
        .withColumn("height", _height(F.col("n")))
    )
    first = F.array(F.col("rows.hash"))
    levels = F.aggregate(
        F.sequence(F.lit(1), F.col("height")), first,
        lambda done, _: F.concat(done, F.array(_next_level(F.element_at(done, -1)))),
    )
    # a sequence from 1 to 0 would count down
    levels = F.when(F.col("height") > 0, levels).otherwise(first)
    level = chunks.select("key", "chunk", "height", F.posexplode(levels).alias("level", "hashes"))
    each = level.select("*", F.posexplode("hashes").alias("at", "hash"))
    node = (F.expr("shiftleft(1, height - level)") + F.col("at")).cast("int")
    return each.select(
        "key", "chunk", node.alias("node"),
        F.when(F.col("level") < F.col("height"), F.shiftright(node, 1)).alias("parent"),
        "hash",
        F.when(F.col("level") < F.col("height"), F.get("hashes", F.col("at").bitwiseXOR(F.lit(1)))).alias("sibling"),
    )


def build(rows: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """(leaves, nodes) of each tier, from the lowest; ``rows`` have key, pos, n and hash.

    In the last tier every key has one chunk. A key that is done earlier goes on as a lone leaf.
    """
    tiers, most = [], rows.agg(F.max("n")).first()[0] or 0
    while True:
        stored = written(nodes(rows), "nodes")
        tiers.append((rows, stored))
        if most <= 1 << HEIGHT:
            return tiers
        most = -(-most // (1 << HEIGHT))
        n = F.col("_n")
        roots = stored.filter("node = 1").select("key", F.col("chunk").alias("pos"), "hash")
        sizes = rows.select("key", F.expr(f"shiftright(n - 1, {HEIGHT}) + 1").alias("_n")).distinct()
        rows = written(roots.join(sizes, "key").select("key", "pos", n.alias("n"), "hash"), "tier")


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """A recursive query may make as many rows as it needs; the session's limit is put back after."""
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.set(ROW_LIMIT, before)


STEP = f"""concat(CASE WHEN n.sibling IS NULL THEN {ALONE} WHEN c.node % 2 = 1 THEN {LEFT} ELSE {RIGHT} END,
                  coalesce(n.sibling, unhex(repeat('00', {STEP_BYTES - 1}))))"""
FOLD = """unhex(sha2(CASE WHEN n.sibling IS NULL THEN lower(hex(c.folded))
                          WHEN c.node % 2 = 1 THEN concat(lower(hex(n.sibling)), lower(hex(c.folded)))
                          ELSE concat(lower(hex(c.folded)), lower(hex(n.sibling))) END, 256))"""
# {carry} and {carried} are the leaf's own columns, {start} and {stored} the frames
CLIMB = f"""
WITH RECURSIVE climb(key, chunk, node, folded, proof, {{carry}}) AS (
  SELECT key, chunk, node, folded, CAST('' AS BINARY), {{carry}} FROM {{{{start}}}}
  UNION ALL
  SELECT c.key, c.chunk, n.parent, {FOLD}, concat(c.proof, {STEP}), {{carried}}
  FROM climb c JOIN {{{{stored}}}} n ON c.key = n.key AND c.chunk = n.chunk AND c.node = n.node
  WHERE c.node > 1
)
SELECT key, chunk, folded, proof, {{carry}} FROM climb WHERE node = 1
"""


def steps(proof: Column) -> Column:
    """A proof's steps as an array, from the leaf up."""
    last = F.length(proof) / STEP_BYTES - 1
    each = F.transform(
        F.sequence(F.lit(0), last.cast("int")), lambda i: F.substr(proof, i * STEP_BYTES + 1, F.lit(STEP_BYTES))
    )
    # a sequence from 0 to -1 would count down
    return F.when(F.length(proof) > 0, each).otherwise(F.array().cast("array<binary>"))


def _side(step: Column, side: str) -> Column:
    return F.substr(step, F.lit(1), F.lit(1)) == F.expr(side)


def _sibling(step: Column) -> Column:
    return F.substr(step, F.lit(2), F.lit(STEP_BYTES - 1))


def _fold(start: Column, proof: Column) -> Column:
    """``start`` hashed with each step's sibling on its side."""

    def up(own: Column, step: Column) -> Column:
        mine, other = as_hex(own), as_hex(_sibling(step))
        both = F.when(_side(step, LEFT), F.concat(other, mine)).when(_side(step, RIGHT), F.concat(mine, other))
        return digest(both.otherwise(mine))

    return F.aggregate(steps(proof), start, up)


def climb(tier: DataFrame, stored: DataFrame, above: DataFrame, folded: Column, carry: tuple[str, ...]) -> DataFrame:
    """(key, proof, folded, subroot, root) and ``carry`` of every leaf of a tier, by the recursive query.

    ``above`` has (key, chunk, proof, subroot, root): the way on from each chunk's root.
    """
    node = F.expr("shiftleft(1, _height)") + (F.col("pos") % (1 << HEIGHT)).cast("int")
    start = tier.withColumn("_height", _height(F.col("n"))).select(
        "key", F.expr(f"shiftright(pos, {HEIGHT})").alias("chunk"), node.alias("node"), folded.alias("folded"), *carry
    )
    inside = stored.filter("parent IS NOT NULL").select("key", "chunk", "node", "parent", "sibling")
    query = CLIMB.format(carry=", ".join(carry), carried=", ".join(f"c.{c}" for c in carry))
    climbed = tier.sparkSession.sql(query, start=start, stored=inside)
    joined = climbed.join(above.withColumnRenamed("proof", "_proof"), ["key", "chunk"])
    return joined.select(
        "key", *carry, F.concat("proof", "_proof").alias("proof"),
        _fold(F.col("folded"), F.col("_proof")).alias("folded"), "subroot", "root",
    )


def _ways(tiers: list[tuple[DataFrame, DataFrame]], above: DataFrame) -> DataFrame:
    """(key, pos, proof, subroot, root) of the leaves of ``tiers[0]``, from the last tier down."""
    for rows, stored in reversed(tiers):
        found = written(climb(rows, stored, above, F.col("hash"), ("pos",)), "ways")
        above = found.select("key", F.col("pos").alias("chunk"), "proof", "subroot", "root")
    return above.withColumnRenamed("chunk", "pos")


def _roots(tiers: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(key, hash): each key's root, from its one chunk of the last tier."""
    return tiers[-1][1].filter("node = 1").select("key", "hash")


def _climbed(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, folded and proof of every row; runs under ``_any_number_of_rows``."""
    one_chunk = F.lit(0).cast("bigint").alias("chunk")
    tier = numbered(written(leaves(docs), "leaves"), "doc_id", "leaf")
    rows = written(tier.withColumnRenamed("leaf", "hash"), "tier")
    trees = build(rows)
    # the languages' roots are leaves of a tree under one key, in the order of their own keys
    named = _roots(trees).select(F.lit("").alias("key"), F.col("key").alias("name"), "hash")
    langs = written(numbered(written(named, "subroots"), "name"), "tier")
    top = build(langs.select("key", "pos", "n", "hash"))
    root = _roots(top).select("key", one_chunk, F.lit(b"").alias("proof"), F.col("hash").alias("root"))
    ways = _ways(top, root.withColumn("subroot", F.col("root"))).drop("key", "subroot")
    own = langs.select("pos", F.col("name").alias("key"), F.col("hash").alias("subroot"))
    above = ways.join(own, "pos").select("key", one_chunk, "proof", "subroot", "root")
    if trees[1:]:
        above = _ways(trees[1:], above).withColumnRenamed("pos", "chunk")
    found = climb(*trees[0], above, F.coalesce("tampered", "hash"), ("doc_id", "hash"))
    return found.drop("key").withColumnRenamed("hash", "leaf")


def manifest(docs: DataFrame) -> DataFrame:
    """Every row's leaf, proof and both roots; ``folded`` is the root recomputed from the tampered leaf.

    Columns: doc_id, and as bytes leaf, subroot, root, folded; proof is an array of (left, hash), a step for
    each level, whose hash is NULL where a node has no neighbour.
    """

    def step(s: Column) -> Column:
        return F.struct(
            _side(s, LEFT).alias("left"), F.when(~_side(s, ALONE), _sibling(s)).alias("hash")
        )

    with _any_number_of_rows(docs.sparkSession):
        stored = written(_climbed(docs), "manifest")
    return stored.withColumn("proof", F.transform(steps(F.col("proof")), step))


def manifest_digests(docs: DataFrame) -> DataFrame:
    """The manifest in hexadecimal text, its proofs hashed, and whether the fold still gives the root."""
    siblings = F.transform(
        steps(F.col("proof")), lambda s: F.when(_side(s, ALONE), F.lit("")).otherwise(as_hex(_sibling(s)))
    )
    with _any_number_of_rows(docs.sparkSession):
        # the hash is stored, not the proof
        hashed = _climbed(docs).withColumn("proof", digest(F.array_join(siblings, "")))
        stored = written(hashed, "manifest")
    return stored.select(
        "doc_id",
        *[as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        as_hex(F.col("proof")).alias("proof_sha256"),
        as_hex(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
