"""Document fingerprints: a Merkle tree over paragraphs and sections, long paragraphs divided further.

A paragraph is a line, its digest that of its text; a section is a run of paragraphs that ends where a
paragraph's own hash says so, so that an edit moves no other boundary. The digest of a section covers its
paragraphs' digests, and the root covers the sections': equal roots, equal texts. Where roots differ, only
unequal sections, and in them unequal paragraphs, are gone into, which locates the edits (``differing``).
Long paragraphs, and all those of short texts, also have parts: sentences, cut every ``PART_WORDS`` words.

The fingerprint is one string: the root, then each section's digest and paragraphs, each with its digest,
length and parts. Stored digests have 64 bits, the root 128. ``likeness`` is the share of characters in
paragraphs, or else parts, that both trees hold.

The next document of each one is found without sorting all in one task: ids are cut into ranges at
their quantiles, the table is dealt out by range once, and the first document of every range is also
dealt to the range before. Only the range bounds, at most ``MAX_RANGES`` of them, reach the driver. An id that
fills more than one range, and rows without one, are dealt on by a hash of their text; their equal rows are
counted first and compared once.

Defined cases: NULL text is the empty text; two empty texts have likeness 1. Descending doc_id, NULL ids
last; rows that share an id (or have none) go by a hash of their text. A lone document is its own next.
Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from base64 import urlsafe_b64encode
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship, written

PART_WORDS = 16
# A section ends after a paragraph whose hash is a multiple of this.
SECTION = 4
RANGE_ROWS = 1000
MAX_RANGES = 1 << 16

# Parts of a paragraph up to this length are its words.
SHORT = 64
# Paragraphs up to SHORT keep their parts in texts up to this length only.
SHORT_TEXT = 256

_SPACED = re.compile(r"\S+\s*|\s+")
_SENTENCE = re.compile(r"[^.!?…]*[.!?…]+\s*|[^.!?…]+")
# white space after each word is required: otherwise a word could be split in many ways
_PART = re.compile(rf"(?:\S++\s++){{{PART_WORDS}}}")


def _parts(paragraph: str) -> list[str]:
    """The paragraph's parts; put together they are the paragraph."""
    if len(paragraph) <= SHORT:
        return _SPACED.findall(paragraph)
    out = []
    for s in _SENTENCE.findall(paragraph):
        if len(s) <= 4 * PART_WORDS:  # too short to hold more than the words of one part, or nearly
            out.append(s)
            continue
        at = 0
        for m in _PART.finditer(s):
            if m.start() == at:
                out.append(m.group())
                at = m.end()
        if at < len(s):
            out.append(s[at:])
    return out


def _short(digest: bytes) -> str:
    """64 bits of a digest in 11 characters, none of which separates nodes."""
    return urlsafe_b64encode(digest[:8])[:11].decode()


def _paragraph(text: str, with_parts: bool) -> tuple[bytes, str]:
    """The paragraph's digest, and how the fingerprint writes it."""
    raw = text.encode("utf-8", "surrogatepass")
    digest = hashlib.blake2b(raw, digest_size=16).digest()
    nodes = [f"{_short(digest)}.{len(text)}"]
    if with_parts:
        for part in _parts(text):
            nodes.append(f"{_short(xxhash.xxh3_64_digest(part.encode('utf-8', 'surrogatepass')))}.{len(part)}")
    return digest, " ".join(nodes)


def fingerprint(text: str | None, known: dict[tuple[str, bool], tuple[bytes, str]] | None = None) -> str:
    """root|section:paragraph part part,paragraph;section:... ``known`` keeps paragraphs between calls."""
    text = text or ""
    known = {} if known is None else known
    sections, section, node = [], [], hashlib.blake2b(digest_size=16)
    root = hashlib.blake2b(digest_size=16)

    def close() -> None:
        digest = node.digest()
        root.update(digest)
        sections.append(f"{_short(digest)}:{','.join(section)}")

    for paragraph in text.split("\n"):
        key = (paragraph, len(paragraph) > SHORT or len(text) <= SHORT_TEXT)
        if key not in known:
            known[key] = _paragraph(*key)
        digest, nodes = known[key]
        node.update(digest)
        section.append(nodes)
        if digest[0] % SECTION == 0:
            close()
            section, node = [], hashlib.blake2b(digest_size=16)
    if section:
        close()
    return f"{root.hexdigest()}|{';'.join(sections)}"


def _weight(node: str) -> int:
    return int(node.partition(".")[2])


def _sections(print_: str) -> list[str]:
    return print_.partition("|")[2].split(";")


def _paragraphs(sections: Counter) -> Counter:
    """Paragraphs, with their parts, of counted sections."""
    out: Counter = Counter()
    for s, n in sections.items():
        for p in s.partition(":")[2].split(","):
            out[p] += n
    return out


def _bare(paragraphs: Counter) -> Counter:
    """Paragraphs without their parts, as the trees of a short and a long text may differ in those."""
    out: Counter = Counter()
    for p, n in paragraphs.items():
        out[p.partition(" ")[0]] += n
    return out


def _parts_left(paragraphs: Counter, common: Counter) -> Counter:
    """Parts of the paragraphs that are not common."""
    left, out = Counter(common), Counter()
    for p, n in paragraphs.items():
        bare, _, parts = p.partition(" ")
        take = min(n, left[bare])
        left[bare] -= take
        for part in parts.split(" ") if parts and n > take else ():
            out[part] += n - take
    return out


def _size(nodes: Counter) -> int:
    return sum(_weight(v) * n for v, n in nodes.items())


def likeness(a: str, b: str) -> float:
    """2 * common characters / all characters; equal roots, sections and paragraphs are not gone into."""
    if a == b:
        return 1.0
    x, y = Counter(_sections(a)), Counter(_sections(b))
    same = x & y
    common = _size(_bare(_paragraphs(same)))
    left, right = _paragraphs(x - same), _paragraphs(y - same)
    bare_left, bare_right = _bare(left), _bare(right)
    every = 2 * common + _size(bare_left) + _size(bare_right)
    both = bare_left & bare_right
    common += _size(both) + _size(_parts_left(left, both) & _parts_left(right, both))
    return 2 * common / every if every else 0.0


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(start, length) of the stretches of ``a``'s text whose nodes ``b`` does not hold."""
    if a == b:
        return []
    other = _sections(b)
    sections = set(other)
    paragraphs = [p for s in other for p in s.partition(":")[2].split(",")]
    bare = {p.partition(" ")[0] for p in paragraphs}
    parts = {v for p in paragraphs for v in p.split(" ")[1:]}
    out: list[tuple[int, int]] = []
    at = 0

    def lost(start: int, length: int) -> None:
        if out and sum(out[-1]) == start:
            out[-1] = (out[-1][0], out[-1][1] + length)
        elif length:
            out.append((start, length))

    for s in _sections(a):
        known = s in sections
        for p in s.partition(":")[2].split(","):
            node, *below = p.split(" ")
            if not known and node not in bare:
                start = at
                for part in below or [node]:
                    if part not in parts:
                        lost(start, _weight(part))
                    start += _weight(part)
            at += _weight(node) + 1  # the line end
    return out


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by the first as many characters of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_SCHEMA = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, edits array<struct<start: bigint, length: bigint>>"
)
_COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edits"]


def _compare(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    last: tuple[str | None, str] = (None, "")
    for texts, nexts in batches:
        out = []
        for text, following in zip(texts, nexts, strict=True):
            known: dict = {}  # paragraphs of this row's texts
            # rows come in order, so this text was the last row's next one
            own = last[1] if text == last[0] else fingerprint(text, known)
            last = (following, own if following == text else fingerprint(following, known))
            new = edited(text, following)
            changed = own if new == text else fingerprint(new, known)
            sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
            edits = [{"start": at, "length": n} for at, n in differing(own, changed)]
            out.append((len(text), sha, own, changed, likeness(own, changed), likeness(own, last[1]), edits))
        yield pd.DataFrame(out, columns=_COLUMNS)


def _cuts(docs: DataFrame, range_rows: int) -> tuple[list[int], int]:
    """The ids at the quantiles, repeated where an id fills more than one range; ranges of rows without id."""
    n, known = docs.agg(F.count("*"), F.count("doc_id")).first()
    parts = min(MAX_RANGES, known // range_rows + 1)
    at = [k / parts for k in range(1, parts)]
    found = docs.agg(F.percentile_approx("doc_id", at, 20 * parts)).first()[0] if at else []
    return sorted(found or []), min(MAX_RANGES, (n - known) // range_rows + 1)


def _placed(base: DataFrame, cuts: list[int], without_id: int) -> DataFrame:
    """``base`` with its range: ``_range`` 0 for the largest ids, and ``_sub`` inside a hot id's."""
    times = Counter(cuts)
    bounds = np.array(sorted(times), dtype=np.int64)
    subs = np.array([times[b] if times[b] > 1 else 0 for b in bounds], dtype=np.int64)

    @F.pandas_udf("struct<range: bigint, subs: bigint>")
    def place(ids: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(bounds, ids.to_numpy(), side="left")
        hot = np.zeros(len(at), dtype=np.int64)
        inside = at < len(bounds)
        hit = inside.copy()
        hit[inside] = bounds[at[inside]] == ids.to_numpy()[inside]
        hot[hit] = subs[at[hit]]
        return pd.DataFrame({"range": len(bounds) - at, "subs": hot})

    some = F.col("doc_id").isNotNull()
    df = base.withColumn("_p", place(F.coalesce("doc_id", F.lit(0))))
    df = df.withColumn("_range", F.when(some, F.col("_p.range")).otherwise(F.lit(len(bounds) + 1)))
    df = df.withColumn("_subs", F.when(some, F.col("_p.subs")).otherwise(F.lit(without_id)))
    # a hot id is the largest of its range: its rows in order of their hash, then the other ids'
    share = F.shiftright("_hash", 32) + F.lit(1 << 31)  # 0 to 2^32, ascending with the hash
    sub = F.shiftright(share * F.col("_subs"), 32)
    return df.withColumn("_sub", F.when(F.col("_subs") > 0, sub).otherwise(F.lit(1 << 32))).drop("_p", "_subs")


def _counted(docs: DataFrame, cuts: list[int]) -> DataFrame:
    """doc_id, text, copies: equal rows of hot ids, or without id, as one; the other rows as they are."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    many = F.col("doc_id").isNull()
    if hot := [i for i, n in Counter(cuts).items() if n > 1]:
        many = many | F.col("doc_id").isin(hot)
    alike = base.filter(many).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    return base.filter(~many).withColumn("copies", F.lit(1).cast("bigint")).union(alike)


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, text, next_text, copies): each document with the one that follows in descending doc_id.

    ``copies`` is how many rows of ``docs`` the row stands for.
    """
    ship(docs.sparkSession)
    cuts, without_id = _cuts(docs, range_rows)
    base = _placed(_counted(docs, cuts).withColumn("_hash", F.xxhash64("text")), cuts, without_id)
    # the first row of each range also goes to the range before it; the very first one to the last range
    order_key = F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("down"), F.col("_hash").alias("hash"))
    firsts = base.groupBy("_range", "_sub").agg(F.min(order_key).alias("_first"))
    order = Window.orderBy("_range", "_sub")  # one row for each range: at most 3 * MAX_RANGES + 1
    before = F.lag(F.struct("_range", "_sub")).over(order)
    last = F.max(F.struct("_range", "_sub")).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsts = firsts.select(
        F.col("_range").alias("_r"), F.col("_sub").alias("_s"), (-F.col("_first.down")).alias("_id"),
        F.col("_first.hash").alias("_h"), F.coalesce(before, last).alias("_guest_in"),
    )
    firsts = written(firsts, "ranges")
    is_first = (
        (F.col("_range") == F.col("_r")) & (F.col("_sub") == F.col("_s"))
        & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h"))
    )
    hosted = base.join(F.broadcast(firsts), is_first, "left")
    places = F.array(
        F.struct(F.col("_range").alias("r"), F.col("_sub").alias("s"), F.lit(0).alias("guest")),
        F.when(
            F.col("_r").isNotNull(),
            F.struct(F.col("_guest_in._range").alias("r"), F.col("_guest_in._sub").alias("s"), F.lit(1).alias("guest")),
        ),
    )
    dealt = hosted.select("doc_id", "text", "copies", "_hash", F.explode(F.filter(places, lambda p: p.isNotNull())).alias("p"))
    dealt = dealt.select("doc_id", "text", "copies", "_hash", "p.*")
    inside = Window.partitionBy("r", "s").orderBy("guest", F.desc_nulls_last("doc_id"), "_hash", "text")
    found = dealt.withColumn("next_text", F.lead("text").over(inside)).filter("guest = 0")
    found = found.select("doc_id", "text", "next_text", "copies")
    # of equal rows, all but the last are followed by their like
    one = F.struct("next_text", F.lit(1).cast("bigint").alias("copies"))
    like = F.struct(F.col("text").alias("next_text"), (F.col("copies") - 1).alias("copies"))
    each = found.select("doc_id", "text", F.explode(F.when(F.col("copies") > 1, F.array(like, one)).otherwise(F.array(one))).alias("f"))
    return each.select("doc_id", "text", "f.*")


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edits.

    ``edits`` are the stretches of the text that the edited one does not hold.
    """
    compared = F.pandas_udf(_compare, _SCHEMA)
    rows = with_next(docs, range_rows).select("doc_id", "copies", compared("text", "next_text").alias("f"))
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return rows.select("doc_id", "f.*")
