"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a built-in expression over the whole text, and every rule is a row of ``RULES``
(metric, lower bound, upper bound). ``quality_rules`` compiles the table into columns of one
projection: no user function, no shuffle, one pass over the documents.

Defined cases: NULL text counts as a text without words or lines (it fails ``min_words``); an empty
text likewise. Repeated rows each get their own row. A ratio whose denominator is 0 is 0. Stop words
are known of ``LANGUAGES``: where ``lang`` names another language their ratio is NULL and its rule holds; where
it is NULL, or there is no such column, any of the languages' words count. Extra columns are dropped by ``quality_rules`` and kept by ``keep_good``. An empty table gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, documents_like, free_name

SYMBOLS = "#*$%&|<>"  # fixed by the contract, as are the next two
MIN_WORDS = 50
# Of 100 words, so many at most may stand in a 3-word window that the text repeats.
MAX_REPEATED_PERCENT = 50

# Function words of the languages served: about a fifth of the words of a text in one of them.
LANGUAGES = ("en", "de", "fr", "es")
STOP_WORDS = (
    "the of and to in is that with for it as was on by are this or an at be "
    "der die das und zu von in den mit ist ein eine im nicht sich auf "
    "le la les de des du et un une en que est dans pour par sur "
    "el los las del y o se por con una para su al lo como"
)


class Rule(NamedTuple):
    """A text passes when ``low <= metric <= high``; None leaves that side open."""

    name: str
    metric: str
    low: float | None
    high: float | None


# The bounds are wide: each rule removes texts that are plainly not prose.
RULES: tuple[Rule, ...] = (
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbols_per_word", None, 0.25),
    Rule("stop_words", "stop_word_share", 0.05, None),
    Rule("duplicate_lines", "dup_line_share", None, 0.5),
    Rule("bullet_lines", "bullet_line_share", None, 0.9),
    Rule("ellipsis_lines", "ellipsis_line_share", None, 0.5),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


# A window's key holds its position in the low bits, so texts up to this many words sort plain longs.
POSITION_BITS = 24


def _close(keys: str) -> Column:
    """Positions (x, y) of neighbouring windows with one hash.

    ``keys`` names the ascending array of (window hash, position) longs. Equal windows have equal hashes,
    so they are neighbours there, unless another window with their hash stands between: then
    some close neighbours are not equal, and ``_repeated_positions_long`` takes the text.
    """
    s = F.col(keys)
    at = lambda x: x.bitwiseAND((1 << POSITION_BITS) - 1).cast("int")
    close = F.zip_with(
        s, F.slice(s, 2, F.size(s)),
        lambda x, y: F.when(y - x < 1 << POSITION_BITS, F.struct(at(x).alias("x"), at(y).alias("y"))),
    )
    return F.filter(close, lambda v: v.isNotNull())


def _equal(hashes: str, close: str) -> Column:
    """Of close neighbours, those whose words have equal 64-bit ``hashes``."""
    w = F.col(hashes)
    same = lambda k: lambda v: F.get(w, v["x"] + k) == F.get(w, v["y"] + k)
    return F.filter(close, lambda v: same(0)(v) & same(1)(v) & same(2)(v))


def _positions(pairs: str) -> Column:
    both = F.flatten(F.transform(pairs, lambda v: F.array(v["x"], v["y"])))
    return F.sort_array(F.array_distinct(both))


def _repeated_positions_long(words: str) -> Column:
    """Start positions of the 3-word windows that occur twice or more, ascending, by the words themselves.

    For texts of 2**POSITION_BITS words or more, and those in which two windows share a hash.
    """
    w = F.col(words)
    windows = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("w"), i.alias("p")),
        )
    )
    pairs = F.zip_with(windows, F.slice(windows, 2, F.size(w)), lambda a, b: F.struct(a["p"].alias("p"), (a["w"] == b["w"]).alias("same"), b["p"].alias("q")))
    both = F.flatten(F.transform(F.filter(pairs, lambda x: x["same"]), lambda x: F.array(x["p"], x["q"])))
    return F.sort_array(F.array_distinct(both))


def _covered(starts: str) -> Column:
    """Words covered by 3-word windows at the ascending positions ``starts``."""
    s = F.col(starts)
    i = F.sequence(F.lit(0), F.size(s) - 1)
    gaps = F.transform(i, lambda k: F.least(F.lit(3), F.coalesce(F.get(s, k + 1) - F.get(s, k), F.lit(3))))
    return F.when(F.size(s) > 0, F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, g: a + g)).otherwise(
        F.lit(0).cast("bigint")
    )


def with_metrics(docs: DataFrame) -> DataFrame:
    """doc_id and the metrics of each text. The steps share columns, so no step is evaluated twice."""
    ws = F.lit(" \t\n\x0b\f\r")
    trimmed = F.trim(F.col("_t"), ws)
    none = F.array().cast("array<string>")
    words = F.when(trimmed != "", F.split(trimmed, f"[{SPACE}]+")).otherwise(none)
    lines = F.filter(F.split(F.col("_t"), "\n", -1), lambda x: F.trim(x, ws) != "")
    w, ln, h = F.col("_words"), F.col("_lines"), F.col("_hashes")
    # a 39-bit hash of each 3-word window above a free position: keys, and differences of ascending
    # keys, stay positive
    g, m = F.col("_word_hashes"), F.size("_word_hashes") - 2
    pairs = F.zip_with(F.slice(g, 1, m), F.slice(g, 2, m), lambda x, y: x.bitwiseXOR(F.shiftleft(y, 1)))
    windows = F.zip_with(
        pairs, F.slice(g, 3, m),
        lambda x, y: F.shiftrightunsigned(F.shiftleft(F.xxhash64(x, y), POSITION_BITS + 1), 1),
    )
    longs, ints = F.array().cast("array<bigint>"), F.array().cast("array<int>")
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    keys = F.sort_array(F.zip_with(h, F.sequence(F.lit(0), F.size(h) - 1), lambda x, i: x.bitwiseOR(i.cast("bigint"))))
    stops = sorted(set(STOP_WORDS.split()))
    count = lambda pattern: F.regexp_count(F.col("_t"), F.lit(pattern)).cast("bigint")
    line_count = lambda pattern: F.size(F.filter(ln, lambda x: x.rlike(pattern))).cast("bigint")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    df = docs.select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_t"),
        F.coalesce(F.lower(F.substring_index(lang, "-", 1)).isin(*LANGUAGES), F.lit(True)).alias("_known"),
    )
    df = df.withColumns({"_words": words, "_lines": lines})
    df = df.withColumn("_word_hashes", F.transform(w, lambda x: F.xxhash64(x)))
    df = df.withColumn("_hashes", F.when(F.size(w) >= 3, windows).otherwise(longs))
    df = df.withColumn("_keys", F.when(repeats, keys).otherwise(longs))
    df = df.withColumn("_close", _close("_keys")).withColumn("_equal", _equal("_word_hashes", "_close"))
    exact = (F.size(w) < 1 << POSITION_BITS) & (F.size("_equal") == F.size("_close"))
    df = df.withColumn(
        "_starts",
        F.when(F.size("_keys") == 0, ints).when(exact, _positions("_equal")).otherwise(_repeated_positions_long("_words")),
    )
    df = df.select(
        "doc_id",
        F.size("_words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        count(f"[{SYMBOLS}]").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _covered("_starts").alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.size(F.filter(w, lambda x: x.isin(*stops))).cast("bigint").alias("n_stop_words"), "_known",
        line_count(rf"^[{SPACE}]*[-*•]").alias("n_bullet_lines"),
        line_count(rf"(?:\.\.\.|…)[{SPACE}]*$").alias("n_ellipsis_lines"),
    )
    return df.withColumns(
        {
            "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
            "symbols_per_word": _ratio(F.col("n_symbols"), F.col("n_words")),
            "stop_word_share": F.when(F.col("_known"), _ratio(F.col("n_stop_words"), F.col("n_words"))),
            "dup_line_share": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
            "bullet_line_share": _ratio(F.col("n_bullet_lines"), F.col("n_lines")),
            "ellipsis_line_share": _ratio(F.col("n_ellipsis_lines"), F.col("n_lines")),
        }
    )


def _breaks(rule: Rule) -> Column:
    m = F.col(rule.metric)
    broken = F.lit(False)
    if rule.low is not None:
        broken = broken | (m < rule.low)
    if rule.high is not None:
        broken = broken | (m > rule.high)
    return F.coalesce(broken, F.lit(False))


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The rule table as one expression: the comma-joined names of the broken rules."""
    return F.concat_ws(",", *[F.when(_breaks(r), F.lit(r.name)) for r in rules])


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the base counts, ``base_failed``, ``kept`` and ``failed_rules`` (names, comma-joined)."""
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    df = with_metrics(docs).withColumns({"base_failed": base, "failed_rules": compiled(rules)})
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("failed_rules") == "")).alias("kept"), "failed_rules",
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.

    The metrics are computed beside the row (one projection, no join), so repeated or NULL ids are
    no matter.
    """
    row = free_name(docs.columns, "_row")
    used = [c for c in ("text", "lang") if c in docs.columns]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), *used)
    scored = quality_rules(packed.select(F.col(row).alias("doc_id"), *used), rules).filter("kept")
    return documents_like(scored.select("doc_id.*"), docs)
