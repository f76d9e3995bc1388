"""Column → Column helpers. All built-in expressions: they run inside whole-stage codegen.

The pipeline's semantics were defined on Spark 2.4 (non-ANSI casts, legacy date
parser). Spark 4.x runs ANSI mode, where ``cast`` throws and ``to_date('')``
throws, so each helper states the older result explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# --- Fixed values: patterns and formats of the source data -------------------
INT_TEXT = r"^\s*([+-]?\d+)(\.\d*)?\s*$"  # '171', ' 171 ', '171.5' (fraction truncated)
FRACTION_ONLY_TEXT = r"^\s*[+-]?\.\d*\s*$"  # '.5', '-.5', '.' → 0 under the non-ANSI cast
DATE_IN_TEXT = r"(\d{1,2} \w+ \d{4})"  # first 'd Month yyyy' inside free text
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
MALE = "Male"
NO_MEDAL = "NoMedal"
# -----------------------------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int_lenient(c: ColumnOrName) -> Column:
    """String → int with the non-ANSI cast result: NULL (never an error) on bad text.

    ``'171'``/``' 171 '``/``'171.5'`` → 171, ``'.5'``/``'.'`` → 0, ``'62-64'``/``'1e2'``/
    ``''``/out-of-range → NULL. Checked against Spark's own non-ANSI cast in the tests.
    """
    c = _col(c)
    digits = F.nullif(F.regexp_extract(c, INT_TEXT, 1), F.lit(""))
    slow = F.when(c.rlike(FRACTION_ONLY_TEXT), F.lit(0)).otherwise(digits.try_cast("int"))
    # Fast path: plain integer text needs no regex; ``coalesce`` evaluates the
    # regex branch only for the rows the plain cast rejects.
    return F.coalesce(c.try_cast("int"), slow)


def to_bool(c: ColumnOrName) -> Column:
    """String → boolean (``'True'``/``'false'``/``'1'``…); NULL on anything else."""
    return _col(c).try_cast("boolean")


def extract_date_text(c: ColumnOrName) -> Column:
    """First ``d Month yyyy`` in free text, ``''`` when there is none (ASCII ``\\w``)."""
    return F.regexp_extract(_col(c), DATE_IN_TEXT, 1)


# The legacy ``d MMMM yyyy`` / ``d MMMM`` parser (SimpleDateFormat, not lenient):
# one blank between fields; further blanks and tabs skipped before a number (day, year) but
# not before the month; day and year any number of digits (year ≥ 1), the month a full or
# three-letter English name in any case (longest name wins), anything after the last field
# ignored, impossible dates (31 November) rejected. Other white space is not skipped.
# The pattern runs once per value; the match is split on its blanks and tabs.
_MONTH_NAME = "(?i:" + "|".join(MONTHS) + "|" + "|".join(m[:3] for m in MONTHS) + ")"
_DAY_MONTH = rf"^[ \t]*\d+ {_MONTH_NAME}"
_DAY_MONTH_YEAR = rf"{_DAY_MONTH} [ \t]*\d*[1-9]\d*"
_NO_YEAR = 1970  # the year a year-less date gets


def _month_number(name: Column) -> Column:
    months = F.create_map(*[x for i, m in enumerate(MONTHS, start=1) for x in (F.lit(m[:3].lower()), F.lit(i))])
    return F.try_element_at(months, F.lower(F.substring(name, 1, 3)))


def _date_from(parts: Column, year: Column) -> Column:
    """``parts`` = [day, month name, ...]; NULL parts or impossible dates give NULL."""
    day, month = F.get(parts, 0).try_cast("int"), _month_number(F.get(parts, 1))
    padded = lambda n, width: F.lpad(n.cast("string"), width, "0")
    iso = F.concat_ws("-", F.when(year > 9999, year.cast("string")).otherwise(padded(year, 4)), padded(month, 2), padded(day, 2))
    # concat_ws skips NULLs, and lpad cuts: both only after the parts are known to fit
    return F.when((day <= 31) & month.isNotNull() & year.isNotNull(), iso.try_cast("date"))


def _fields(c: ColumnOrName, pattern: str) -> Column:
    return F.split(F.trim(F.regexp_extract(_col(c), pattern, 0), F.lit(" \t")), "[ \t]+")


def parse_date(c: ColumnOrName) -> Column:
    """``d MMMM yyyy`` text → date as the legacy parser reads it; NULL when it cannot."""
    parts = _fields(c, _DAY_MONTH_YEAR)
    return _date_from(parts, F.get(parts, 2).try_cast("int"))


def parse_text_date(c: ColumnOrName) -> Column:
    """``'12 – 13 July 1996'`` → 1996-07-13; NULL when the text holds no valid date."""
    return parse_date(extract_date_text(c))


def parse_day_month(c: ColumnOrName) -> Column:
    """Year-less ``d Month`` → date in 1970, ignoring any tail as the legacy parser did.

    ``' 6 April'`` → 1970-04-06, ``'23 July 2021'`` → 1970-07-23, ``'29 February'`` → NULL.
    """
    parts = _fields(c, _DAY_MONTH)
    return _date_from(parts, F.lit(_NO_YEAR))


def male_flag(c: ColumnOrName) -> Column:
    """1 for exactly ``'Male'``, else 0 (NULL and any other text count as 0)."""
    return F.when(_col(c) == F.lit(MALE), F.lit(1)).otherwise(F.lit(0))


def count_where(cond: Column) -> Column:
    """Conditional count: number of rows where ``cond`` is true; 0 (not NULL) on none."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def is_null_flag(c: ColumnOrName) -> Column:
    return _col(c).isNull().cast("int")


def total_of(*cols: ColumnOrName) -> Column:
    """Plain ``a + b + c``: NULL as soon as one part is NULL."""
    parts = [_col(c) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out
