"""The six bronze datasets, derived by Spark from the TPC-H-like test tables.

Every role is an all-string frame with the bronze columns, so the silver and
gold code runs on them unchanged. The work grows with the source tables: each
role is a scan (plus one join for event results) of ``customer``, ``orders``,
``lineitem`` or ``nation``. Dirt (bad numbers, missing values, orphan keys, a
duplicate country code) is injected deterministically from the keys so that the
SQL oracle builds the very same rows; no row is sampled away.

Mapping: athlete ← customer, result ← order, athlete-event row ← line item,
edition ← order year, country ← nations of the athletes (``NATION_k``), medal
tally ← order counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: formulas shared with the SQL oracle (strata/plans/oracle_sql.py)
FIRST_YEAR_BEFORE = 1994  # edition_id = year - 1994
NATIONS = 25  # country of an athlete = custkey % 25
MISSING_NATION = 24  # left out of the country list (unknown country)
TWIN_NATION = 20  # listed twice (duplicate country code); hosts the edition of 1995
NO_GAMES_YEAR = 1997  # edition of events and tally that the games and dates lack
NO_DATE_YEAR = 1999  # edition without start/end dates
YEAR_TAIL_YEAR = 2000  # edition whose dates carry a trailing year
MISSING_TALLY = ("1", "NATION_0")  # (edition_id, country_noc) without a medal tally
# -----------------------------------------------------------------------------


class Tables:
    """The test tables of one scale-factor folder, each opened once.

    Opening a Parquet table lists its files and reads a footer; a query that
    uses ``orders`` for four roles should do that once, not four times.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._open: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._open[name]


def _s(c: Column) -> Column:
    return c.cast("string")


def _cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else _s(p) for p in parts])


def _nation_code(key: Column) -> Column:
    return _cat("NATION_", key % NATIONS)


def _edition_id(year: Column) -> Column:
    return _s(year - FIRST_YEAR_BEFORE)


def country(t: Tables) -> DataFrame:
    """Olympics_Country(noc, country): the nations of the athlete register, one left out, one twice.

    The codes come from the athletes (``customer``), the names from ``nation``.
    """
    codes = t("customer").select((F.col("c_custkey") % NATIONS).cast("int").alias("__code")).distinct()
    n = t("nation").join(codes, F.col("n_nationkey") == F.col("__code"), "inner")
    listed = n.filter(F.col("n_nationkey") != MISSING_NATION).select(
        F.col("n_name").alias("noc"), _cat("Country ", F.col("n_nationkey")).alias("country")
    )
    twin = n.filter(F.col("n_nationkey") == TWIN_NATION).select(
        F.col("n_name").alias("noc"), _cat("Country ", F.col("n_nationkey"), " (bis)").alias("country")
    )
    return listed.unionByName(twin)


def games(t: Tables) -> DataFrame:
    """Olympics_Games: one edition per order year; dates as ``d Month`` text."""
    yr = F.col("yr")
    host = yr % NATIONS
    start = (
        F.when(yr == NO_DATE_YEAR, F.lit(None).cast("string"))
        .when(yr == YEAR_TAIL_YEAR, F.lit("23 July 2001"))
        .otherwise(_cat(" ", 1 + yr % 9, " April"))
    )
    end = (
        F.when(yr == NO_DATE_YEAR, F.lit(None).cast("string"))
        .when(yr == YEAR_TAIL_YEAR, F.lit(" 8 August 2001"))
        .otherwise(_cat(10 + yr % 9, " May"))
    )
    years = t("orders").select(F.year("o_orderdate").alias("yr")).distinct().filter(yr != NO_GAMES_YEAR)
    return years.select(
        _cat(yr, " Summer Games").alias("edition"),
        _edition_id(yr).alias("edition_id"),
        _cat("/editions/", yr - FIRST_YEAR_BEFORE).alias("edition_url"),
        _s(yr).alias("year"),
        _cat("City ", host).alias("city"),
        _cat("/flags/NATION_", host, ".png").alias("country_flag_url"),
        _cat("NATION_", host).alias("country_noc"),
        start.alias("start_date"),
        end.alias("end_date"),
        F.lit(None).cast("string").alias("competition_date"),
        F.lit(None).cast("string").alias("isHeld"),
    )


def athlete_bio(t: Tables) -> DataFrame:
    """Olympic_Athlete_Bio: one athlete per customer, with bad and missing values."""
    k = F.col("c_custkey")
    born_day = F.date_add(F.lit("1950-01-01").cast("date"), (k % 15000).cast("int"))
    null = F.lit(None).cast("string")
    return t("customer").select(
        F.when(k % 23 == 0, _cat("-", k)).otherwise(_s(k)).alias("athlete_id"),
        F.col("c_name").alias("name"),
        F.when(k % 5 == 0, null).when(k % 2 == 0, F.lit("Male")).otherwise(F.lit("Female")).alias("sex"),
        F.when(k % 11 == 0, null)
        .when(k % 13 == 0, F.lit("unknown"))
        # blanks and a tab before the year: read; a tab right after the day: not
        .when(k % 31 == 0, F.concat(F.date_format(born_day, "d MMMM  "), F.lit("\t"), F.date_format(born_day, "yyyy")))
        .when(k % 37 == 0, F.concat(F.date_format(born_day, "d"), F.lit("\t"), F.date_format(born_day, "MMMM yyyy")))
        .otherwise(F.date_format(born_day, "d MMMM yyyy"))
        .alias("born"),
        F.when(k % 7 == 0, null).when(k % 19 == 0, F.lit("171.5")).otherwise(_s(150 + k % 60)).alias("height"),
        F.when(k % 17 == 0, F.lit("62-64")).otherwise(_s(45 + k % 70)).alias("weight"),
        _cat("Country ", k % NATIONS).alias("country"),
        _nation_code(k).alias("country_noc"),
        F.col("c_mktsegment").alias("description"),
        null.alias("special_notes"),
    )


def event_results(t: Tables) -> DataFrame:
    """Olympic_Athlete_Event_Results: one row per line item (athlete = the order's customer)."""
    li = t("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    od = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lo = li.join(od, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    flag = F.col("l_returnflag")
    return lo.select(
        _edition_id(F.year("o_orderdate")).alias("edition_id"),
        _nation_code(F.col("o_custkey")).alias("country_noc"),
        _s(F.col("l_orderkey")).alias("result_id"),
        _s(F.col("o_custkey")).alias("athlete_id"),
        _s(F.col("l_linenumber")).alias("pos"),
        F.when(flag == "R", F.lit("Gold")).when(flag == "A", F.lit("Silver")).alias("medal"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("True")).otherwise(F.lit("False")).alias("isTeamSport"),
        _cat("Event ", F.col("l_partkey") % 40).alias("event"),
    )


def medal_tally(t: Tables) -> DataFrame:
    """Olympic_Games_Medal_Tally: per (edition, country) counts of orders by status.

    Bounded by editions × nations; one (edition, country) pair is left out.
    """
    o = t("orders")
    status = F.col("o_orderstatus")
    counts = o.groupBy(
        _edition_id(F.year("o_orderdate")).alias("edition_id"),
        _nation_code(F.col("o_custkey")).alias("country_noc"),
    ).agg(
        F.count_if(status == "F").alias("gold"),
        F.count_if(status == "O").alias("silver"),
        F.count_if(status == "P").alias("bronze"),
        F.count(F.lit(1)).alias("total"),
    )
    missing = (F.col("edition_id") == MISSING_TALLY[0]) & (F.col("country_noc") == MISSING_TALLY[1])
    return counts.filter(~missing).select(
        "edition_id", "country_noc", *[_s(F.col(c)).alias(c) for c in ("gold", "silver", "bronze", "total")]
    )


def results(t: Tables) -> DataFrame:
    """Olympic_Results: one result per order; the date sits inside free text."""
    k = F.col("o_orderkey")
    day_text = F.date_format("o_orderdate", "d MMMM yyyy")
    yr = F.year("o_orderdate")
    return t("orders").select(
        F.when(k % 19 == 0, _cat("r", k)).otherwise(_s(k)).alias("result_id"),
        _cat("Final ", F.col("o_orderpriority")).alias("event_title"),
        _cat(yr, " Summer Games").alias("edition"),
        _edition_id(yr).alias("edition_id"),
        F.col("o_orderpriority").alias("sport"),
        _cat("/sports/", F.col("o_orderstatus")).alias("sport_url"),
        F.when(k % 29 == 0, F.lit("date unknown"))
        .when(k % 3 == 0, F.concat(F.lit("1 – "), day_text))
        .otherwise(F.concat(day_text, F.lit(", final")))
        .alias("result_date"),
        F.when(k % 23 == 0, F.lit(None).cast("string"))
        .otherwise(_cat("Venue ", F.col("o_custkey") % 100))
        .alias("result_location"),
        _cat(1 + F.col("o_custkey") % 40, " from ", 1 + F.col("o_custkey") % 12, " countries").alias(
            "result_participants"
        ),
    )


BUILDERS = {
    "Olympics_Country": country,
    "Olympics_Games": games,
    "Olympic_Athlete_Bio": athlete_bio,
    "Olympic_Athlete_Event_Results": event_results,
    "Olympic_Games_Medal_Tally": medal_tally,
    "Olympic_Results": results,
}


def all_roles(t: Tables) -> dict[str, DataFrame]:
    return {name: build(t) for name, build in BUILDERS.items()}
