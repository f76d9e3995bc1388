"""Silver layer: typed, cleaned dimensions and the fact table, from all-string bronze frames.

Each builder is ``DataFrame(s) → DataFrame`` and returns the published schema.
Join keys are compared as the raw bronze strings (``'01' ≠ '1'``); ids are cast
with the non-ANSI rules of ``to_int_lenient``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import (
    NO_MEDAL,
    male_flag,
    parse_date,
    parse_day_month,
    parse_text_date,
    to_bool,
    to_int_lenient,
)
from strata.operators.dedupe import keep_one
from strata.operators.impute import fill_constant, fill_mean
from strata.operators.quality import drop_null

# --- Fixed values: the numeric result-id pattern ----------------------------------
NUMERIC_ID = "^[0-9]+$"
# -----------------------------------------------------------------------------


def athlete_dim(bio: DataFrame) -> DataFrame:
    """Athlete(AthleteID, Name, Sex, Born, Height, Weight, Nationality).

    Order matters: rows without a birth text leave first, then NULL height and
    weight get the (truncated) mean of the remaining rows, then the birth text is
    parsed; an unparseable birth stays as a NULL ``Born``.
    """
    typed = drop_null(
        bio.select(
            to_int_lenient("athlete_id").alias("athlete_id"),
            "name",
            male_flag("sex").alias("sex"),
            "born",
            to_int_lenient("height").alias("height"),
            to_int_lenient("weight").alias("weight"),
            "country",
        ),
        ["born"],
    )
    filled = fill_mean(typed, ["height", "weight"])
    return filled.select(
        F.col("athlete_id").alias("AthleteID"),
        F.col("name").alias("Name"),
        F.col("sex").alias("Sex"),
        parse_date("born").alias("Born"),
        F.col("height").alias("Height"),
        F.col("weight").alias("Weight"),
        F.col("country").alias("Nationality"),
    )


def games_dim(games: DataFrame, country: DataFrame) -> DataFrame:
    """OlympicsGames(EditionID, EditionName, EditionURL, FlagURL, HostCity, HostCountry).

    Left join on the host code: an unknown host keeps its row with a NULL
    ``HostCountry``; a duplicated code repeats the edition.
    """
    hosts = country.select(F.col("noc").alias("__host_code"), F.col("country").alias("__host_country"))
    joined = games.join(hosts, F.col("country_noc") == F.col("__host_code"), "left")
    return joined.select(
        to_int_lenient("edition_id").alias("EditionID"),
        F.col("edition").alias("EditionName"),
        F.col("edition_url").alias("EditionURL"),
        F.col("country_flag_url").alias("FlagURL"),
        F.col("city").alias("HostCity"),
        F.col("__host_country").alias("HostCountry"),
    )


def event_per_result(events: DataFrame) -> DataFrame:
    """(event_result_id, isTeamSport, event): one row per result id.

    A result repeats its flag and event on every athlete's row: a hash distinct collapses
    those in each map task, and the sort-based pick of the survivor sees distinct rows only.
    """
    per_row = events.select(F.col("result_id").alias("event_result_id"), "isTeamSport", "event")
    return keep_one(per_row, ["event_result_id"], dedupe_first=True)


def results_dim(results: DataFrame, events: DataFrame) -> DataFrame:
    """OlympicResults(ResultID, EventTitle, EventName, Sport, SportURL, ResultDate,
    ResultLocation, ResultParticipants, IsTeamSport).

    Numeric result ids only; left join to one event row per id; rows without a
    location or without a parseable date inside the date text are dropped.
    """
    numeric = results.filter(F.col("result_id").rlike(NUMERIC_ID))
    joined = numeric.join(event_per_result(events), F.col("result_id") == F.col("event_result_id"), "left")
    located = drop_null(joined, ["result_location"])
    # one row for a parsed date, none for NULL: unlike a filter, this parses each text once
    day = F.explode(F.array_compact(F.array(parse_text_date("result_date")))).alias("__day")
    return located.select("*", day).select(
        to_int_lenient("result_id").alias("ResultID"),
        F.col("event_title").alias("EventTitle"),
        F.col("event").alias("EventName"),
        F.col("sport").alias("Sport"),
        F.col("sport_url").alias("SportURL"),
        F.col("__day").alias("ResultDate"),
        F.col("result_location").alias("ResultLocation"),
        F.col("result_participants").alias("ResultParticipants"),
        to_bool("isTeamSport").alias("IsTeamSport"),
    )


def country_dim(country: DataFrame) -> DataFrame:
    """OlympicsCountry(noc, country, any others): passed through (``noc`` is not unique)."""
    return country


def date_dim(games: DataFrame) -> DataFrame:
    """Date(Date_id, year, start_day_date, start_month_date, end_day_date, end_month_date).

    Start and end are year-less ``d Month`` texts, read after trimming; a text
    with a trailing year still gives its day and month.
    """
    parsed = games.select(
        to_int_lenient("edition_id").alias("Date_id"),
        to_int_lenient("year").alias("year"),
        parse_day_month("start_date").alias("__start"),
        parse_day_month("end_date").alias("__end"),
    )
    return parsed.select(
        "Date_id",
        "year",
        F.dayofmonth("__start").alias("start_day_date"),
        F.month("__start").alias("start_month_date"),
        F.dayofmonth("__end").alias("end_day_date"),
        F.month("__end").alias("end_month_date"),
    )


def fact_table(events: DataFrame, tally: DataFrame) -> DataFrame:
    """Fact_Table(EditionID, CountryNOC, ResultID, AthleteID, Position, MedalAthlete,
    GoldMedals, SilverMedals, BronzeMedals, TotalMedals).

    Inner join of athlete-event rows to the medal tally on (country, edition):
    rows without a tally are dropped, and the tally repeats on every row. The
    tally has one row per (country, edition): the planner broadcasts it from its
    size, and AQE splits a hot key should it ever be too large for that.
    """
    t = tally.select(
        F.col("edition_id").alias("__tally_edition"),
        F.col("country_noc").alias("__tally_country"),
        "gold",
        "silver",
        "bronze",
        "total",
    )
    e = events.select("edition_id", "country_noc", "result_id", "athlete_id", "pos", "medal")
    joined = e.join(
        t,
        (F.col("country_noc") == F.col("__tally_country")) & (F.col("edition_id") == F.col("__tally_edition")),
        "inner",
    )
    typed = joined.select(
        to_int_lenient("edition_id").alias("EditionID"),
        F.col("country_noc").alias("CountryNOC"),
        to_int_lenient("result_id").alias("ResultID"),
        to_int_lenient("athlete_id").alias("AthleteID"),
        F.col("pos").alias("Position"),
        F.col("medal").alias("MedalAthlete"),
        to_int_lenient("gold").alias("GoldMedals"),
        to_int_lenient("silver").alias("SilverMedals"),
        to_int_lenient("bronze").alias("BronzeMedals"),
        to_int_lenient("total").alias("TotalMedals"),
    )
    return fill_constant(typed, {"MedalAthlete": NO_MEDAL})
