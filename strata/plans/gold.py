"""Gold layer: the fact with its date key, and the participation mart.

The mart answers, per (participating country, games edition): athlete-event
rows in total and by sex, average height and weight, and the medal tally.

Plan (one scan of the fact, one shape at every size):

1. fact → group by (AthleteID, CountryNOC, EditionID, medal triple): row count.
   The triple is constant per (country, edition) — it was joined on from the
   tally — so it adds no groups, and keeps every big aggregate a hash aggregate.
   Partial aggregation collapses a hot key inside each map task, so no key — not
   even one holding a third of all rows — reaches one reducer whole.
2. ⟕ athlete on AthleteID, on the pre-aggregate; broadcast or sort-merge is the
   planner's and AQE's choice, from measured sizes.
3. group by (CountryNOC, EditionID, medal triple): counts and height/weight
   sums weighted by the row counts of step 1. Integer sums are exact, so the one
   division at the end equals the per-row ``count``/``avg``.
4. group by (CountryNOC, EditionID): add up, and keep the smallest triple (the
   deterministic survivor); this step sees country × edition rows only.
5. join that small result to country (fan-out on a duplicated code, kept),
   games and dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import total_of
from strata.operators.dedupe import keep_one
from strata.operators.quality import require_unique

# --- Fixed values: published mart columns, in order ----------------------------
MART_COLUMNS = (
    "EditionID", "EditionName", "FlagURL", "HostCountry", "HostCity", "ParticipateCountry", "Year",
    "AverageHeight", "AverageWeight", "MaleAthletes", "FemaleAthletes", "TotalAthletes",
    "TotalGold", "TotalSilver", "TotalBronze", "TotalMedals",
)
# -----------------------------------------------------------------------------

_TALLY = "__tally"
_ROWS = "__rows"


def fact_with_date(fact: DataFrame, date: DataFrame) -> DataFrame:
    """Olympics_Fact: the fact plus ``Date_id`` (NULL when the edition has no date row).

    A key-only left lookup: the date side is one column of a few dozen rows.
    """
    return fact.join(date.select("Date_id"), F.col("EditionID") == F.col("Date_id"), "left")


def medals_per_key(fact: DataFrame) -> DataFrame:
    """One medal tally per (CountryNOC, EditionID), summed: TotalGold/Silver/Bronze/Medals.

    The tally repeats on every fact row of a key; one row per key is kept first
    (deterministically), so medals are not multiplied by the delegation size.
    """
    one = keep_one(
        fact.select("CountryNOC", "EditionID", "GoldMedals", "SilverMedals", "BronzeMedals"),
        ["CountryNOC", "EditionID"],
        dedupe_first=True,
    )
    summed = one.groupBy("CountryNOC", "EditionID").agg(
        F.sum("GoldMedals").alias("TotalGold"),
        F.sum("SilverMedals").alias("TotalSilver"),
        F.sum("BronzeMedals").alias("TotalBronze"),
    )
    return summed.withColumn("TotalMedals", total_of("TotalGold", "TotalSilver", "TotalBronze"))


_MEDALS = ("GoldMedals", "SilverMedals", "BronzeMedals")
_SUMS = ("__athletes", "__h_sum", "__h_n", "__w_sum", "__w_n", "__male", "__female")


def participation_stats(fact: DataFrame, athlete: DataFrame) -> DataFrame:
    """Per (CountryNOC, EditionID): athlete and medal figures, NULL keys dropped.

    The fact is combined per athlete map-side before the join, so the join sees one
    row for each (athlete, key) and a hot athlete is collapsed inside every map task.

    The medal triple rides along as a grouping key (it is constant per country
    and edition, so this adds no groups) and every aggregate over the big inputs
    is a hash aggregate of sums. Only the last, country × edition sized step
    picks the smallest triple per key.
    """
    keys = ["CountryNOC", "EditionID", *_MEDALS]
    bio = athlete.select(F.col("AthleteID").alias("__athlete_key"), "Sex", "Height", "Weight")
    per_athlete = fact.groupBy("AthleteID", *keys).agg(F.count(F.lit(1)).alias(_ROWS))
    joined = per_athlete.join(bio, F.col("AthleteID") == F.col("__athlete_key"), "left")

    rows = F.col(_ROWS)

    def rows_where(cond):
        return F.sum(F.when(cond, rows))

    per_tally = joined.groupBy(*keys).agg(
        rows_where(F.col("AthleteID").isNotNull()).alias("__athletes"),
        F.sum(F.col("Height") * rows).alias("__h_sum"),
        rows_where(F.col("Height").isNotNull()).alias("__h_n"),
        F.sum(F.col("Weight") * rows).alias("__w_sum"),
        rows_where(F.col("Weight").isNotNull()).alias("__w_n"),
        rows_where(F.col("Sex") == 1).alias("__male"),
        rows_where(F.col("Sex") == 0).alias("__female"),
    )
    stats = per_tally.groupBy("CountryNOC", "EditionID").agg(
        *[F.sum(c).alias(c) for c in _SUMS],
        F.min(F.struct(*_MEDALS)).alias(_TALLY),
    )

    def count_of(c: str):
        return F.coalesce(F.col(c), F.lit(0).cast("long"))

    gold = F.col(f"{_TALLY}.GoldMedals").cast("long")
    silver = F.col(f"{_TALLY}.SilverMedals").cast("long")
    bronze = F.col(f"{_TALLY}.BronzeMedals").cast("long")
    return stats.filter(F.col("CountryNOC").isNotNull() & F.col("EditionID").isNotNull()).select(
        "CountryNOC",
        "EditionID",
        count_of("__athletes").alias("TotalAthletes"),
        (F.col("__h_sum") / F.col("__h_n")).alias("AverageHeight"),
        (F.col("__w_sum") / F.col("__w_n")).alias("AverageWeight"),
        count_of("__male").alias("MaleAthletes"),
        count_of("__female").alias("FemaleAthletes"),
        gold.alias("TotalGold"),
        silver.alias("TotalSilver"),
        bronze.alias("TotalBronze"),
        total_of(gold, silver, bronze).alias("TotalMedals"),
    )


def participation_mart(
    fact: DataFrame,
    athlete: DataFrame,
    country: DataFrame,
    games: DataFrame,
    date: DataFrame,
    dedupe_country: bool = False,
    check_keys: bool = False,
) -> DataFrame:
    """BusinessLogic: one row per (country row, edition) with participation and medals.

    Inner joins drop keys missing from country, games or dates. A country code
    listed twice yields two rows (one per country name) unless ``dedupe_country``.
    An athlete or date listed twice would multiply rows silently; with ``check_keys``
    the plan fails instead, naming the key. (An edition may stand twice, once for each
    name of its host's code.)
    """
    if check_keys:
        athlete, date = require_unique(athlete, ["AthleteID"]), require_unique(date, ["Date_id"])
    stats = participation_stats(fact, athlete)
    countries = country.select(F.col("noc").alias("__country_code"), F.col("country").alias("ParticipateCountry"))
    if dedupe_country:
        countries = keep_one(countries, ["__country_code"])
    editions = games.select(
        F.col("EditionID").alias("__edition"), "EditionName", "FlagURL", "HostCountry", "HostCity"
    )
    years = date.select(F.col("Date_id").alias("__date_id"), F.col("year").alias("Year"))
    out = (
        stats.join(countries, F.col("CountryNOC") == F.col("__country_code"), "inner")
        .join(editions, F.col("EditionID") == F.col("__edition"), "inner")
        .join(years, F.col("EditionID") == F.col("__date_id"), "inner")
    )
    return out.select(*MART_COLUMNS)


def dropped_keys(stats: DataFrame, country: DataFrame, games: DataFrame, date: DataFrame) -> DataFrame:
    """(join, dropped_rows): what each inner join of the mart drops of the (country, edition) rows, in one pass.

    The joins come in the mart's order, so a row counts at the first one that has no partner for it. The
    dimensions' distinct keys are joined once each; nothing is recomputed for the next count.
    """
    sides = [
        ("mart_without_country", "CountryNOC", country, "noc"),
        ("mart_without_edition", "EditionID", games, "EditionID"),
        ("mart_without_date", "EditionID", date, "Date_id"),
    ]
    out, kept, counts = stats.select("CountryNOC", "EditionID"), F.lit(True), []
    for k, (name, key, side, other) in enumerate(sides):
        known = side.select(F.col(other).alias(f"__k{k}")).distinct()
        out = out.join(known, F.col(key) == F.col(f"__k{k}"), "left")
        found = F.col(f"__k{k}").isNotNull()
        counts.append(F.struct(F.lit(name).alias("join"), F.count_if(kept & ~found).alias("dropped_rows")))
        kept = kept & found
    return out.agg(F.array(*counts).alias("__c")).select(F.inline("__c"))
