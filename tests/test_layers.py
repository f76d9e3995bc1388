"""Silver and gold builders on small hand-made bronze frames, plus schema contracts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
)

from strata.config import DATASETS
from strata.plans import gold, silver
from strata.plans.queries import QUERIES


def bronze(spark, name, rows):
    cols = DATASETS[name]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], ", ".join(f"{c} string" for c in cols))


def fact_rows(spark, rows):
    return spark.createDataFrame(
        rows,
        "EditionID int, CountryNOC string, ResultID int, AthleteID int, Position string, MedalAthlete string, "
        "GoldMedals int, SilverMedals int, BronzeMedals int, TotalMedals int",
    )


def athletes(spark, rows):
    return spark.createDataFrame(
        rows, "AthleteID int, Name string, Sex int, Born date, Height int, Weight int, Nationality string"
    )


def dims(spark, countries=(("GRE", "Greece"),)):
    country = spark.createDataFrame(list(countries), "noc string, country string")
    games = spark.createDataFrame(
        [(1, "1896 Summer", "/e/1", "f.png", "Athina", "Greece")],
        "EditionID int, EditionName string, EditionURL string, FlagURL string, HostCity string, HostCountry string",
    )
    date = spark.createDataFrame([(1, 1896, 6, 4, 15, 4)], "Date_id int, year int, start_day_date int, "
                                 "start_month_date int, end_day_date int, end_month_date int")
    return country, games, date


def test_athlete_dim_order_of_steps(spark):
    bio = bronze(spark, "Olympic_Athlete_Bio", [
        {"athlete_id": "1", "sex": "Male", "born": None, "height": "300", "weight": "90"},
        {"athlete_id": "2", "sex": "Female", "born": "6 April 1950", "height": "170", "weight": "62-64"},
        {"athlete_id": "3", "sex": None, "born": "unknown", "height": "173", "weight": "60"},
        {"athlete_id": "4", "sex": "Male", "born": "1 May 1960", "height": None, "weight": "70"},
    ])
    got = {r.AthleteID: r for r in silver.athlete_dim(bio).collect()}
    assert set(got) == {2, 3, 4}  # NULL birth text leaves first
    assert got[4].Height == 171  # mean of 170, 173 truncated; 300 is not counted
    assert got[2].Weight == 65  # '62-64' → NULL → mean of 60, 70
    assert got[3].Born is None and got[2].Born == dt.date(1950, 4, 6)
    assert (got[2].Sex, got[3].Sex, got[4].Sex) == (0, 0, 1)


def test_games_dim_left_join_and_raw_keys(spark):
    games = bronze(spark, "Olympics_Games", [
        {"edition_id": "1", "edition": "e1", "country_noc": "GRE"},
        {"edition_id": "2", "edition": "e2", "country_noc": "XXX"},
    ])
    country = bronze(spark, "Olympics_Country", [{"noc": "GRE", "country": "Greece"}])
    got = {r.EditionID: r.HostCountry for r in silver.games_dim(games, country).collect()}
    assert got == {1: "Greece", 2: None}


def test_results_dim(spark):
    results = bronze(spark, "Olympic_Results", [
        {"result_id": "12", "result_date": "12 – 13 July 1996", "result_location": "A"},
        {"result_id": "12a", "result_date": "12 July 1996", "result_location": "A"},
        {"result_id": "13", "result_date": "none", "result_location": "A"},
        {"result_id": "14", "result_date": "1 May 1900", "result_location": None},
        {"result_id": "15", "result_date": "31 November 1900", "result_location": "B"},
    ])
    events = bronze(spark, "Olympic_Athlete_Event_Results", [
        {"result_id": "12", "isTeamSport": "True", "event": "b"},
        {"result_id": "12", "isTeamSport": "True", "event": "a"},
        {"result_id": "12", "isTeamSport": "True", "event": "a"},
    ])
    rows = silver.results_dim(results, events).collect()
    assert [(r.ResultID, r.ResultDate, r.EventName, r.IsTeamSport) for r in rows] == [
        (12, dt.date(1996, 7, 13), "a", True)
    ]


def test_date_dim_trailing_year_and_missing(spark):
    games = bronze(spark, "Olympics_Games", [
        {"edition_id": "61", "year": "2020", "start_date": "23 July 2021", "end_date": " 8 August 2021"},
        {"edition_id": "3", "year": "1904", "start_date": " 1 July", "end_date": None},
    ])
    got = {r.Date_id: tuple(r)[1:] for r in silver.date_dim(games).collect()}
    assert got == {61: (2020, 23, 7, 8, 8), 3: (1904, 1, 7, None, None)}


def test_fact_table_inner_join_and_no_medal(spark):
    events = bronze(spark, "Olympic_Athlete_Event_Results", [
        {"edition_id": "1", "country_noc": "GRE", "result_id": "5", "athlete_id": "7", "medal": None},
        {"edition_id": "1", "country_noc": "GRE", "result_id": "6", "athlete_id": "8", "medal": "Gold"},
        {"edition_id": "01", "country_noc": "GRE", "result_id": "6", "athlete_id": "9", "medal": "Gold"},  # T9
        {"edition_id": "2", "country_noc": "FRA", "result_id": "6", "athlete_id": "9", "medal": "Gold"},  # T10
    ])
    tally = bronze(spark, "Olympic_Games_Medal_Tally", [
        {"edition_id": "1", "country_noc": "GRE", "gold": "2", "silver": "0", "bronze": "1", "total": "3"}
    ])
    rows = silver.fact_table(events, tally).collect()
    assert sorted((r.AthleteID, r.MedalAthlete, r.GoldMedals) for r in rows) == [(7, "NoMedal", 2), (8, "Gold", 2)]


def test_mart_semantics(spark):
    # T4: one athlete, 3 events → 3; T5: sex NULL counts as female in silver, unknown athlete is neither;
    # The tally repeats on 5 rows but is counted once.
    fact = fact_rows(spark, [
        (1, "GRE", 10, 1, "1", "Gold", 2, 0, 1, 3),
        (1, "GRE", 11, 1, "1", "Gold", 2, 0, 1, 3),
        (1, "GRE", 12, 1, "1", "Gold", 2, 0, 1, 3),
        (1, "GRE", 13, 2, "2", "NoMedal", 2, 0, 1, 3),
        (1, "GRE", 14, 99, "3", "NoMedal", 2, 0, 1, 3),
    ])
    ath = athletes(spark, [(1, "a", 1, None, 180, 80, "x"), (2, "b", 0, None, 160, None, "y")])
    country, games, date = dims(spark)
    [row] = gold.participation_mart(fact, ath, country, games, date).collect()
    assert (row.TotalAthletes, row.MaleAthletes, row.FemaleAthletes) == (5, 3, 1)
    assert row.AverageHeight == (3 * 180 + 160) / 4 and row.AverageWeight == 80.0
    assert (row.TotalGold, row.TotalSilver, row.TotalBronze, row.TotalMedals) == (2, 0, 1, 3)
    assert (row.EditionName, row.ParticipateCountry, row.Year) == ("1896 Summer", "Greece", 1896)


def test_mart_fan_out_on_duplicate_country_and_dedupe_flag(spark):
    fact = fact_rows(spark, [(1, "ROC", 10, 1, "1", "Gold", 1, 1, 1, 3)])
    ath = athletes(spark, [(1, "a", 1, None, 180, 80, "x")])
    country, games, date = dims(spark, countries=(("ROC", "a"), ("ROC", "b")))
    assert gold.participation_mart(fact, ath, country, games, date).count() == 2  # T3
    assert gold.participation_mart(fact, ath, country, games, date, dedupe_country=True).count() == 1


def test_mart_drops_unknown_country_and_null_keys(spark):
    fact = fact_rows(spark, [
        (1, "XXX", 10, 1, "1", "Gold", 1, 1, 1, 3),
        (None, "GRE", 10, 1, "1", "Gold", 1, 1, 1, 3),
        (1, None, 10, 1, "1", "Gold", 1, 1, 1, 3),
    ])
    ath = athletes(spark, [(1, "a", 1, None, 180, 80, "x")])
    country, games, date = dims(spark)
    assert gold.participation_mart(fact, ath, country, games, date).count() == 0


def test_mart_null_medal_makes_total_null(spark):
    fact = fact_rows(spark, [(1, "GRE", 10, 1, "1", "Gold", 1, None, 1, None)])
    ath = athletes(spark, [(1, "a", 1, None, 180, 80, "x")])
    country, games, date = dims(spark)
    [row] = gold.participation_mart(fact, ath, country, games, date).collect()
    assert row.TotalSilver is None and row.TotalMedals is None and row.TotalGold == 1


def test_published_schemas(spark, sf_small):
    S, I, L, D, DT, B = StringType(), IntegerType(), LongType(), DoubleType(), DateType(), BooleanType()
    expected = {
        "silver_athlete_dim": [("AthleteID", I), ("Name", S), ("Sex", I), ("Born", DT), ("Height", I), ("Weight", I),
                               ("Nationality", S)],
        "silver_games_dim": [("EditionID", I), ("EditionName", S), ("EditionURL", S), ("FlagURL", S),
                             ("HostCity", S), ("HostCountry", S)],
        "silver_results_dim": [("ResultID", I), ("EventTitle", S), ("EventName", S), ("Sport", S), ("SportURL", S),
                               ("ResultDate", DT), ("ResultLocation", S), ("ResultParticipants", S),
                               ("IsTeamSport", B)],
        "silver_country_dim": [("noc", S), ("country", S)],
        "silver_date_dim": [("Date_id", I), ("year", I), ("start_day_date", I), ("start_month_date", I),
                            ("end_day_date", I), ("end_month_date", I)],
        "silver_fact": [("EditionID", I), ("CountryNOC", S), ("ResultID", I), ("AthleteID", I), ("Position", S),
                        ("MedalAthlete", S), ("GoldMedals", I), ("SilverMedals", I), ("BronzeMedals", I),
                        ("TotalMedals", I)],
        "participation_mart": [("EditionID", I), ("EditionName", S), ("FlagURL", S), ("HostCountry", S),
                               ("HostCity", S), ("ParticipateCountry", S), ("Year", I), ("AverageHeight", D),
                               ("AverageWeight", D), ("MaleAthletes", L), ("FemaleAthletes", L),
                               ("TotalAthletes", L), ("TotalGold", L), ("TotalSilver", L), ("TotalBronze", L),
                               ("TotalMedals", L)],
    }
    for key, pairs in expected.items():
        got = [(f.name, f.dataType) for f in QUERIES[key](spark, sf_small).schema.fields]
        assert got == pairs, key


def test_mart_invariants_and_partition_count_independence(spark, sf_small):
    mart = QUERIES["participation_mart"](spark, sf_small)
    bad = mart.filter(
        (F.col("MaleAthletes") + F.col("FemaleAthletes") > F.col("TotalAthletes"))
        | (F.col("TotalMedals") != F.col("TotalGold") + F.col("TotalSilver") + F.col("TotalBronze"))
    )
    assert bad.count() == 0
    # keys unique except for the duplicated country code (one extra row per edition it takes part in)
    # (and for the edition whose host code is listed twice: one row for each host name)
    dup = mart.groupBy("EditionID", "ParticipateCountry", "HostCountry").count().filter("count > 1").count()
    assert dup == 0
    base = sorted(map(tuple, mart.collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert sorted(map(tuple, QUERIES["participation_mart"](spark, sf_small).collect())) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_mart_hot_key_equals_row_level_brute_force(spark):
    # one athlete (and NULL athlete ids) hold a third of all fact rows each
    import random

    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        ath = 1 if i % 3 == 0 else (None if i % 3 == 1 and i % 2 else rnd.randint(2, 60))
        noc = rnd.choice(["GRE", "ROC", "FRA"])
        medals = {"GRE": (2, 0, 1), "ROC": (1, None, 4), "FRA": (0, 0, 0)}[noc]
        rows.append((1, noc, i, ath, str(i % 5), "NoMedal", *medals, None))
    fact = fact_rows(spark, rows)
    ath_rows = [(a, f"n{a}", a % 2, None, (150 + a) if a % 7 else None, 50 + a, "x") for a in range(1, 50)]
    ath = athletes(spark, ath_rows)
    country, games, date = dims(spark, countries=(("GRE", "Greece"), ("ROC", "a"), ("ROC", "b"), ("FRA", "France")))
    mart = gold.participation_mart(fact, ath, country, games, date)
    got = {(r.ParticipateCountry,): r for r in mart.collect()}

    # brute force: join row by row, then aggregate exactly as the published definition says
    bio = {a[0]: a for a in ath_rows}
    names = {"GRE": ["Greece"], "ROC": ["a", "b"], "FRA": ["France"]}
    for noc in ("GRE", "ROC", "FRA"):
        part = [r for r in rows if r[1] == noc]
        heights = [bio[r[3]][4] for r in part if r[3] in bio and bio[r[3]][4] is not None]
        weights = [bio[r[3]][5] for r in part if r[3] in bio]
        exp = (
            sum(r[3] is not None for r in part),
            sum(1 for r in part if r[3] in bio and bio[r[3]][2] == 1),
            sum(1 for r in part if r[3] in bio and bio[r[3]][2] == 0),
            sum(heights) / len(heights),
            sum(weights) / len(weights),
        )
        for name in names[noc]:
            r = got[(name,)]
            assert (r.TotalAthletes, r.MaleAthletes, r.FemaleAthletes) == exp[:3]
            assert abs(r.AverageHeight - exp[3]) < 1e-9 and abs(r.AverageWeight - exp[4]) < 1e-9
            assert (r.TotalGold, r.TotalSilver, r.TotalBronze) == part[0][6:9]


def test_fact_is_combined_map_side_before_its_first_shuffle(spark):
    fact = fact_rows(spark, [(1, "GRE", i, 1, "1", "Gold", 1, 1, 1, 3) for i in range(100)])
    ath = athletes(spark, [(1, "a", 1, None, 180, 80, "x")])
    country, games, date = dims(spark)
    mart = gold.participation_mart(fact, ath, country, games, date)
    plan = mart._jdf.queryExecution().executedPlan().toString()
    # the exchange keyed on AthleteID sits on top of a partial aggregate, never on raw rows
    assert "partial_count" in plan
    first = plan.index("HashAggregate(keys=[AthleteID")
    assert "partial_count" in plan[first:] and "Exchange hashpartitioning(AthleteID" in plan[first:]
