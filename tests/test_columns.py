"""Column helpers on the micro-fixtures of each semantic trap."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import columns as X


def one_col(spark, values, ddl="s string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_to_int_lenient_matches_non_ansi_cast(spark):
    values = ["171", "171.5", " 171 ", "62-64", "1e2", "99999999999", "", None, "+5", ".5", "-.5", "-0", "0012"]
    got = [r[0] for r in one_col(spark, values).select(X.to_int_lenient("s")).collect()]
    assert got == [171, 171, 171, None, None, None, None, None, 5, 0, 0, 0, 12]


def test_to_bool(spark):
    got = [r[0] for r in one_col(spark, ["True", "False", "true", "x", None]).select(X.to_bool("s")).collect()]
    assert got == [True, False, True, None, None]


def test_year_less_day_month_ignores_tail(spark):
    df = one_col(spark, [" 6 April", "23 July 2021", "29 February", None, ""]).select(X.parse_day_month("s").alias("d"))
    got = [r.d for r in df.collect()]
    assert got == [dt.date(1970, 4, 6), dt.date(1970, 7, 23), None, None, None]


def test_parse_text_date_first_match_and_invalid(spark):
    values = ["12 – 13 July 1996", "12 July 1996 — 13 July 1996", "none", "", "31 November 1900", "12 Août 1996"]
    got = [r[0] for r in one_col(spark, values).select(X.parse_text_date("s")).collect()]
    assert got == [dt.date(1996, 7, 13), dt.date(1996, 7, 12), None, None, None, None]


def test_extract_date_text_is_empty_on_no_match(spark):
    got = [r[0] for r in one_col(spark, ["no date here", None]).select(X.extract_date_text("s")).collect()]
    assert got == ["", None]


def test_male_flag_counts_null_and_other_as_zero(spark):
    got = [r[0] for r in one_col(spark, ["Male", "Female", None, "male"]).select(X.male_flag("s")).collect()]
    assert got == [1, 0, 0, 0]


def test_count_where_is_zero_not_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (2, 1)], "k int, sex int")
    got = dict(df.groupBy("k").agg(X.count_where(F.col("sex") == 1).alias("n")).collect())
    assert got == {1: 0, 2: 1}


def test_total_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([(1, None, 1), (1, 2, 3)], "g int, s int, b int")
    assert [r[0] for r in df.select(X.total_of("g", "s", "b")).collect()] == [None, 6]


def test_to_int_lenient_equals_spark_non_ansi_cast_on_random_text(spark):
    # ground truth: Spark's own cast with ANSI off (the semantics the pipeline was written for)
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    text = st.text(alphabet=list("0123456789+-. e\t"), max_size=8) | st.sampled_from(
        ["2147483647", "2147483648", "-2147483648", "-2147483649", "99999999999", ".", " . ", "5.", "-.5"]
    )

    @settings(max_examples=5, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
    @given(st.lists(text, min_size=50, max_size=200))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "s string")
        lenient = [r[0] for r in df.select(X.to_int_lenient("s")).collect()]
        spark.conf.set("spark.sql.ansi.enabled", "false")
        try:
            legacy = [r[0] for r in df.select(F.col("s").cast("int")).collect()]
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")
        assert lenient == legacy, [(v, a, b) for v, a, b in zip(values, lenient, legacy) if a != b][:5]

    check()


def test_date_parsers_equal_spark_legacy_parser_on_random_text(spark):
    # ground truth: Spark's LEGACY (SimpleDateFormat) parser, which the pipeline's dates were read with
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    month = st.sampled_from(["April", "april", "APRIL", "Apr", "apr", "May", "Sept", "Sep", "Aprilx", "Mai", "Feb",
                             "February", "Nov", "November", "Dec"])
    day = st.sampled_from(["1", "6", "06", "006", "0", "29", "30", "31", "32"])
    year = st.sampled_from(["1950", "1900", "2000", "50", "0001", "0", "1996"])
    lead = st.sampled_from(["", " ", "  ", "\t", " \t", "\n"])
    tail = st.sampled_from(["", " x", ",", "x", " 2021"])
    sep = st.sampled_from([" ", " ", " ", "  ", "\t", " \t", "\n"])

    @st.composite
    def text(draw):
        return draw(lead) + draw(day) + draw(sep) + draw(month) + draw(sep) + draw(year) + draw(tail)

    @st.composite
    def day_month(draw):
        return draw(lead) + draw(day) + draw(sep) + draw(month) + draw(tail)

    @settings(max_examples=4, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
    @given(st.lists(text(), min_size=80, max_size=150), st.lists(day_month(), min_size=80, max_size=150))
    def check(full, short):
        a = spark.createDataFrame([(v,) for v in full], "s string")
        b = spark.createDataFrame([(v,) for v in short], "s string")
        mine = [r[0] for r in a.select(X.parse_date("s")).collect()]
        mine_dm = [r[0] for r in b.select(X.parse_day_month("s")).collect()]
        spark.conf.set("spark.sql.ansi.enabled", "false")
        spark.conf.set("spark.sql.legacy.timeParserPolicy", "LEGACY")
        try:
            legacy = [r[0] for r in a.select(F.to_date("s", "d MMMM yyyy")).collect()]
            legacy_dm = [r[0] for r in b.select(F.to_date(F.trim("s"), "d MMMM")).collect()]
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")
            spark.conf.unset("spark.sql.legacy.timeParserPolicy")
        assert mine == legacy, [(v, x, y) for v, x, y in zip(full, mine, legacy) if x != y][:5]
        assert mine_dm == legacy_dm, [(v, x, y) for v, x, y in zip(short, mine_dm, legacy_dm) if x != y][:5]

    check()


def test_dates_with_stated_results(spark):
    rows = [
        ("12 July 1996", "1996-07-12"), ("12 July  1996", "1996-07-12"), ("12 July \t1996", "1996-07-12"),
        ("\t12 July 1996", "1996-07-12"), ("\n12 July 1996", None), ("12  July 1996", None), ("12\tJuly 1996", None),
        ("12 July\t1996", None), ("31 November 1996", None), ("7 jul 1996, x", "1996-07-07"), ("", None), (None, None),
    ]
    df = spark.createDataFrame(rows, "s string, want string")
    assert [(r[0] and str(r[0]), r[1]) for r in df.select(X.parse_date("s"), "want").collect()] == [(w, w) for _, w in rows]
