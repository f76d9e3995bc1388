"""SQL twins of the query catalogue, for DuckDB over the same Parquet tables.

Written independently of the Spark plans: the roles, the silver layer and the
mart are plain SQL over the pre-registered tables (``region nation customer
supplier part orders lineitem ...``). Dialect notes: DuckDB ``sum(int)`` is
HUGEINT and ``day()/month()`` are BIGINT, so results are cast to the Spark types;
``try_cast('171.5' AS INT)`` rounds in DuckDB, hence the same regex as Spark.
"""

from __future__ import annotations

# --- expression templates (same fixed patterns as strata.functions.columns) ---


def to_int(x: str) -> str:
    return (
        f"(CASE WHEN regexp_matches({x}, '^\\s*[+-]?\\.\\d*\\s*$') THEN 0 "
        f"ELSE TRY_CAST(NULLIF(regexp_extract({x}, '^\\s*([+-]?\\d+)(\\.\\d*)?\\s*$', 1), '') AS INTEGER) END)"
    )


_MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)


def _tokens(x: str) -> str:
    """The fields of a date text, cut at blanks and tabs."""
    return f"regexp_split_to_array(ltrim({x}, ' ' || chr(9)), '[ ' || chr(9) || ']+')"


def _month_list(cut: int | None) -> str:
    return "[" + ", ".join(f"'{m[:cut].lower()}'" for m in _MONTHS) + "]"


def _is_number(x: str) -> str:
    return f"({x} <> '' AND translate({x}, '0123456789', '') = '')"


def parse_date(x: str) -> str:
    """Legacy ``d MMMM yyyy`` reading, token by token: a number, a month's full or short name, a number.

    One blank stands before the month, a blank right after it; what follows the year's digits is ignored.
    """
    t = _tokens(x)
    day, name, tail = f"{t}[1]", f"lower({t}[2])", f"{t}[3]"
    month = f"coalesce(list_position({_month_list(None)}, {name}), list_position({_month_list(3)}, {name}))"
    year = f"TRY_CAST(NULLIF(regexp_extract({tail}, '^[0-9]+'), '') AS INTEGER)"
    blank = f"position({day} || ' ' || {t}[2] || ' ' IN {x}) > 0"
    return (
        f"(CASE WHEN {_is_number(day)} AND {month} > 0 AND {year} >= 1 AND {blank} "
        f"THEN TRY_CAST(printf('%04d-%02d-%02d', {year}, {month}, TRY_CAST({day} AS INTEGER)) AS DATE) END)"
    )


def parse_text_date(x: str) -> str:
    return parse_date(f"regexp_extract({x}, '(\\d{{1,2}} \\w+ \\d{{4}})', 1)")


def parse_day_month(x: str) -> str:
    t = _tokens(x)
    day = f"{t}[1]"
    month = f"list_position({_month_list(3)}, lower(left({t}[2], 3)))"
    return (
        f"(CASE WHEN {_is_number(day)} AND {month} > 0 AND position({day} || ' ' || {t}[2] IN {x}) > 0 "
        f"THEN TRY_CAST(printf('1970-%02d-%02d', {month}, TRY_CAST({day} AS INTEGER)) AS DATE) END)"
    )


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


# --- CTEs: name → (sql, dependencies) ----------------------------------------

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


cte(
    "r_country",
    f"""SELECT n_name AS noc, 'Country ' || {s('n_nationkey')} AS country FROM nation
    WHERE n_nationkey <> 24 AND n_nationkey IN (SELECT DISTINCT CAST(c_custkey % 25 AS INTEGER) FROM customer)
    UNION ALL
    SELECT n_name AS noc, 'Country ' || {s('n_nationkey')} || ' (bis)' AS country FROM nation
    WHERE n_nationkey = 20 AND n_nationkey IN (SELECT DISTINCT CAST(c_custkey % 25 AS INTEGER) FROM customer)""",
)

cte(
    "r_games",
    f"""SELECT {s('yr')} || ' Summer Games' AS edition,
        {s('yr - 1994')} AS edition_id,
        '/editions/' || {s('yr - 1994')} AS edition_url,
        {s('yr')} AS year,
        'City ' || {s('yr % 25')} AS city,
        '/flags/NATION_' || {s('yr % 25')} || '.png' AS country_flag_url,
        'NATION_' || {s('yr % 25')} AS country_noc,
        CASE WHEN yr = 1999 THEN NULL WHEN yr = 2000 THEN '23 July 2001'
             ELSE ' ' || {s('1 + yr % 9')} || ' April' END AS start_date,
        CASE WHEN yr = 1999 THEN NULL WHEN yr = 2000 THEN ' 8 August 2001'
             ELSE {s('10 + yr % 9')} || ' May' END AS end_date,
        CAST(NULL AS VARCHAR) AS competition_date,
        CAST(NULL AS VARCHAR) AS isHeld
    FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders) WHERE yr <> 1997""",
)

cte(
    "r_bio",
    f"""SELECT CASE WHEN c_custkey % 23 = 0 THEN '-' || {s('c_custkey')} ELSE {s('c_custkey')} END AS athlete_id,
        c_name AS name,
        CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex,
        CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN 'unknown'
             WHEN c_custkey % 31 = 0
             THEN strftime(DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%-d %B  ') || chr(9)
                  || strftime(DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%Y')
             WHEN c_custkey % 37 = 0
             THEN strftime(DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%-d') || chr(9)
                  || strftime(DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%B %Y')
             ELSE strftime(DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%-d %B %Y') END AS born,
        CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN '171.5'
             ELSE {s('150 + c_custkey % 60')} END AS height,
        CASE WHEN c_custkey % 17 = 0 THEN '62-64' ELSE {s('45 + c_custkey % 70')} END AS weight,
        'Country ' || {s('c_custkey % 25')} AS country,
        'NATION_' || {s('c_custkey % 25')} AS country_noc,
        c_mktsegment AS description,
        CAST(NULL AS VARCHAR) AS special_notes
    FROM customer""",
)

cte(
    "r_events",
    f"""SELECT {s('year(o.o_orderdate) - 1994')} AS edition_id,
        'NATION_' || {s('o.o_custkey % 25')} AS country_noc,
        {s('l.l_orderkey')} AS result_id,
        {s('o.o_custkey')} AS athlete_id,
        {s('l.l_linenumber')} AS pos,
        CASE l.l_returnflag WHEN 'R' THEN 'Gold' WHEN 'A' THEN 'Silver' END AS medal,
        CASE WHEN l.l_linenumber % 2 = 0 THEN 'True' ELSE 'False' END AS isTeamSport,
        'Event ' || {s('l.l_partkey % 40')} AS event
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
)

cte(
    "r_tally",
    f"""SELECT edition_id, country_noc, {s('gold')} AS gold, {s('silver')} AS silver,
        {s('bronze')} AS bronze, {s('total')} AS total
    FROM (SELECT {s('year(o_orderdate) - 1994')} AS edition_id,
                 'NATION_' || {s('o_custkey % 25')} AS country_noc,
                 count(*) FILTER (WHERE o_orderstatus = 'F') AS gold,
                 count(*) FILTER (WHERE o_orderstatus = 'O') AS silver,
                 count(*) FILTER (WHERE o_orderstatus = 'P') AS bronze,
                 count(*) AS total
          FROM orders GROUP BY 1, 2) t
    WHERE NOT (edition_id = '1' AND country_noc = 'NATION_0')""",
)

cte(
    "r_results",
    f"""SELECT CASE WHEN o_orderkey % 19 = 0 THEN 'r' || {s('o_orderkey')} ELSE {s('o_orderkey')} END AS result_id,
        'Final ' || o_orderpriority AS event_title,
        {s('year(o_orderdate)')} || ' Summer Games' AS edition,
        {s('year(o_orderdate) - 1994')} AS edition_id,
        o_orderpriority AS sport,
        '/sports/' || o_orderstatus AS sport_url,
        CASE WHEN o_orderkey % 29 = 0 THEN 'date unknown'
             WHEN o_orderkey % 3 = 0 THEN '1 – ' || strftime(o_orderdate, '%-d %B %Y')
             ELSE strftime(o_orderdate, '%-d %B %Y') || ', final' END AS result_date,
        CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'Venue ' || {s('o_custkey % 100')} END AS result_location,
        {s('1 + o_custkey % 40')} || ' from ' || {s('1 + o_custkey % 12')} || ' countries' AS result_participants
    FROM orders""",
)

# silver
cte(
    "a_typed",
    f"""SELECT {to_int('athlete_id')} AS athlete_id, name,
        CASE WHEN sex = 'Male' THEN 1 ELSE 0 END AS sex, born,
        {to_int('height')} AS height, {to_int('weight')} AS weight, country
    FROM r_bio WHERE born IS NOT NULL""",
    "r_bio",
)
cte(
    "s_athlete",
    f"""SELECT athlete_id AS AthleteID, name AS Name, sex AS Sex, {parse_date('born')} AS Born,
        COALESCE(height, (SELECT CAST(trunc(avg(height)) AS INTEGER) FROM a_typed)) AS Height,
        COALESCE(weight, (SELECT CAST(trunc(avg(weight)) AS INTEGER) FROM a_typed)) AS Weight,
        country AS Nationality
    FROM a_typed""",
    "a_typed",
)
cte(
    "s_games",
    f"""SELECT {to_int('g.edition_id')} AS EditionID, g.edition AS EditionName, g.edition_url AS EditionURL,
        g.country_flag_url AS FlagURL, g.city AS HostCity, c.country AS HostCountry
    FROM r_games g LEFT JOIN r_country c ON g.country_noc = c.noc""",
    "r_games",
    "r_country",
)
cte(
    "ev_one",
    """SELECT event_result_id, isTeamSport, event FROM (
        SELECT result_id AS event_result_id, isTeamSport, event,
               row_number() OVER (PARTITION BY result_id
                                  ORDER BY isTeamSport NULLS FIRST, event NULLS FIRST) AS rn
        FROM (SELECT DISTINCT result_id, isTeamSport, event FROM r_events) d) x
    WHERE rn = 1""",
    "r_events",
)
cte(
    "s_results",
    f"""SELECT {to_int('r.result_id')} AS ResultID, r.event_title AS EventTitle, e.event AS EventName,
        r.sport AS Sport, r.sport_url AS SportURL, {parse_text_date('r.result_date')} AS ResultDate,
        r.result_location AS ResultLocation, r.result_participants AS ResultParticipants,
        TRY_CAST(e.isTeamSport AS BOOLEAN) AS IsTeamSport
    FROM r_results r LEFT JOIN ev_one e ON r.result_id = e.event_result_id
    WHERE regexp_matches(r.result_id, '^[0-9]+$') AND r.result_location IS NOT NULL
      AND {parse_text_date('r.result_date')} IS NOT NULL""",
    "r_results",
    "ev_one",
)
cte("s_country", "SELECT * FROM r_country", "r_country")
cte(
    "s_date",
    f"""SELECT {to_int('edition_id')} AS Date_id, {to_int('year')} AS year,
        CAST(day({parse_day_month('start_date')}) AS INTEGER) AS start_day_date,
        CAST(month({parse_day_month('start_date')}) AS INTEGER) AS start_month_date,
        CAST(day({parse_day_month('end_date')}) AS INTEGER) AS end_day_date,
        CAST(month({parse_day_month('end_date')}) AS INTEGER) AS end_month_date
    FROM r_games""",
    "r_games",
)
cte(
    "s_fact",
    f"""SELECT {to_int('e.edition_id')} AS EditionID, e.country_noc AS CountryNOC,
        {to_int('e.result_id')} AS ResultID, {to_int('e.athlete_id')} AS AthleteID, e.pos AS Position,
        COALESCE(e.medal, 'NoMedal') AS MedalAthlete,
        {to_int('t.gold')} AS GoldMedals, {to_int('t.silver')} AS SilverMedals,
        {to_int('t.bronze')} AS BronzeMedals, {to_int('t.total')} AS TotalMedals
    FROM r_events e JOIN r_tally t ON e.country_noc = t.country_noc AND e.edition_id = t.edition_id""",
    "r_events",
    "r_tally",
)
# gold, written the long way: medals and stats as two branches joined back.
cte(
    "g_medals",
    """SELECT CountryNOC, EditionID,
        CAST(GoldMedals AS BIGINT) AS g, CAST(SilverMedals AS BIGINT) AS s,
        CAST(BronzeMedals AS BIGINT) AS b
    FROM (SELECT *, row_number() OVER (PARTITION BY CountryNOC, EditionID
                   ORDER BY GoldMedals NULLS FIRST, SilverMedals NULLS FIRST, BronzeMedals NULLS FIRST) AS rn
          FROM s_fact) f
    WHERE rn = 1""",
    "s_fact",
)
cte(
    "g_stats",
    """SELECT f.CountryNOC AS country_code, f.EditionID AS edition,
        count(f.AthleteID) AS rows_with_athlete, avg(a.Height) AS mean_h, avg(a.Weight) AS mean_w,
        sum(CASE WHEN a.Sex = 1 THEN 1 ELSE 0 END) AS men,
        sum(CASE WHEN a.Sex = 0 THEN 1 ELSE 0 END) AS women
    FROM s_fact f LEFT JOIN s_athlete a ON f.AthleteID = a.AthleteID
    GROUP BY f.CountryNOC, f.EditionID""",
    "s_fact",
    "s_athlete",
)


def with_ctes(body: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {parts}\n{body}"


ORACLE: dict[str, str] = {}


def oracle(key: str, body: str, *names: str) -> None:
    ORACLE[key] = with_ctes(body, *names)


def _mart_sql(countries: str) -> str:
    return f"""SELECT s.edition AS EditionID, g.EditionName, g.FlagURL, g.HostCountry, g.HostCity,
        c.country AS ParticipateCountry, d.year AS Year,
        s.mean_h AS AverageHeight, s.mean_w AS AverageWeight,
        CAST(s.men AS BIGINT) AS MaleAthletes, CAST(s.women AS BIGINT) AS FemaleAthletes,
        CAST(s.rows_with_athlete AS BIGINT) AS TotalAthletes,
        m.g AS TotalGold, m.s AS TotalSilver, m.b AS TotalBronze, m.g + m.s + m.b AS TotalMedals
    FROM g_stats s
    JOIN g_medals m ON s.edition = m.EditionID AND s.country_code = m.CountryNOC
    JOIN {countries} c ON s.country_code = c.noc
    JOIN s_games g ON s.edition = g.EditionID
    JOIN s_date d ON s.edition = d.Date_id"""


_MART_CTES = ("g_stats", "g_medals", "s_country", "s_games", "s_date")
oracle("participation_mart", _mart_sql("s_country"), *_MART_CTES)
# T3 option: one row per country code, the smallest name
oracle(
    "participation_mart_unique_country",
    _mart_sql("(SELECT noc, min(country) AS country FROM s_country GROUP BY noc)"),
    *_MART_CTES,
)
oracle("silver_athlete_dim", "SELECT * FROM s_athlete", "s_athlete")
oracle("silver_games_dim", "SELECT * FROM s_games", "s_games")
oracle("silver_results_dim", "SELECT * FROM s_results", "s_results")
oracle("silver_country_dim", "SELECT * FROM s_country", "s_country")
oracle("silver_date_dim", "SELECT * FROM s_date", "s_date")
oracle("silver_fact", "SELECT * FROM s_fact", "s_fact")
oracle(
    "gold_fact_with_date",
    "SELECT f.*, d.Date_id FROM s_fact f LEFT JOIN (SELECT Date_id FROM s_date) d ON f.EditionID = d.Date_id",
    "s_fact",
    "s_date",
)

# --- single operators -----------------------------------------------------------
oracle(
    "cast_int_lenient",
    f"""SELECT athlete_id, height, weight, {to_int('athlete_id')} AS athlete_id_int,
        {to_int('height')} AS height_int, {to_int('weight')} AS weight_int FROM r_bio""",
    "r_bio",
)
oracle(
    "cast_boolean",
    "SELECT result_id, pos, isTeamSport, TRY_CAST(isTeamSport AS BOOLEAN) AS is_team_sport FROM r_events",
    "r_events",
)
oracle(
    "parse_text_date",
    f"""SELECT result_id, result_date, regexp_extract(result_date, '(\\d{{1,2}} \\w+ \\d{{4}})', 1) AS date_text,
        {parse_text_date('result_date')} AS result_day FROM r_results""",
    "r_results",
)
oracle(
    "year_less_day_month",
    f"""SELECT edition_id, start_date, end_date, trim(start_date) AS start_trimmed,
        {parse_day_month('start_date')} AS start_day, {parse_day_month('end_date')} AS end_day,
        CAST(day({parse_day_month('start_date')}) AS INTEGER) AS start_dom,
        CAST(month({parse_day_month('start_date')}) AS INTEGER) AS start_month,
        CAST(day({parse_day_month('end_date')}) AS INTEGER) AS end_dom,
        CAST(month({parse_day_month('end_date')}) AS INTEGER) AS end_month
    FROM r_games""",
    "r_games",
)
oracle(
    "sex_flag",
    "SELECT athlete_id, sex, CASE WHEN sex = 'Male' THEN 1 ELSE 0 END AS sex_flag FROM r_bio",
    "r_bio",
)
oracle(
    "filter_numeric_id",
    "SELECT result_id, edition_id, sport FROM r_results WHERE regexp_matches(result_id, '^[0-9]+$')",
    "r_results",
)
oracle("drop_null_subset", "SELECT athlete_id, born FROM r_bio WHERE born IS NOT NULL", "r_bio")
oracle(
    "select_is_null",
    "SELECT athlete_id, name, CAST(born IS NULL AS INTEGER) AS born_missing FROM r_bio WHERE born IS NULL",
    "r_bio",
)
oracle(
    "drop_and_rename",
    f"""SELECT {to_int('athlete_id')} AS athlete_id, name, CASE WHEN sex = 'Male' THEN 1 ELSE 0 END AS sex,
        born, height, weight, country AS Nationality FROM r_bio""",
    "r_bio",
)
oracle("distinct_projection", "SELECT DISTINCT result_id, isTeamSport, event FROM r_events", "r_events")
oracle("keep_one_per_key", "SELECT event_result_id, isTeamSport, event FROM ev_one", "ev_one")
oracle(
    "keep_one_per_composite",
    """SELECT CountryNOC, EditionID, GoldMedals, SilverMedals, BronzeMedals FROM (
        SELECT CountryNOC, EditionID, GoldMedals, SilverMedals, BronzeMedals,
               row_number() OVER (PARTITION BY CountryNOC, EditionID
                   ORDER BY GoldMedals NULLS FIRST, SilverMedals NULLS FIRST, BronzeMedals NULLS FIRST) AS rn
        FROM s_fact) x WHERE rn = 1""",
    "s_fact",
)
oracle(
    "duplicate_keys",
    """SELECT result_id, count(*) AS count
    FROM (SELECT DISTINCT result_id, isTeamSport, event FROM r_events) d
    GROUP BY result_id HAVING count(*) > 1""",
    "r_events",
)
oracle(
    "null_profile",
    """SELECT count(*) FILTER (WHERE athlete_id IS NULL) AS athlete_id,
        count(*) FILTER (WHERE name IS NULL) AS name,
        count(*) FILTER (WHERE sex IS NULL) AS sex,
        count(*) FILTER (WHERE born IS NULL) AS born,
        count(*) FILTER (WHERE height IS NULL) AS height,
        count(*) FILTER (WHERE weight IS NULL) AS weight,
        count(*) FILTER (WHERE country IS NULL) AS country,
        count(*) FILTER (WHERE country_noc IS NULL) AS country_noc,
        count(*) FILTER (WHERE description IS NULL) AS description,
        count(*) FILTER (WHERE special_notes IS NULL) AS special_notes
    FROM r_bio""",
    "r_bio",
)
oracle(
    "row_counts",
    """SELECT 'Olympics_Country' AS dataset, count(*) AS rows FROM r_country
    UNION ALL SELECT 'Olympics_Games', count(*) FROM r_games
    UNION ALL SELECT 'Olympic_Athlete_Bio', count(*) FROM r_bio
    UNION ALL SELECT 'Olympic_Athlete_Event_Results', count(*) FROM r_events
    UNION ALL SELECT 'Olympic_Games_Medal_Tally', count(*) FROM r_tally
    UNION ALL SELECT 'Olympic_Results', count(*) FROM r_results""",
    "r_country",
    "r_games",
    "r_bio",
    "r_events",
    "r_tally",
    "r_results",
)
cte(
    "m_typed",
    f"""SELECT {to_int('athlete_id')} AS athlete_id, {to_int('height')} AS height,
        {to_int('weight')} AS weight FROM r_bio""",
    "r_bio",
)
oracle(
    "mean_impute",
    """SELECT athlete_id,
        COALESCE(height, (SELECT CAST(trunc(avg(height)) AS INTEGER) FROM m_typed)) AS height,
        COALESCE(weight, (SELECT CAST(trunc(avg(weight)) AS INTEGER) FROM m_typed)) AS weight
    FROM m_typed""",
    "m_typed",
)
oracle(
    "fill_constant",
    "SELECT result_id, athlete_id, pos, COALESCE(medal, 'NoMedal') AS medal FROM r_events",
    "r_events",
)
oracle(
    "grouped_sum",
    """SELECT CountryNOC, EditionID, g AS TotalGold, s AS TotalSilver, b AS TotalBronze, g + s + b AS TotalMedals
    FROM g_medals""",
    "g_medals",
)
oracle(
    "grouped_count_nonnull",
    """SELECT f.CountryNOC, f.EditionID, count(f.AthleteID) AS athlete_rows, count(a.AthleteID) AS known_athlete_rows
    FROM s_fact f LEFT JOIN s_athlete a ON f.AthleteID = a.AthleteID
    GROUP BY f.CountryNOC, f.EditionID""",
    "s_fact",
    "s_athlete",
)
oracle(
    "grouped_avg",
    "SELECT Nationality, avg(Height) AS mean_height, avg(Weight) AS mean_weight FROM s_athlete GROUP BY Nationality",
    "s_athlete",
)
oracle(
    "conditional_count",
    """SELECT Nationality,
        CAST(sum(CASE WHEN Sex = 1 THEN 1 ELSE 0 END) AS BIGINT) AS men,
        CAST(sum(CASE WHEN Sex = 0 THEN 1 ELSE 0 END) AS BIGINT) AS women
    FROM s_athlete GROUP BY Nationality""",
    "s_athlete",
)
oracle(
    "results_event_join",
    """SELECT r.result_id, r.result_location, e.event_result_id, e.isTeamSport, e.event
    FROM r_results r LEFT JOIN ev_one e ON r.result_id = e.event_result_id
    WHERE regexp_matches(r.result_id, '^[0-9]+$')""",
    "r_results",
    "ev_one",
)
oracle(
    "unmatched_keys",
    """SELECT 'fact_without_tally' AS "join", count(*) AS dropped_rows
    FROM r_events e WHERE NOT EXISTS (
        SELECT 1 FROM r_tally t WHERE t.country_noc = e.country_noc AND t.edition_id = e.edition_id)
    UNION ALL
    SELECT unnest(['mart_without_country', 'mart_without_edition', 'mart_without_date']),
        unnest([count(*) FILTER (NOT has_country), count(*) FILTER (has_country AND NOT has_edition),
                count(*) FILTER (has_country AND has_edition AND NOT has_date)])
    FROM (SELECT DISTINCT CountryNOC, EditionID, CountryNOC IN (SELECT noc FROM r_country) AS has_country,
            EditionID IN (SELECT EditionID FROM s_games) AS has_edition, EditionID IN (SELECT Date_id FROM s_date) AS has_date
        FROM s_fact WHERE CountryNOC IS NOT NULL AND EditionID IS NOT NULL) s""",
    "r_events",
    "r_tally",
    "s_fact",
    "r_country",
    "s_games",
    "s_date",
)

oracle("bronze_round_trip", "SELECT * FROM r_results", "r_results")
oracle("stream_bronze_landing", "SELECT * FROM r_events", "r_events")
oracle("stream_silver_fact", "SELECT * FROM s_fact", "s_fact")
oracle("publish_round_trip", "SELECT * FROM s_athlete", "s_athlete")
oracle(
    "bronze_part_folders",
    """SELECT result_id, sport, result_date, CAST(2020 + ascii(right(result_id, 1)) % 4 AS VARCHAR) AS year,
        CASE WHEN ascii(right(result_id, 1)) % 4 = 3 THEN 'extra' END AS venue FROM r_results""",
    "r_results",
)
for _key in ("publish_managed", "external_typed_table", "read_back_check"):
    oracle(_key, "SELECT * FROM s_athlete", "s_athlete")
oracle(
    "column_statistics",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {'NULL' if c == 'Name' else f'CAST(min({c}) AS VARCHAR)'} AS min_value,
        {'NULL' if c == 'Name' else f'CAST(max({c}) AS VARCHAR)'} AS max_value, count(*) - count({c}) AS n_null FROM s_athlete"""
        for c in ("AthleteID", "Name", "Born", "Height", "Weight")
    ),
    "s_athlete",
)
oracle("publish_versions", "SELECT * FROM s_fact", "s_fact")
oracle("publish_append", "SELECT *, coalesce(EditionID % 3 = 0, false) AS rewritten FROM s_fact", "s_fact")
oracle(
    "clustered_point_read",
    """SELECT * FROM s_fact WHERE AthleteID = (SELECT AthleteID FROM s_fact WHERE AthleteID IS NOT NULL
        GROUP BY AthleteID ORDER BY count(*) DESC, AthleteID LIMIT 1)""",
    "s_fact",
)
oracle(
    "list_gold_tables",
    """SELECT 'gold_list' AS database_name, unnest(['athlete_dim', 'athlete_dim_typed']) AS table_name,
        'EXTERNAL' AS table_type, 'parquet' AS provider, 'Athlete_parquet' AS folder""",
)
oracle(
    "schema_of_results",
    """SELECT * FROM (VALUES (0, 'ResultID', 'int'), (1, 'EventTitle', 'string'), (2, 'EventName', 'string'),
        (3, 'Sport', 'string'), (4, 'SportURL', 'string'), (5, 'ResultDate', 'date'), (6, 'ResultLocation', 'string'),
        (7, 'ResultParticipants', 'string'), (8, 'IsTeamSport', 'boolean')) v(position, "column", type)""",
)
oracle("written_codecs", "SELECT 'snappy' AS codec, count(*) AS n_rows FROM s_athlete", "s_athlete")
_DIMENSIONS = {
    "athlete": ("s_athlete", "AthleteID Name Sex Born Height Weight Nationality"),
    "games": ("s_games", "EditionID EditionName EditionURL FlagURL HostCity HostCountry"),
    "results": (
        "s_results",
        "ResultID EventTitle EventName Sport SportURL ResultDate ResultLocation ResultParticipants IsTeamSport",
    ),
    "country": ("s_country", "noc country"),
    "date": ("s_date", "Date_id year start_day_date start_month_date end_day_date end_month_date"),
}
oracle(
    "gold_dimension_rows",
    " UNION ALL ".join(
        f"SELECT '{k}' AS dimension, concat_ws('|', {', '.join(f'coalesce({s(c)}, chr(45))' for c in cols.split())})"
        f" AS row_text FROM {t}"
        for k, (t, cols) in _DIMENSIONS.items()
    ),
    *[t for t, _ in _DIMENSIONS.values()],
)
ORACLE["lake_end_to_end"] = ORACLE["participation_mart"]
oracle(
    "lake_row_counts",
    """SELECT 'bronze' AS layer, 'Olympics_Country' AS dataset, count(*) AS rows FROM r_country
    UNION ALL SELECT 'bronze', 'Olympics_Games', count(*) FROM r_games
    UNION ALL SELECT 'bronze', 'Olympic_Athlete_Bio', count(*) FROM r_bio
    UNION ALL SELECT 'bronze', 'Olympic_Athlete_Event_Results', count(*) FROM r_events
    UNION ALL SELECT 'bronze', 'Olympic_Games_Medal_Tally', count(*) FROM r_tally
    UNION ALL SELECT 'bronze', 'Olympic_Results', count(*) FROM r_results
    UNION ALL SELECT 'silver', 'Athlete_parquet', count(*) FROM s_athlete
    UNION ALL SELECT 'silver', 'OlympicsGames_parquet', count(*) FROM s_games
    UNION ALL SELECT 'silver', 'OlympicResults_parquet', count(*) FROM s_results
    UNION ALL SELECT 'silver', 'OlympicsCountry_parquet', count(*) FROM s_country
    UNION ALL SELECT 'silver', 'Date_parquet', count(*) FROM s_date
    UNION ALL SELECT 'silver', 'Fact_Table_parquet', count(*) FROM s_fact
    UNION ALL SELECT 'gold', 'Athlete_parquet', count(*) FROM s_athlete
    UNION ALL SELECT 'gold', 'OlympicsGames_parquet', count(*) FROM s_games
    UNION ALL SELECT 'gold', 'OlympicResults_parquet', count(*) FROM s_results
    UNION ALL SELECT 'gold', 'Country_parquet', count(*) FROM s_country
    UNION ALL SELECT 'gold', 'Date_parquet', count(*) FROM s_date
    UNION ALL SELECT 'gold', 'Olympics_Fact_parquet', count(*) FROM s_fact
    UNION ALL SELECT 'gold', 'BusinessLogic_Parquet', (SELECT count(*) FROM ({mart}) m)""".format(
        mart=_mart_sql("s_country")
    ),
    "r_country", "r_games", "r_bio", "r_events", "r_tally", "r_results",
    "s_athlete", "s_games", "s_results", "s_country", "s_date", "s_fact", *_MART_CTES,
)
