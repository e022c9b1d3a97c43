"""The same queries as plain SQL over the given tables, written for another engine.

Rounded figures use whole-number arithmetic, so no engine's rounding of doubles is involved.
"""

from __future__ import annotations

MATCHES = """
WITH matches AS (
  SELECT match_id, match_date, home_team, away_team,
         CASE WHEN h = 7 THEN 24 WHEN h = 11 THEN 31 WHEN h % 2 = 0 THEN h % 3 ELSE h % 6 END AS home_score,
         CASE WHEN a = 5 THEN 22 WHEN a % 2 = 0 THEN a % 3 ELSE a % 4 END AS away_score,
         tournament, city, country, neutral
  FROM (
    SELECT o.o_orderkey AS match_id, CAST(o.o_orderdate AS DATE) AS match_date,
           concat(hn.n_name, ' ', c.c_mktsegment) AS home_team,
           concat(an.n_name, ' ', c.c_mktsegment) AS away_team,
           CAST((o.o_orderkey * 7919 + o.o_custkey * 104729) % 1009 AS INT) AS h,
           CAST((o.o_orderkey * 6151 + o.o_custkey * 3079) % 1013 AS INT) AS a,
           concat(c.c_mktsegment, ' ', o.o_orderpriority) AS tournament,
           CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE concat('City ', o.o_custkey % 40) END AS city,
           CASE WHEN o.o_orderkey % 23 = 0 THEN NULL ELSE hn.n_name END AS country,
           CASE o.o_orderstatus WHEN 'O' THEN TRUE WHEN 'F' THEN FALSE END AS neutral
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation hn ON hn.n_nationkey = c.c_nationkey
    JOIN nation an ON an.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25
  ) x
)"""

ENRICHED = MATCHES + """,
enriched AS (
  SELECT match_id, match_date AS date, home_team, away_team,
         CAST(home_score AS BIGINT) AS home_score, CAST(away_score AS BIGINT) AS away_score,
         tournament, city, country, neutral,
         CAST(year(match_date) AS INT) AS year,
         CAST(home_score + away_score AS BIGINT) AS total_goals,
         CAST(abs(home_score - away_score) AS BIGINT) AS goal_difference,
         CASE WHEN home_score > away_score THEN 'Home win' WHEN home_score < away_score THEN 'Away win' ELSE 'Draw' END AS result
  FROM matches
)"""

SIDES = ENRICHED + """,
sides AS (
  SELECT match_id, date, year, tournament, city, country, neutral, total_goals, goal_difference,
         home_team AS team, away_team AS opponent, home_score AS goals_for, away_score AS goals_against,
         'Home' AS venue_role
  FROM enriched
  UNION ALL
  SELECT match_id, date, year, tournament, city, country, neutral, total_goals, goal_difference,
         away_team, home_team, away_score, home_score, 'Away'
  FROM enriched
),
team_long AS (
  SELECT *, CASE WHEN goals_for > goals_against THEN 'Win' WHEN goals_for < goals_against THEN 'Loss' ELSE 'Draw' END AS match_result,
         CASE WHEN goals_for > goals_against THEN 1 ELSE 0 END AS is_win,
         CASE WHEN goals_for = goals_against THEN 1 ELSE 0 END AS is_draw,
         CASE WHEN goals_for < goals_against THEN 1 ELSE 0 END AS is_loss
  FROM sides
),
ranking AS (
  SELECT team, COUNT(*) AS matches, CAST(SUM(is_win) AS BIGINT) AS wins, CAST(SUM(is_draw) AS BIGINT) AS draws,
         CAST(SUM(is_loss) AS BIGINT) AS losses, CAST(SUM(goals_for) AS BIGINT) AS goals_for,
         CAST(SUM(goals_against) AS BIGINT) AS goals_against,
         CAST(SUM(goals_for) - SUM(goals_against) AS BIGINT) AS goal_difference,
         CAST(SUM(is_win) AS DOUBLE) / COUNT(*) * 100 AS win_rate,
         CAST(SUM(goals_for) AS DOUBLE) / COUNT(*) AS avg_goals_for
  FROM team_long GROUP BY team
)"""

RAW = """
WITH raw_base AS (
  SELECT o_orderkey AS k,
         CASE WHEN o_orderkey % 97 = 0 THEN 'not_a_date' WHEN o_orderkey % 89 = 0 THEN NULL
              ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS match_date,
         concat('  Team ', o_custkey % 40, ' ') AS home,
         CASE WHEN o_orderkey % 211 = 0 THEN concat('Team ', o_custkey % 40)
              ELSE concat('Team ', 40 + o_custkey % 37) END AS away,
         CASE WHEN o_orderkey % 101 = 0 THEN 'abc' WHEN o_orderkey % 103 = 0 THEN '1.5'
              WHEN o_orderkey % 107 = 0 THEN '-1' WHEN o_orderkey % 109 = 0 THEN '1d'
              WHEN o_orderkey % 2 = 0 THEN concat(o_orderkey % 5, '.0') ELSE concat(o_orderkey % 24, '') END AS h_points,
         CASE WHEN o_orderkey % 113 = 0 THEN NULL ELSE concat(' ', o_custkey % 6) END AS a_points,
         CASE WHEN o_orderkey % 127 = 0 THEN '   ' ELSE o_orderpriority END AS event,
         CASE o_orderkey % 12 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN ' YES ' WHEN 3 THEN 'y'
              WHEN 4 THEN 'Neutral' WHEN 5 THEN 'false' WHEN 6 THEN '0' WHEN 7 THEN 'No' WHEN 8 THEN 'n'
              WHEN 9 THEN 'home' WHEN 10 THEN 'maybe' END AS elsewhere,
         o_orderstatus AS remark
  FROM orders
),
raw_matches AS (
  SELECT match_date, home, away, h_points, a_points, event, elsewhere, remark FROM raw_base
  UNION ALL
  SELECT match_date, home, away, h_points, a_points, event, elsewhere, remark FROM raw_base WHERE k % 200 = 0
),
as_read AS (
  SELECT TRY_CAST(trim(match_date) AS DATE) AS date, trim(home) AS home_team, trim(away) AS away_team,
         trim(h_points) AS home_score, trim(a_points) AS away_score, trim(event) AS tournament,
         trim(elsewhere) AS neutral
  FROM raw_matches
),
typed AS (
  SELECT *,
         CASE WHEN regexp_full_match(home_score, '[+-]?[0-9]+([.][0-9]*)?') THEN CAST(home_score AS DOUBLE) END AS hs,
         CASE WHEN regexp_full_match(away_score, '[+-]?[0-9]+([.][0-9]*)?') THEN CAST(away_score AS DOUBLE) END AS as_,
         CASE WHEN lower(neutral) IN ('true', '1', 'yes', 'y', 'neutral') THEN TRUE
              WHEN lower(neutral) IN ('false', '0', 'no', 'n', 'home') THEN FALSE END AS flag
  FROM as_read
),
standard AS (
  SELECT date, home_team, away_team,
         CASE WHEN hs = floor(hs) THEN CAST(hs AS BIGINT) END AS home_score,
         CASE WHEN as_ = floor(as_) THEN CAST(as_ AS BIGINT) END AS away_score,
         tournament, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS country, flag AS neutral
  FROM typed
)"""


def _ones(condition: str) -> str:
    return f"CAST(SUM(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def _round(total: str, count: str, digits: int) -> str:
    """total / count of non-negative whole numbers, rounded half up at the given digit."""
    unit = 10**digits
    return f"(({2 * unit} * {total} + {count}) // (2 * {count})) / {unit}.0"


def _mean(value: str, digits: int) -> str:
    return _round(f"CAST(SUM({value}) AS BIGINT)", "COUNT(*)", digits)


def _pct(condition: str) -> str:
    return _round(f"(100 * {_ones(condition)})", "COUNT(*)", 2)


def _share(condition: str, count: str = "COUNT(*)") -> str:
    return _round(_ones(condition), count, 4)


_HOME, _LEVEL, _AWAY = "home_score > away_score", "home_score = away_score", "home_score < away_score"
_GOALS, _DIFF = "home_score + away_score", "abs(home_score - away_score)"
_YEAR = "CAST(year(match_date) AS INT)"
_TEAM, _TOURNAMENT = "NATION_0 AUTOMOBILE", "HOUSEHOLD 5-LOW"
_RESULT_AVG = "AVG(CASE WHEN result = '{}' THEN 1 ELSE 0 END) * 100"
_CONTRACT = "date, home_team, away_team, home_score, away_score, tournament, city, country, neutral"
_LOADED = "match_date, home_team, away_team, home_score, away_score, tournament, city, country, neutral"

_VENUE = "CASE WHEN neutral THEN '{}' WHEN NOT neutral THEN '{}' ELSE '{}' END"
_VENUE_VIEW = _VENUE.format("Neutral", "Non-neutral", "Unknown")

_TRENDS = f"""
trends AS (
  SELECT year, COUNT(*) AS matches, AVG(total_goals) AS avg_goals, {_RESULT_AVG.format('Draw')} AS draw_share,
         AVG(CASE WHEN NOT neutral THEN CASE WHEN result = 'Home win' THEN 1 ELSE 0 END END) * 100 AS home_win_share
  FROM enriched GROUP BY year
)"""


def _smoothed(window: int) -> str:
    def rolling(name: str) -> str:
        return f"CASE WHEN COUNT({name}) OVER w >= {window} THEN AVG({name}) OVER w END AS {name}"

    columns = ", ".join(rolling(c) for c in ("matches", "avg_goals", "draw_share", "home_win_share"))
    return f"{ENRICHED}, {_TRENDS} SELECT year, {columns} FROM trends WINDOW w AS (ORDER BY year ROWS {window - 1} PRECEDING)"


def _ranked(select: str, key: str, limit: int | None, where: str = "") -> str:
    top = f" LIMIT {limit}" if limit else ""
    return f"{ENRICHED} SELECT {select} AS {key}, COUNT(*) AS matches FROM enriched {where} GROUP BY 1 ORDER BY 2 DESC, 1{top}"


def _line(section: str, rows: list[tuple[int, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{section}' AS section, {i} AS position, {value} AS value" for i, value in rows)


def _names(section: str, names: list[str]) -> str:
    return _line(section, [(i + 1, f"'{n}'") for i, n in enumerate(names)])


_RULES = """
counts AS (
  SELECT COUNT(*) AS n,
         CAST(SUM(CASE WHEN date IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_date,
         CAST(SUM(CASE WHEN home_score IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_home,
         CAST(SUM(CASE WHEN away_score IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_away,
         CAST(SUM(CASE WHEN hs IS NULL OR hs < 0 OR hs <> floor(hs) THEN 1 ELSE 0 END) AS BIGINT) AS bad_home,
         CAST(SUM(CASE WHEN as_ IS NULL OR as_ < 0 OR as_ <> floor(as_) THEN 1 ELSE 0 END) AS BIGINT) AS bad_away,
         CAST(SUM(CASE WHEN home_score IS NOT NULL AND hs IS NULL OR hs <> floor(hs) THEN 1 ELSE 0 END) AS BIGINT) AS unsafe_home,
         CAST(SUM(CASE WHEN away_score IS NOT NULL AND as_ IS NULL OR as_ <> floor(as_) THEN 1 ELSE 0 END) AS BIGINT) AS unsafe_away,
         CAST(SUM(CASE WHEN home_team = away_team AND home_team <> '' THEN 1 ELSE 0 END) AS BIGINT) AS same_team,
         CAST(SUM(CASE WHEN tournament = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank,
         CAST(SUM(CASE WHEN hs > 20 THEN 1 ELSE 0 END) AS BIGINT) AS high_home,
         CAST(SUM(CASE WHEN as_ > 20 THEN 1 ELSE 0 END) AS BIGINT) AS high_away,
         CAST(SUM(CASE WHEN date > DATE '1998-01-01' THEN 1 ELSE 0 END) AS BIGINT) AS future,
         CAST(SUM(CASE WHEN lower(neutral) NOT IN ('true', 'false', '0', '1', 'yes', 'no') THEN 1 ELSE 0 END) AS BIGINT) AS odd_neutral,
         CAST(SUM(CASE WHEN neutral IS NOT NULL AND flag IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS lost_neutral
  FROM typed
),
read_copies AS (
  SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS copies FROM (
    SELECT COUNT(*) AS c FROM as_read GROUP BY date, home_team, away_team, home_score, away_score, tournament, neutral
  ) g
),
standard_copies AS (
  SELECT CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS copies FROM (
    SELECT COUNT(*) AS c FROM standard GROUP BY date, home_team, away_team, home_score, away_score, tournament, neutral
  ) g
),
report AS (
  SELECT rule_id, severity, column_name AS "column", violations, message FROM (
    SELECT 'V3' AS rule_id, 'error' AS severity, 'date' AS column_name, no_date AS violations,
           'Required column ''date'' contains missing values.' AS message FROM counts
    UNION ALL SELECT 'V3', 'error', 'home_score', no_home, 'Required column ''home_score'' contains missing values.' FROM counts
    UNION ALL SELECT 'V3', 'error', 'away_score', no_away, 'Required column ''away_score'' contains missing values.' FROM counts
    UNION ALL SELECT 'V5', 'error', 'home_score', bad_home, 'Column ''home_score'' must contain non-negative integer scores.' FROM counts
    UNION ALL SELECT 'V5', 'error', 'away_score', bad_away, 'Column ''away_score'' must contain non-negative integer scores.' FROM counts
    UNION ALL SELECT 'V7', 'error', NULL, same_team, 'home_team must not be equal to away_team.' FROM counts
    UNION ALL SELECT 'V9', 'error', 'date', no_date, 'Column ''date'' contains invalid or missing datetime values.' FROM counts
    UNION ALL SELECT 'V4', 'warning', NULL, blank, 'Empty strings found after trimming spaces in columns: tournament.' FROM counts
    UNION ALL SELECT 'V6', 'warning', 'home_score', high_home, 'Column ''home_score'' contains suspiciously large scores above 20.' FROM counts
    UNION ALL SELECT 'V6', 'warning', 'away_score', high_away, 'Column ''away_score'' contains suspiciously large scores above 20.' FROM counts
    UNION ALL SELECT 'V10', 'warning', 'date', future, 'Some match dates are in the future.' FROM counts
    UNION ALL SELECT 'V11', 'warning', NULL, 2, 'Missing optional columns: city, country.' FROM counts
    UNION ALL SELECT 'V12', 'warning', NULL, copies, 'Duplicate rows found in the dataset.' FROM read_copies
    UNION ALL SELECT 'V13', 'warning', 'neutral', odd_neutral, 'Column ''neutral'' contains unknown values.' FROM counts
  ) r WHERE violations > 0
)"""


def _audit() -> str:
    """The audit lines. Messages with a zero count leave their list, so positions are numbered at the end."""
    errors = [
        ("unsafe_home", "Column 'home_score' cannot be safely converted to integer scores."),
        ("unsafe_away", "Column 'away_score' cannot be safely converted to integer scores."),
        ("no_date", "Required column 'date' contains missing values."),
        ("no_home", "Required column 'home_score' contains missing values."),
        ("no_away", "Required column 'away_score' contains missing values."),
        ("bad_home", "Column 'home_score' must contain non-negative integer scores."),
        ("bad_away", "Column 'away_score' must contain non-negative integer scores."),
        ("same_team", "home_team must not be equal to away_team."),
        ("no_date", "Column 'date' contains invalid or missing datetime values."),
    ]
    warnings = [
        ("blank", "Empty strings found after trimming spaces in columns: tournament."),
        ("high_home", "Column 'home_score' contains suspiciously large scores above 20."),
        ("high_away", "Column 'away_score' contains suspiciously large scores above 20."),
        ("future", "Some match dates are in the future."),
    ]
    conversions = [
        ("1", "Converted 'date' to datetime."),
        ("CASE WHEN unsafe_home = 0 THEN 1 ELSE 0 END", "Converted 'home_score' to nullable integer."),
        ("CASE WHEN unsafe_away = 0 THEN 1 ELSE 0 END", "Converted 'away_score' to nullable integer."),
        ("1", "Standardized 'neutral' to nullable boolean."),
    ]

    def listed(section: str, rows: list[tuple[str, str]], start: int = 0) -> list[str]:
        return [
            "SELECT '{}' AS section, {} AS rank, CAST({} AS BIGINT) AS n, '{}' AS value FROM counts".format(
                section, start + i, n, text.replace("'", "''")
            )
            for i, (n, text) in enumerate(rows)
        ]

    numbered = listed("errors", errors) + listed("type_conversions", conversions) + listed("warnings", warnings, 1)
    numbered.append(
        "SELECT 'warnings', 0, lost_neutral, concat('Column ''neutral'' contains unknown values. ', lost_neutral,"
        " ' value(s) were converted to missing.') FROM counts"
    )
    numbered.append("SELECT 'warnings', 9, copies, 'Duplicate rows found in the dataset.' FROM standard_copies")
    fixed = " UNION ALL ".join(
        [
            _names(
                "input_columns",
                ["match_date", "home", "away", "h_points", "a_points", "event", "elsewhere", "remark"],
            ),
            _names("output_columns", _CONTRACT.split(", ")),
            _names("added_columns", ["city", "country"]),
            _names("dropped_columns", ["remark"]),
            _names(
                "renamed_columns",
                [
                    "match_date -> date",
                    "home -> home_team",
                    "away -> away_team",
                    "h_points -> home_score",
                    "a_points -> away_score",
                    "event -> tournament",
                    "elsewhere -> neutral",
                ],
            ),
            _line("source_file", [(1, "''")]),
            _line("output_file", [(1, "NULL")]),
            "SELECT 'input_rows', 1, CAST(n AS VARCHAR) FROM counts",
            "SELECT 'output_rows', 1, CAST(n AS VARCHAR) FROM counts",
            "SELECT 'is_successful', 1, CASE WHEN no_date + bad_home + bad_away + same_team = 0 THEN 'true' ELSE 'false' END FROM counts",
        ]
    )
    return f"""{RAW}, {_RULES}, numbered AS ({" UNION ALL ".join(numbered)})
SELECT section, CAST(ROW_NUMBER() OVER (PARTITION BY section ORDER BY rank) AS INT) AS position, value
FROM numbered WHERE n > 0 UNION ALL SELECT section, CAST(position AS INT), value FROM ({fixed}) f"""


_AS_READ = ["date", "home_team", "away_team", "home_score", "away_score", "tournament", "neutral"]
_RAW_NAMES = ["match_date", "home", "away", "h_points", "a_points", "event", "elsewhere", "remark"]


def _column_profile(names: list[str], rows: str) -> str:
    columns = [(name, "date" if name == "date" else "string") for name in names]
    return RAW + " UNION ALL ".join(
        f"""
SELECT CAST({i + 1} AS INT) AS position, '{name}' AS column_name, '{kind}' AS data_type,
       COUNT(*) - COUNT({name}) AS missing_count,
       {_round(f"(100 * (COUNT(*) - COUNT({name})))", "COUNT(*)", 2)} AS missing_pct,
       COUNT(DISTINCT {name}) AS distinct_count
FROM {rows}"""
        for i, (name, kind) in enumerate(columns)
    )


_FACT_MATCH = "home_team || ' ' || home_score || ':' || away_score || ' ' || away_team"
_FACT_DATED = f"strftime(match_date, '%Y-%m-%d') || ': ' || {_FACT_MATCH}"


def _facts() -> str:
    def match(name: str, value: str, details: str, order: str, where: str = "TRUE") -> str:
        return (
            f"SELECT '{name}' AS fact_name, {value} AS fact_value, {details} AS details FROM "
            f"(SELECT * FROM matches WHERE {where} ORDER BY {order} LIMIT 1) f"
        )

    def group(name: str, key: str) -> str:
        return (
            f"SELECT '{name}', k, n || ' matches' FROM (SELECT {key} AS k, COUNT(*) AS n FROM matches "
            f"WHERE {key} IS NOT NULL GROUP BY 1 ORDER BY n DESC, k LIMIT 1) f"
        )

    day = "strftime(match_date, '%Y-%m-%d')"
    cents = f"((200 * CAST(SUM({_GOALS}) AS BIGINT) + COUNT(*)) // (2 * COUNT(*)))"
    parts = [
        match("Oldest recorded match", day, _FACT_MATCH, "match_date, match_id"),
        match("Most recent recorded match", day, _FACT_MATCH, "match_date DESC, match_id DESC"),
        "SELECT 'Most active year', CAST(y AS VARCHAR), n || ' matches' FROM "
        f"(SELECT {_YEAR} AS y, COUNT(*) AS n FROM matches GROUP BY 1 ORDER BY n DESC, y DESC LIMIT 1) f",
        "SELECT 'Highest-scoring year (50+ matches)', CAST(y AS VARCHAR), "
        "(m // 100) || '.' || lpad(CAST(m % 100 AS VARCHAR), 2, '0') || ' goals per match across ' || n || ' matches' FROM "
        f"(SELECT {_YEAR} AS y, COUNT(*) AS n, {cents} AS m FROM matches GROUP BY 1 HAVING COUNT(*) >= 50 "
        "ORDER BY m DESC, n DESC, y DESC LIMIT 1) f",
        group("Tournament with most matches", "tournament"),
        group("Country hosting the most matches", "country"),
        group("Most frequent host city", "city"),
        match(
            "Biggest home win",
            f"{_DIFF} || '-goal margin'",
            _FACT_DATED,
            "home_score - away_score DESC, home_score DESC, match_date, match_id",
            _HOME,
        ),
        match(
            "Biggest away win",
            f"{_DIFF} || '-goal margin'",
            _FACT_DATED,
            "away_score - home_score DESC, away_score DESC, match_date, match_id",
            _AWAY,
        ),
        match(
            "Highest-scoring single match",
            f"({_GOALS}) || ' total goals'",
            _FACT_DATED,
            f"{_GOALS} DESC, greatest(home_score, away_score) DESC, match_date, match_id",
        ),
        group("Most common scoreline", "concat(home_score, ':', away_score)"),
    ]
    return MATCHES + " UNION ALL ".join("\n" + p for p in parts)


_SUSPICIOUS = "home_score > 20 OR away_score > 20"
_REVIEW = "match_date, home_team, away_team, home_score, away_score, tournament, city, country"
_WINNER = "CASE WHEN home_score > away_score THEN home_team ELSE away_team END AS winner"
_LOSER = "CASE WHEN home_score > away_score THEN away_team ELSE home_team END AS loser"
_KPIS = """
SELECT COUNT(*) AS matches,
       (SELECT COUNT(DISTINCT team) FROM (SELECT home_team AS team FROM slice UNION SELECT away_team FROM slice) t) AS teams,
       COUNT(DISTINCT tournament) AS tournaments, COUNT(DISTINCT country) AS countries,
       MIN(date) AS first_date, MAX(date) AS last_date, AVG(total_goals) AS avg_goals
FROM slice"""
_TALLY = """COUNT(*) AS matches, CAST(SUM(is_win) AS BIGINT) AS wins, CAST(SUM(is_draw) AS BIGINT) AS draws,
       CAST(SUM(is_loss) AS BIGINT) AS losses, CAST(SUM(goals_for) AS BIGINT) AS goals_for,
       CAST(SUM(goals_against) AS BIGINT) AS goals_against"""
_TEAM_YEARS = f"SELECT year, {_TALLY} FROM team_long WHERE team = '{_TEAM}' GROUP BY year"


def oracle_sql() -> dict[str, str]:
    slice_ = f", slice AS (SELECT * FROM enriched WHERE tournament = '{_TOURNAMENT}')"
    explorer = f"{ENRICHED} SELECT * FROM enriched WHERE {{}} ORDER BY date DESC, match_id LIMIT {{}}"
    found = {
        "csv_roundtrip": RAW
        + " SELECT match_date, trim(home) AS home, trim(away) AS away, trim(h_points) AS h_points,"
        " trim(a_points) AS a_points, trim(event) AS event, trim(elsewhere) AS elsewhere,"
        " remark FROM raw_matches",
        "csv_directory": RAW
        + " SELECT trim(event) AS event, COUNT(*) AS row_count FROM raw_matches GROUP BY 1",
        "csv_multi_line": RAW
        + """ SELECT match_date, trim(home) AS home, concat(remark, chr(10), '"', trim(event), '"') AS note FROM raw_matches""",
        "csv_mixed_headers": MATCHES
        + " SELECT CASE WHEN neutral THEN 'true' ELSE 'false' END AS neutral, CAST(year(match_date) AS INT) AS year,"
        " COUNT(*) AS row_count, COUNT(CASE WHEN neutral THEN city END) AS with_city, CAST(3 AS BIGINT) AS file_count"
        " FROM matches WHERE neutral IS NOT NULL GROUP BY 1, 2",
        "mapping_check": RAW
        + " SELECT unnest(['Mapping contains unknown target fields: venue.', 'Mapping is missing required target fields: tournament.',"
        " 'Mapping reuses the same source column for multiple target fields: home.',"
        " 'Source column ''town'' for target ''city'' was not found.']) AS problem, COUNT(*) AS rows FROM raw_matches",
        "export_slice": ENRICHED
        + " SELECT date, home_team, away_team, CAST(home_score AS VARCHAR) AS home_score,"
        " CAST(away_score AS VARCHAR) AS away_score, tournament, city, country,"
        " CASE WHEN neutral THEN 'true' ELSE 'false' END AS neutral"
        " FROM enriched WHERE year BETWEEN 1994 AND 1996 AND neutral",
        "standardize_job": f"{ENRICHED} SELECT {_CONTRACT} FROM enriched",
        "load_matches": f"{MATCHES} SELECT {_LOADED}, 'season.csv' AS source_file FROM matches",
        "rows_by_source": MATCHES
        + " SELECT 'all.csv' AS source_file, COUNT(*) AS row_count FROM matches"
        " UNION ALL SELECT 'neutral.csv', COUNT(*) FROM matches WHERE neutral",
        "open_matches": MATCHES
        + " SELECT tournament, COUNT(*) AS row_count, MAX(match_date) AS last_date, 'table' AS source_kind"
        " FROM matches GROUP BY tournament",
        "prepare_for_load": f"{MATCHES} SELECT {_LOADED}, 'season.csv' AS source_file FROM matches",
        "standardize_matches": f"{RAW} SELECT {_CONTRACT} FROM standard",
        "transform_audit": _audit(),
        "score_coercion": RAW
        + " SELECT h_points AS raw_score, CASE WHEN regexp_full_match(h_points, '-?[0-9]+([.]0)?')"
        " THEN CAST(CAST(h_points AS DOUBLE) AS BIGINT) END AS score, COUNT(*) AS row_count FROM raw_matches GROUP BY 1, 2",
        "neutral_normalization": RAW
        + " SELECT elsewhere AS raw_neutral, CASE lower(trim(elsewhere)) WHEN 'true' THEN TRUE WHEN '1' THEN TRUE"
        " WHEN 'yes' THEN TRUE WHEN 'y' THEN TRUE WHEN 'neutral' THEN TRUE WHEN 'false' THEN FALSE WHEN '0' THEN FALSE"
        " WHEN 'no' THEN FALSE WHEN 'n' THEN FALSE WHEN 'home' THEN FALSE END AS neutral, COUNT(*) AS row_count"
        " FROM raw_matches GROUP BY 1, 2",
        "validation_report": f"{RAW}, {_RULES} SELECT * FROM report",
        "validation_summary": f"""{RAW}, {_RULES}
SELECT (SELECT COUNT(*) FROM report WHERE severity = 'error') = 0 AS is_valid,
       CAST((SELECT COUNT(*) FROM report WHERE severity = 'error') AS INT) AS error_count,
       CAST((SELECT COUNT(*) FROM report WHERE severity = 'warning') AS INT) AS warning_count,
       n AS row_count, CAST(7 AS INT) AS column_count FROM counts""",
        "dataset_profile": f"""{RAW}, {_RULES}
SELECT 'raw.csv' AS source_file, COUNT(*) AS row_count, CAST(7 AS INT) AS column_count,
       (SELECT copies FROM read_copies) AS duplicate_row_count,
       strftime(MIN(date), '%Y-%m-%d') AS date_min, strftime(MAX(date), '%Y-%m-%d') AS date_max,
       COUNT(DISTINCT home_team) AS home_team_count, COUNT(DISTINCT away_team) AS away_team_count,
       COUNT(DISTINCT tournament) AS tournament_count FROM as_read""",
        "column_profile": _column_profile(_AS_READ, "as_read"),
        "profile_job": _column_profile(_RAW_NAMES, f"(SELECT {', '.join(f'trim({c}) AS {c}' for c in _RAW_NAMES)} FROM raw_matches) t"),
        "validation_edge": f"""{ENRICHED}
SELECT 'text date' AS shape, 'V8' AS rule_id, 'error' AS severity, 'date' AS "column", CAST(1 AS BIGINT) AS violations,
       'Column ''date'' must be converted to datetime.' AS message
UNION ALL SELECT 'text date', 'V6', 'warning', 'home_score', COUNT(*), 'Column ''home_score'' contains suspiciously large scores above 20.'
FROM enriched WHERE home_score > 20 HAVING COUNT(*) > 0
UNION ALL SELECT 'text date', 'V6', 'warning', 'away_score', COUNT(*), 'Column ''away_score'' contains suspiciously large scores above 20.'
FROM enriched WHERE away_score > 20 HAVING COUNT(*) > 0
UNION ALL SELECT 'no tournament', 'V2', 'error', NULL, 1, 'Missing required columns: tournament.'
UNION ALL SELECT 'no rows', 'V1', 'error', NULL, 1, 'DataFrame is empty.'""",
        "rollup_validation": f"""{ENRICHED}
SELECT 'V6' AS rule_id, 'warning' AS severity, 'home_score' AS "column", COUNT(*) AS violations,
       'Column ''home_score'' contains suspiciously large scores above 20.' AS message
FROM enriched WHERE home_score > 20 HAVING COUNT(*) > 0
UNION ALL SELECT 'V6', 'warning', 'away_score', COUNT(*), 'Column ''away_score'' contains suspiciously large scores above 20.'
FROM enriched WHERE away_score > 20 HAVING COUNT(*) > 0
UNION ALL SELECT 'V10', 'warning', 'date', COUNT(*), 'Some match dates are in the future.'
FROM enriched WHERE date > DATE '1998-01-01' HAVING COUNT(*) > 0""",
        "load_ids": MATCHES
        + " SELECT 2 * COUNT(*) AS row_count, CAST(1 AS BIGINT) AS first_id, 2 * COUNT(*) AS last_id, 2 * COUNT(*) AS distinct_ids FROM matches",
        "enrich_matches": f"{ENRICHED} SELECT * FROM enriched",
        "team_long": f"{SIDES} SELECT * FROM team_long",
        "unique_teams": f"{MATCHES} SELECT home_team AS team_name FROM matches UNION SELECT away_team FROM matches",
        "global_filters": f"{ENRICHED} SELECT * FROM enriched WHERE year BETWEEN 1993 AND 1997"
        " AND country = 'NATION_0' AND NOT neutral ORDER BY date, match_id",
        "global_filters_team": f"{ENRICHED} SELECT * FROM enriched WHERE year >= 1993 AND tournament = 'AUTOMOBILE 5-LOW'"
        f" AND (home_team = '{_TEAM}' OR away_team = '{_TEAM}') AND neutral",
        "match_explorer": explorer.format(
            "(regexp_matches(lower(home_team), 'nation_1.*build') OR regexp_matches(lower(away_team), 'nation_1.*build'))"
            " AND total_goals >= 3",
            500,
        ),
        "match_explorer_draws": explorer.format(
            "(contains(lower(home_team), 'nation_2') OR contains(lower(away_team), 'nation_2'))"
            " AND total_goals >= 0 AND result = 'Draw'",
            500,
        ),
        "match_explorer_big_wins": explorer.format("goal_difference >= 5", 100),
        "dataset_overview": f"""{MATCHES}
SELECT COUNT(*) AS match_count, MIN(match_date) AS min_match_date, MAX(match_date) AS max_match_date,
       (SELECT COUNT(*) FROM (SELECT home_team FROM matches UNION SELECT away_team FROM matches) t) AS unique_team_count,
       COUNT(DISTINCT tournament) AS tournament_count, COUNT(DISTINCT country) AS country_count FROM matches""",
        "matches_by_year": f"{MATCHES} SELECT {_YEAR} AS match_year, COUNT(*) AS match_count,"
        f" {_mean(_GOALS, 2)} AS avg_total_goals FROM matches GROUP BY 1 ORDER BY 1",
        "home_advantage": f"""{MATCHES}
SELECT {_VENUE.format('neutral', 'non_neutral', 'unknown')} AS venue_type, COUNT(*) AS match_count,
       {_ones(_HOME)} AS home_wins, {_ones(_LEVEL)} AS draws, {_ones(_AWAY)} AS away_wins,
       {_pct(_HOME)} AS home_win_pct, {_pct(_LEVEL)} AS draw_pct, {_pct(_AWAY)} AS away_win_pct
FROM matches GROUP BY 1 ORDER BY 1""",
        "most_successful_teams": f"""{SIDES}
SELECT team, COUNT(*) AS matches, {_ones('goals_for > goals_against')} AS wins,
       {_ones('goals_for = goals_against')} AS draws, {_ones('goals_for < goals_against')} AS losses,
       CAST(SUM(goals_for) AS BIGINT) AS goals_for, CAST(SUM(goals_against) AS BIGINT) AS goals_against,
       CAST(SUM(goals_for) - SUM(goals_against) AS BIGINT) AS goal_difference,
       {_pct('goals_for > goals_against')} AS win_rate
FROM sides GROUP BY team ORDER BY wins DESC, win_rate DESC, goal_difference DESC, matches DESC, team LIMIT 20""",
        "highest_scoring_teams": f"""{SIDES}
SELECT team, COUNT(*) AS matches, CAST(SUM(goals_for) AS BIGINT) AS goals_for,
       CAST(SUM(goals_against) AS BIGINT) AS goals_against,
       {_mean('goals_for', 3)} AS avg_goals_for, {_mean('goals_against', 3)} AS avg_goals_against
FROM sides GROUP BY team HAVING COUNT(*) >= 100 ORDER BY avg_goals_for DESC, 3 DESC, team LIMIT 20""",
        "top_scoring_teams": f"""{SIDES}
SELECT team, COUNT(*) AS matches, CAST(SUM(goals_for) AS BIGINT) AS goals_scored,
       CAST(SUM(goals_against) AS BIGINT) AS goals_allowed, {_mean('goals_for', 2)} AS avg_goals_per_match
FROM sides GROUP BY team HAVING COUNT(*) >= 100 ORDER BY goals_scored DESC, team LIMIT 20""",
        "biggest_wins_report": f"""{MATCHES}
SELECT match_date, home_team, away_team, home_score, away_score, {_DIFF} AS goal_difference, {_WINNER}, {_LOSER},
       CASE WHEN home_score > away_score THEN 'home' ELSE 'away' END AS winner_side, tournament
FROM matches WHERE home_score <> away_score
ORDER BY {_DIFF} DESC, {_GOALS} DESC, match_date, match_id LIMIT 20""",
        "biggest_wins": f"""{MATCHES}
SELECT match_date, {_WINNER}, {_LOSER}, concat(home_score, ':', away_score) AS score, {_DIFF} AS goal_difference, tournament
FROM matches WHERE home_score <> away_score
ORDER BY {_DIFF} DESC, greatest(home_score, away_score) DESC, match_date, match_id LIMIT 25""",
        "tournament_analysis": f"""{MATCHES}
SELECT tournament, COUNT(*) AS match_count, {_mean(_GOALS, 2)} AS avg_total_goals, {_mean(_DIFF, 2)} AS avg_goal_difference
FROM matches GROUP BY tournament HAVING COUNT(*) >= 50 ORDER BY match_count DESC, tournament LIMIT 20""",
        "tournament_summary": f"""{MATCHES}
SELECT tournament, COUNT(*) AS match_count, MIN(match_date) AS first_match_date, MAX(match_date) AS last_match_date,
       {_mean(_GOALS, 2)} AS avg_total_goals
FROM matches GROUP BY tournament HAVING COUNT(*) >= 50 ORDER BY match_count DESC, tournament LIMIT 30""",
        "score_quality_review": f"{MATCHES} SELECT {_REVIEW}, greatest(home_score, away_score) AS max_side_score,"
        f" {_GOALS} AS total_goals FROM matches WHERE {_SUSPICIOUS}"
        " ORDER BY max_side_score DESC, total_goals DESC, match_date",
        "score_quality_check": f"{MATCHES} SELECT {_REVIEW} FROM matches WHERE {_SUSPICIOUS}"
        " ORDER BY greatest(home_score, away_score) DESC, match_date",
        "interesting_facts": _facts(),
        "home_advantage_shares": f"""{MATCHES}
SELECT COUNT(*) AS non_neutral_matches, {_ones(_HOME)} AS home_wins, {_ones(_LEVEL)} AS draws, {_ones(_AWAY)} AS away_wins,
       {_share(_HOME, 'NULLIF(COUNT(*), 0)')} AS home_win_share, {_share(_LEVEL, 'NULLIF(COUNT(*), 0)')} AS draw_share,
       {_share(_AWAY, 'NULLIF(COUNT(*), 0)')} AS away_win_share
FROM matches WHERE neutral IS FALSE""",
        "neutral_vs_non_neutral": f"""{MATCHES}
SELECT {_VENUE.format('true', 'false', 'null')} AS neutral_status, COUNT(*) AS match_count,
       {_mean(_GOALS, 2)} AS avg_total_goals, {_share(_LEVEL)} AS draw_share, {_share(_HOME)} AS home_win_share
FROM matches GROUP BY 1 ORDER BY 1""",
        "overview_kpis": f"{ENRICHED}, slice AS (SELECT * FROM enriched) {_KPIS}",
        "overview_insights": f"""{ENRICHED},
peak AS (SELECT year AS peak_year, COUNT(*) AS peak_year_matches FROM enriched GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1),
top AS (SELECT tournament AS top_tournament, COUNT(*) AS top_tournament_matches FROM enriched GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)
SELECT (SELECT peak_year FROM peak) AS peak_year, (SELECT peak_year_matches FROM peak) AS peak_year_matches,
       (SELECT top_tournament FROM top) AS top_tournament,
       (SELECT top_tournament_matches FROM top) AS top_tournament_matches,
       {_RESULT_AVG.format('Home win')} AS home_win_pct, AVG(total_goals) AS avg_goals,
       AVG(CASE WHEN neutral THEN 1 ELSE 0 END) * 100 AS neutral_pct FROM enriched""",
        "filter_options": f"""{ENRICHED}
SELECT 'team' AS dimension, home_team AS value FROM enriched UNION SELECT 'team', away_team FROM enriched
UNION SELECT 'tournament', tournament FROM enriched
UNION SELECT 'country', country FROM enriched WHERE country IS NOT NULL
UNION ALL SELECT 'year_min', CAST(MIN(year) AS VARCHAR) FROM enriched
UNION ALL SELECT 'year_max', CAST(MAX(year) AS VARCHAR) FROM enriched""",
        "outcome_distribution": f"""{ENRICHED}
SELECT result, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM enriched) AS share,
       CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM enriched) * 100 AS share_pct FROM enriched GROUP BY result""",
        "goals_histogram": f"{ENRICHED} SELECT total_goals AS bin_start, COUNT(*) AS matches FROM enriched GROUP BY 1 ORDER BY 1",
        "goals_histogram_2": f"{ENRICHED} SELECT total_goals // 2 * 2 AS bin_start, COUNT(*) AS matches FROM enriched GROUP BY 1 ORDER BY 1",
        "scoreline_frequency": _ranked("concat(home_score, ':', away_score)", "scoreline", None),
        "top_tournaments": _ranked("tournament", "tournament", 20),
        "top_host_countries": _ranked("country", "country", 15, "WHERE country IS NOT NULL"),
        "top_host_cities": _ranked("city", "city", 15, "WHERE city IS NOT NULL"),
        "matches_per_year": f"{ENRICHED} SELECT year, COUNT(*) AS matches, AVG(total_goals) AS avg_total_goals"
        " FROM enriched GROUP BY year ORDER BY year",
        "yearly_trends": f"{ENRICHED}, {_TRENDS} SELECT * FROM trends ORDER BY year",
        "yearly_trends_known": f"{ENRICHED}, {_TRENDS} SELECT * FROM trends WHERE home_win_share IS NOT NULL ORDER BY year",
        "yearly_trends_smoothed": _smoothed(3),
        "yearly_trends_smoothed_5": _smoothed(5),
        "venue_comparison": f"""{ENRICHED},
g AS (SELECT {_VENUE_VIEW} AS venue_type, result, COUNT(*) AS matches FROM enriched GROUP BY 1, 2),
t AS (SELECT venue_type, CAST(SUM(matches) AS BIGINT) AS venue_matches FROM g GROUP BY 1)
SELECT venue_type, result, matches, venue_matches, CAST(matches AS DOUBLE) / venue_matches * 100 AS share_pct
FROM g LEFT JOIN t USING (venue_type)""",
        "home_advantage_table": f"""{ENRICHED}
SELECT {_VENUE_VIEW} AS venue_type, COUNT(*) AS matches, {_mean('home_score', 2)} AS avg_home_goals,
       {_mean('away_score', 2)} AS avg_away_goals, {_pct("result = 'Home win'")} AS home_win_share,
       {_pct("result = 'Draw'")} AS draw_share, {_pct("result = 'Away win'")} AS away_win_share
FROM enriched GROUP BY 1 ORDER BY 1""",
        "home_win_shift": f"""{ENRICHED}
SELECT (SELECT {_RESULT_AVG.format('Home win')} FROM enriched WHERE NOT neutral) AS non_neutral_home_win_pct,
       (SELECT {_RESULT_AVG.format('Home win')} FROM enriched WHERE neutral) AS neutral_home_win_pct""",
        "team_ranking": f"{SIDES} SELECT * FROM ranking ORDER BY wins DESC, matches DESC, team",
        "top_teams_by_wins": f"{SIDES} SELECT * FROM ranking ORDER BY wins DESC, win_rate DESC, team LIMIT 20",
        "top_teams_by_win_rate": f"{SIDES} SELECT * FROM ranking WHERE matches >= 100"
        " ORDER BY win_rate DESC, wins DESC, team LIMIT 20",
        "top_teams_by_avg_goals": f"{SIDES} SELECT * FROM ranking WHERE matches >= 100"
        " ORDER BY avg_goals_for DESC, goals_for DESC, team LIMIT 20",
        "team_summary": f"""{SIDES}
SELECT COUNT(*) AS matches, COALESCE(CAST(SUM(is_win) AS BIGINT), 0) AS wins,
       COALESCE(CAST(SUM(is_draw) AS BIGINT), 0) AS draws, COALESCE(CAST(SUM(is_loss) AS BIGINT), 0) AS losses,
       COALESCE(CAST(SUM(is_win) AS DOUBLE) / NULLIF(COUNT(*), 0), 0.0) * 100 AS win_rate,
       COALESCE(CAST(SUM(goals_for) AS BIGINT), 0) AS goals_for,
       COALESCE(CAST(SUM(goals_against) AS BIGINT), 0) AS goals_against,
       COALESCE(CAST(SUM(goals_for) - SUM(goals_against) AS BIGINT), 0) AS goal_difference,
       COALESCE(CAST(SUM(goals_for) AS DOUBLE) / NULLIF(COUNT(*), 0), 0.0) AS avg_goals_for
FROM team_long WHERE team = '{_TEAM}'""",
        "team_yearly_results": f"{SIDES} {_TEAM_YEARS} ORDER BY year",
        "team_results_long": f"""{SIDES}, y AS ({_TEAM_YEARS})
SELECT year, matches, goals_for, goals_against, 'wins' AS result_type, wins AS result_count FROM y
UNION ALL SELECT year, matches, goals_for, goals_against, 'draws', draws FROM y
UNION ALL SELECT year, matches, goals_for, goals_against, 'losses', losses FROM y""",
        "team_top_opponents": f"{SIDES} SELECT opponent, COUNT(*) AS matches, CAST(SUM(is_win) AS BIGINT) AS wins"
        f" FROM team_long WHERE team = '{_TEAM}' GROUP BY opponent ORDER BY matches DESC, wins DESC, opponent LIMIT 10",
        "team_latest_matches": f"{SIDES} SELECT date, team, opponent, goals_for, goals_against, match_result, tournament,"
        f" city, country, neutral, venue_role FROM team_long WHERE team = '{_TEAM}' ORDER BY date DESC, match_id LIMIT 20",
        "tournament_teams": f"{SIDES} SELECT team, COUNT(*) AS matches, CAST(SUM(is_win) AS BIGINT) AS wins"
        f" FROM team_long WHERE tournament = '{_TOURNAMENT}' GROUP BY team ORDER BY wins DESC, matches DESC, team",
        "tournament_kpis": f"{ENRICHED}{slice_}, k AS ({_KPIS}) SELECT matches, teams, avg_goals, first_date, last_date FROM k",
        "tournament_by_year": f"{ENRICHED}{slice_} SELECT year, COUNT(*) AS matches FROM slice GROUP BY year ORDER BY year",
        "biggest_wins_slice": f"{ENRICHED}{slice_} SELECT date, home_team, away_team, home_score, away_score,"
        " goal_difference, tournament, country FROM slice"
        " ORDER BY goal_difference DESC, total_goals DESC, date DESC, match_id LIMIT 10",
    }
    found |= {"open_matches_file": found["most_successful_teams"], "standardize_layouts": found["standardize_job"]}
    return found | {f"rollup_{name}": found[name] for name in ("home_advantage", "team_ranking", "tournament_summary")}
