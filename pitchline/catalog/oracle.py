"""Oracle SQL (DuckDB dialect) for each registered query key; written
independently of the Spark code from the operator definitions."""

from __future__ import annotations

from pitchline.catalog.views_sql import with_views as W

ORACLE: dict[str, str] = {}

ORACLE["pivot_stats"] = W("t2_standings") + "SELECT * FROM t2_standings"

# team performance summary as a reusable CTE named ``tps``
TPS_BODY = """,
perf AS (
  SELECT group_id, group_name, team_id, team_name,
    CAST(gamesPlayed AS INT) AS games_played, CAST(wins AS INT) AS wins,
    CAST(losses AS INT) AS losses, CAST(ties AS INT) AS ties, CAST(points AS INT) AS points,
    CAST(pointsPerGame AS DOUBLE) AS points_per_game, CAST(goalsFor AS INT) AS goals_for,
    CAST(goalsAgainst AS INT) AS goals_against, CAST(goalDifferential AS INT) AS goal_differential,
    CAST(rank AS INT) AS group_rank
  FROM t2_standings WHERE gamesPlayed IS NOT NULL AND points IS NOT NULL),
tps AS (
  SELECT *,
    CASE WHEN games_played > 0 THEN wins / games_played * 100 ELSE 0 END AS win_percentage,
    CASE WHEN games_played > 0 THEN goals_for / games_played ELSE 0 END AS goals_per_game,
    CASE WHEN games_played > 0 THEN goals_against / games_played ELSE 0 END AS goals_conceded_per_game,
    points_per_game * 10 + goal_differential AS performance_rating,
    CAST(ROW_NUMBER() OVER (ORDER BY points DESC, goal_differential DESC, team_id) AS BIGINT) AS overall_rank
  FROM perf)
"""
TPS = W("t2_standings") + TPS_BODY

ORACLE["team_performance_summary"] = TPS + "SELECT * FROM tps"

ORACLE["competition_overview"] = W("t2_standings") + """
SELECT count(DISTINCT team_id) AS total_teams, count(DISTINCT group_id) AS total_groups,
  CAST(sum(CAST(gamesPlayed AS INT)) AS BIGINT) AS total_games_played,
  CAST(sum(CAST(goalsFor AS INT)) AS BIGINT) AS total_goals_scored,
  avg(CAST(goalsFor AS INT)) AS avg_goals_per_team,
  max(CAST(points AS INT)) AS max_points, min(CAST(points AS INT)) AS min_points,
  CASE WHEN sum(CAST(gamesPlayed AS INT)) > 0
       THEN CAST(sum(CAST(goalsFor AS INT)) AS BIGINT) / CAST(sum(CAST(gamesPlayed AS INT)) AS BIGINT)
       ELSE 0 END AS goals_per_game,
  'Competition' AS competition_name, '2024-25' AS season
FROM t2_standings"""

ORACLE["group_analysis"] = W("t2_standings") + """,
g AS (
  SELECT group_id, group_name, count(*) AS teams_in_group,
    CAST(sum(CAST(gamesPlayed AS INT)) AS BIGINT) AS total_games_played,
    CAST(sum(CAST(goalsFor AS INT)) AS BIGINT) AS total_goals_scored,
    avg(CAST(points AS INT)) AS avg_points_per_team,
    max(CAST(points AS INT)) AS group_leader_points, min(CAST(points AS INT)) AS group_lowest_points,
    avg(CAST(goalDifferential AS INT)) AS avg_goal_differential,
    max(CAST(goalDifferential AS INT)) AS best_goal_differential,
    min(CAST(goalDifferential AS INT)) AS worst_goal_differential
  FROM t2_standings GROUP BY group_id, group_name),
s AS (
  SELECT *, group_leader_points - group_lowest_points AS points_spread,
    CASE WHEN group_leader_points - group_lowest_points > 0
         THEN 100 / (group_leader_points - group_lowest_points) ELSE 100.0 END AS competitiveness_score,
    CASE WHEN total_games_played > 0 THEN total_goals_scored / total_games_played ELSE 0 END AS goals_per_game
  FROM g)
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY competitiveness_score DESC, group_id) AS BIGINT) AS competitiveness_rank
FROM s"""

ORACLE["team_roster_summary"] = W("t3_athletes") + """
SELECT CAST(team_id AS VARCHAR) AS team_id, team_name, CAST(NULL AS VARCHAR) AS team_abbreviation,
  count(*) AS total_players, avg(athlete_age) AS avg_age, min(athlete_age) AS min_age,
  max(athlete_age) AS max_age, avg(athlete_weight) AS avg_weight, avg(athlete_height) AS avg_height,
  array_to_string(list_sort(list_distinct(list(athlete_nationality))), ',') AS nationalities,
  array_to_string(list_sort(list_distinct(list(athlete_position))), ',') AS positions,
  CAST(len(list_distinct(list(athlete_nationality))) AS INT) AS nationality_count,
  CAST(len(list_distinct(list(athlete_position))) AS INT) AS position_count,
  max(athlete_age) - min(athlete_age) AS age_diversity
FROM t3_athletes WHERE team_id IS NOT NULL GROUP BY team_id, team_name"""

_AGE_GROUP = """CASE WHEN {x} <= 21 THEN 'Youth (≤21)' WHEN {x} <= 25 THEN 'Young (22-25)'
  WHEN {x} <= 29 THEN 'Prime (26-29)' WHEN {x} <= 33 THEN 'Experienced (30-33)'
  ELSE 'Veteran (34+)' END"""
_BMI = """CASE WHEN athlete_weight IS NOT NULL AND athlete_height IS NOT NULL AND athlete_height > 0
  THEN athlete_weight / (athlete_height / 100) / (athlete_height / 100) END"""

ORACLE["player_analytics"] = W("t3_athletes") + f"""
SELECT athlete_id, athlete_full_name AS player_name, athlete_age AS age,
  athlete_weight AS weight_kg, athlete_height AS height_cm, athlete_nationality AS nationality,
  athlete_position AS position, CAST(team_id AS VARCHAR) AS team_id,
  CASE WHEN team_id IS NOT NULL THEN team_name END AS team_name,
  CAST(NULL AS VARCHAR) AS team_abbreviation,
  {_AGE_GROUP.format(x='athlete_age')} AS age_group, {_BMI} AS bmi
FROM t3_athletes WHERE athlete_full_name IS NOT NULL AND athlete_age IS NOT NULL"""

ORACLE["age_bucket"] = f"""
SELECT p_partkey, p_size, {_AGE_GROUP.format(x='p_size')} AS age_group FROM part"""

ORACLE["bmi"] = W("t3_athletes") + f"SELECT athlete_id, {_BMI} AS bmi FROM t3_athletes"

ORACLE["cast_safe"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
  TRY_CAST(event_type AS INTEGER) AS type_int,
  TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS value_double,
  TRY_CAST(CONCAT(CAST(user_id AS VARCHAR), 'x') AS BIGINT) AS junk_bigint
FROM events"""

ORACLE["kpi_points_per_game"] = W("t2_standings") + """
SELECT team_id, CASE WHEN gamesPlayed > 0 THEN points / gamesPlayed ELSE 0 END AS points_per_game
FROM t2_standings"""

ORACLE["expected_points"] = W("t2_standings") + """
SELECT team_id, CAST(goalDifferential AS INT) AS goal_differential,
  CASE WHEN CAST(goalDifferential AS INT) > 0 THEN 3 WHEN CAST(goalDifferential AS INT) = 0 THEN 1 ELSE 0 END
    AS expected_points
FROM t2_standings"""

ORACLE["qualification_status"] = W("t2_standings") + """
SELECT group_id, team_id, CAST(rank AS INT) AS group_rank,
  CASE WHEN CAST(rank AS INT) <= 2 THEN 'Qualified' WHEN CAST(rank AS INT) = 3 THEN 'Europa League'
       ELSE 'Eliminated' END AS qualification_status
FROM t2_standings"""

_OUTCOME = """CASE WHEN home_score > away_score THEN 'Win' WHEN home_score = away_score THEN 'Draw'
  WHEN home_score < away_score THEN 'Loss' END"""

ORACLE["match_outcome"] = W("t4_matches") + f"""
SELECT event_id, home_team_id, away_team_id, home_score, away_score, {_OUTCOME} AS outcome
FROM t4_matches"""

ORACLE["team_stats_table"] = W("t2_standings") + """
SELECT team_id, team_name, CAST(gamesPlayed AS INT) AS games_played,
  CONCAT_WS('-', CAST(CAST(wins AS INT) AS VARCHAR), CAST(CAST(ties AS INT) AS VARCHAR),
            CAST(CAST(losses AS INT) AS VARCHAR)) AS record,
  CAST(points AS INT) AS points, CAST(goalsFor AS INT) AS goals_for,
  CAST(goalsAgainst AS INT) AS goals_against, CAST(goalDifferential AS INT) AS goal_differential
FROM t2_standings WHERE gamesPlayed IS NOT NULL AND points IS NOT NULL"""

ORACLE["audit_columns"] = W("t2_standings") + """
SELECT group_id, team_id, points, '2024-07-01T00:00:00' AS transformation_timestamp,
  'silver' AS data_layer, 'standings' AS dataset_name
FROM t2_standings"""

ORACLE["filter_not_null"] = W("t3_athletes") + """
SELECT athlete_id, athlete_age, athlete_weight FROM t3_athletes
WHERE athlete_age IS NOT NULL AND athlete_weight IS NOT NULL"""

ORACLE["having_filter"] = W("t3_athletes") + """
SELECT team_id, count(*) AS players FROM t3_athletes GROUP BY team_id HAVING team_id IS NOT NULL"""

ORACLE["latest_snapshot"] = W("t5_fact_team_performance") + """
SELECT * FROM t5_fact_team_performance
WHERE date_id = (SELECT max(date_id) FROM t5_fact_team_performance)"""


def _dec(x: str, p: int = 5, s: int = 2) -> str:
    """Spark's double → decimal cast rounds the shortest decimal text of the
    double half-up; DuckDB's cast rounds the binary value, so go via text."""
    return f"TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL({p},{s}))"


_PLAYERS = """players AS (
  SELECT * FROM t3_athletes WHERE athlete_full_name IS NOT NULL AND athlete_age IS NOT NULL)"""

ORACLE["dim_teams"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS team_id, s_name AS team_name,
  CAST(NULL AS VARCHAR) AS team_abbreviation, s_name AS team_display_name, n_name AS team_location,
  CAST(NULL AS VARCHAR) AS team_color, CAST(NULL AS VARCHAR) AS team_alternate_color,
  COALESCE(CASE WHEN s_acctbal >= 0 THEN s_acctbal > 1000 END, TRUE) AS team_is_active,
  CAST(NULL AS VARCHAR) AS team_logos
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

ORACLE["dim_players"] = W("t3_athletes") + f""", {_PLAYERS}
SELECT CAST(athlete_id AS VARCHAR) AS player_id, athlete_full_name AS player_name,
  CAST(NULL AS VARCHAR) AS player_display_name, athlete_age AS age,
  {_dec('athlete_weight')} AS weight_kg, {_dec('athlete_height')} AS height_cm,
  CAST(NULL AS VARCHAR) AS birth_place, athlete_nationality AS nationality,
  athlete_position AS position, CAST(NULL AS INT) AS jersey_number,
  CAST(team_id AS VARCHAR) AS team_id, {_AGE_GROUP.format(x='athlete_age')} AS age_group,
  {_dec(_BMI)} AS bmi
FROM players"""

ORACLE["dim_groups"] = W("t2_standings") + """
SELECT CAST(group_id AS VARCHAR) AS group_id, min(group_name) AS group_name,
  CAST(NULL AS VARCHAR) AS group_abbreviation
FROM t2_standings GROUP BY CAST(group_id AS VARCHAR)"""

ORACLE["dim_dates"] = W("t6_fact_player_stats") + """,
b AS (SELECT min(date_id) AS lo, max(date_id) AS hi FROM t6_fact_player_stats),
d AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_id FROM b),
e AS (SELECT date_id, CAST(year(date_id) - CASE WHEN month(date_id) < 7 THEN 1 ELSE 0 END AS INT) AS sy FROM d)
SELECT date_id, CAST(year(date_id) AS INT) AS year, CAST(month(date_id) AS INT) AS month,
  CAST(day(date_id) AS INT) AS day, CAST(quarter(date_id) AS INT) AS quarter,
  CAST(weekofyear(date_id) AS INT) AS week, CAST(dayofweek(date_id) + 1 AS INT) AS day_of_week,
  dayname(date_id) AS day_name, monthname(date_id) AS month_name,
  dayofweek(date_id) IN (0, 6) AS is_weekend,
  CONCAT(CAST(sy AS VARCHAR), '-', lpad(CAST((sy + 1) % 100 AS VARCHAR), 2, '0')) AS season
FROM e"""

ORACLE["fact_team_performance"] = TPS + f""",
f AS (
  SELECT CAST(team_id AS VARCHAR) AS team_id, CAST(group_id AS VARCHAR) AS group_id,
    DATE '2024-12-31' AS date_id, games_played, wins, losses, ties, points,
    {_dec('points_per_game')} AS points_per_game, goals_for, goals_against, goal_differential,
    group_rank, CAST(overall_rank AS INT) AS overall_rank,
    {_dec('win_percentage')} AS win_percentage, {_dec('goals_per_game')} AS goals_per_game,
    {_dec('goals_conceded_per_game')} AS goals_conceded_per_game,
    {_dec('performance_rating', 8, 2)} AS performance_rating
  FROM tps)
SELECT * FROM f"""

ORACLE["fact_player_stats"] = W("t6_fact_player_stats") + """,
f AS (
  SELECT CAST(player_id AS VARCHAR) AS player_id, CAST(team_id AS VARCHAR) AS team_id, date_id,
    games_played, goals, assists, CAST(NULL AS INT) AS yellow_cards, CAST(NULL AS INT) AS red_cards,
    CAST(NULL AS INT) AS minutes_played, CAST(NULL AS INT) AS shots, CAST(NULL AS INT) AS shots_on_target,
    CAST(NULL AS DECIMAL(5,2)) AS pass_completion_rate
  FROM t6_fact_player_stats)
SELECT * FROM f"""

ORACLE["fact_match_results"] = W("t4_matches") + """,
f AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(home_team_id AS VARCHAR) AS home_team_id,
    CAST(away_team_id AS VARCHAR) AS away_team_id, CAST(group_id AS VARCHAR) AS group_id,
    match_date, home_score, away_score, match_status, attendance, venue
  FROM t4_matches)
SELECT * FROM f"""

ORACLE["surrogate_key"] = """
SELECT o_orderkey, o_orderdate,
  CAST(ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_sk
FROM orders"""

ORACLE["upsert"] = """
WITH ex AS (
  SELECT l_suppkey AS team_id, count(*) AS games, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS quantity
  FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY l_suppkey),
inc AS (
  SELECT l_suppkey AS team_id, count(*) AS games, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS quantity
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY l_suppkey)
SELECT COALESCE(ex.team_id, inc.team_id) AS team_id,
  CASE WHEN inc.team_id IS NOT NULL THEN inc.games ELSE ex.games END AS games,
  CASE WHEN inc.team_id IS NOT NULL THEN inc.quantity ELSE ex.quantity END AS quantity,
  CASE WHEN ex.team_id IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-06-01 00:00:00' END AS created_at,
  CASE WHEN inc.team_id IS NOT NULL THEN TIMESTAMP '2024-06-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at
FROM ex FULL OUTER JOIN inc ON ex.team_id = inc.team_id"""

# the views read the newest of two stored snapshots of the fact
_FACT = ORACLE["fact_team_performance"].removesuffix("SELECT * FROM f")

ORACLE["v_team_performance"] = _FACT + """
SELECT s_name AS team_name, n_name AS group_name, games_played, wins, losses, ties, points, goal_differential,
  group_rank, overall_rank, win_percentage, performance_rating
FROM f JOIN supplier ON team_id = CAST(s_suppkey AS VARCHAR) JOIN nation ON group_id = CAST(n_nationkey AS VARCHAR)"""

ORACLE["v_group_standings"] = _FACT + """
SELECT n_name AS group_name, s_name AS team_name, points, games_played, wins, losses, ties, goals_for,
  goals_against, goal_differential, group_rank
FROM f JOIN supplier ON team_id = CAST(s_suppkey AS VARCHAR) JOIN nation ON group_id = CAST(n_nationkey AS VARCHAR)
ORDER BY group_name, group_rank, team_name"""

ORACLE["v_recent_matches"] = W("t4_matches") + """
SELECT event_id, match_date, h.n_name AS home_team, a.n_name AS away_team, home_score, away_score,
  match_status, r_name AS group_name, venue
FROM t4_matches JOIN nation h ON home_team_id = h.n_nationkey JOIN nation a ON away_team_id = a.n_nationkey
  JOIN region ON group_id = r_regionkey
ORDER BY match_date DESC, event_id, home_team, away_team, home_score, away_score, match_status,
  group_name, venue
LIMIT 20"""

ORACLE["top_scorers"] = W("t6_fact_player_stats") + """,
per AS (SELECT player_id, team_id, sum(goals) AS g, sum(assists) AS a, sum(games_played) AS n
        FROM t6_fact_player_stats GROUP BY player_id, team_id),
agg AS (
  SELECT c_name AS player_name, c_mktsegment AS position, n_name AS team_name,
    CAST(sum(g) AS BIGINT) AS total_goals, CAST(sum(a) AS BIGINT) AS total_assists,
    CAST(sum(n) AS BIGINT) AS total_games
  FROM per JOIN customer ON player_id = c_custkey JOIN nation ON team_id = n_nationkey
  GROUP BY c_name, c_mktsegment, n_name)
SELECT *, CASE WHEN total_games > 0
  THEN CAST(((200 * total_goals + total_games) // (2 * total_games)) * 0.01 AS DECIMAL(18,2))
  ELSE CAST(0 AS DECIMAL(18,2)) END AS goals_per_game
FROM agg ORDER BY total_goals DESC, total_assists DESC"""

ORACLE["data_quality_check"] = W("t3_athletes", "t5_fact_team_performance") + f""", {_PLAYERS}
SELECT 'Teams' AS table_name, count(*) AS record_count,
  count(*) FILTER (WHERE s_name IS NULL) AS null_names, count(*) FILTER (WHERE s_suppkey IS NULL) AS null_ids
FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL
SELECT 'Players', count(*), count(*) FILTER (WHERE athlete_full_name IS NULL),
  count(*) FILTER (WHERE athlete_id IS NULL) FROM players
UNION ALL
SELECT 'Team Performance', count(*), count(*) FILTER (WHERE points IS NULL),
  count(*) FILTER (WHERE team_id IS NULL) FROM t5_fact_team_performance"""

ORACLE["table_metrics"] = W("t5_fact_team_performance", "t6_fact_player_stats") + """
SELECT 'fact_team_performance' AS table_name, count(*) AS row_count,
  TIMESTAMP '2024-07-01 00:00:00' AS earliest_record, TIMESTAMP '2024-07-01 00:00:00' AS latest_record,
  count(DISTINCT team_id) AS unique_teams, count(DISTINCT date_id) AS unique_dates
FROM t5_fact_team_performance
UNION ALL
SELECT 'fact_player_stats', count(*), TIMESTAMP '2024-07-01 00:00:00', TIMESTAMP '2024-07-01 00:00:00',
  count(DISTINCT player_id), count(DISTINCT date_id)
FROM t6_fact_player_stats"""

ORACLE["fk_violations"] = W("t3_athletes", "t6_fact_player_stats") + f""", {_PLAYERS}
SELECT * FROM t6_fact_player_stats f
WHERE player_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM players p WHERE p.athlete_id = f.player_id)"""

ORACLE["fk_conform"] = W("t3_athletes", "t6_fact_player_stats") + f""", {_PLAYERS}
SELECT * FROM t6_fact_player_stats f
WHERE EXISTS (SELECT 1 FROM players p WHERE p.athlete_id = f.player_id)"""


# --------------------------------------------------------- dashboards ---

ORACLE["kpi_cards"] = W("t2_standings") + """
SELECT count(DISTINCT team_name) AS total_teams, count(DISTINCT group_name) AS total_groups,
  CAST(sum(CAST(goalsFor AS INT)) AS BIGINT) AS total_goals,
  CASE WHEN sum(CAST(gamesPlayed AS INT)) > 0
    THEN CAST(sum(CAST(goalsFor AS INT)) AS BIGINT) / CAST(sum(CAST(gamesPlayed AS INT)) AS BIGINT)
    ELSE 0 END AS avg_goals_per_game
FROM t2_standings"""

ORACLE["goals_distribution"] = W("t2_standings") + """
SELECT team_id, team_name, CAST(sum(CAST(goalsFor AS INT)) AS BIGINT) AS goals_for
FROM t2_standings GROUP BY team_id, team_name ORDER BY goals_for DESC, team_id"""

ORACLE["performance_trend"] = W("t5_fact_team_performance") + """
SELECT date_id, team_id, CAST(sum(points) AS BIGINT) AS points,
  CAST(sum(games_played) AS BIGINT) AS games_played
FROM t5_fact_team_performance GROUP BY date_id, team_id"""

ORACLE["age_distribution"] = W("t3_athletes") + f""", {_PLAYERS}
SELECT {_AGE_GROUP.format(x='athlete_age')} AS age_group, athlete_position AS position,
  count(*) AS players
FROM players GROUP BY 1, 2"""

ORACLE["team_composition"] = W("t3_athletes") + f""", {_PLAYERS}
SELECT CAST(team_id AS VARCHAR) AS team_id, athlete_position AS position, count(*) AS players
FROM players GROUP BY 1, 2"""

ORACLE["venue_analysis"] = W("t4_matches") + """
SELECT venue, count(*) AS matches, avg(attendance) AS avg_attendance FROM t4_matches GROUP BY venue"""

ORACLE["score_distribution"] = W("t4_matches") + f"""
SELECT home_score, away_score, {_OUTCOME} AS outcome, count(*) AS matches
FROM t4_matches GROUP BY 1, 2, 3"""

ORACLE["fixture_calendar"] = W("t4_matches") + """
SELECT match_date, count(*) FILTER (WHERE home_score > away_score) AS win,
  count(*) FILTER (WHERE home_score = away_score) AS draw,
  count(*) FILTER (WHERE home_score < away_score) AS loss
FROM t4_matches GROUP BY match_date"""

ORACLE["head_to_head"] = W("t4_matches") + """
SELECT home_team_id, away_team_id, count(*) AS matches,
  count(*) FILTER (WHERE home_score > away_score) AS home_wins,
  count(*) FILTER (WHERE home_score = away_score) AS draws,
  count(*) FILTER (WHERE home_score < away_score) AS away_wins
FROM t4_matches GROUP BY home_team_id, away_team_id"""

ORACLE["team_form"] = W("t4_matches") + """,
r AS (
  SELECT event_id, match_date, home_team_id AS team_id, away_team_id AS opponent_id,
    home_score AS goals_for, away_score AS goals_against FROM t4_matches
  UNION ALL
  SELECT event_id, match_date, away_team_id, home_team_id, away_score, home_score FROM t4_matches),
ranked AS (
  SELECT *, CASE WHEN goals_for > goals_against THEN 'W' WHEN goals_for = goals_against THEN 'D' ELSE 'L' END AS result,
    ROW_NUMBER() OVER (PARTITION BY team_id ORDER BY match_date DESC, event_id DESC, opponent_id DESC,
                       goals_for DESC, goals_against DESC) AS rn
  FROM r)
SELECT team_id, string_agg(result, '' ORDER BY rn DESC) AS form, count(*) AS games
FROM ranked WHERE rn <= 5 GROUP BY team_id"""

ORACLE["team_vs_average"] = TPS + """,
a AS (SELECT round(avg(win_percentage), 6) AS aw, round(avg(goals_per_game), 6) AS ag,
             round(avg(goals_conceded_per_game), 6) AS ac, round(avg(points_per_game), 6) AS ap FROM tps)
SELECT team_id, win_percentage, aw AS avg_win_percentage, win_percentage - aw AS diff_win_percentage,
  goals_per_game, ag AS avg_goals_per_game, goals_per_game - ag AS diff_goals_per_game,
  goals_conceded_per_game, ac AS avg_goals_conceded_per_game,
  goals_conceded_per_game - ac AS diff_goals_conceded_per_game,
  points_per_game, ap AS avg_points_per_game, points_per_game - ap AS diff_points_per_game
FROM tps, a"""

ORACLE["top_performers"] = W("t6_fact_player_stats") + """
SELECT player_id, CAST(sum(goals) AS BIGINT) AS total_goals
FROM t6_fact_player_stats GROUP BY player_id ORDER BY total_goals DESC, player_id LIMIT 10"""

ORACLE["param_filters"] = W("t4_matches") + """,
s AS (SELECT *, CAST(year(match_date) - CASE WHEN month(match_date) < 7 THEN 1 ELSE 0 END AS INT) AS sy
      FROM t4_matches)
SELECT event_id, home_team_id, away_team_id, group_id, match_date, home_score, away_score,
  match_status, attendance, venue,
  CONCAT(CAST(sy AS VARCHAR), '-', lpad(CAST((sy + 1) % 100 AS VARCHAR), 2, '0')) AS season
FROM s WHERE sy = 1996 AND match_status IN ('F', 'O') AND group_id IN (0, 1, 3)
  AND home_team_id IN (0, 1, 2, 3, 5, 8, 13, 21)"""

ORACLE["last_n_days"] = W("t4_matches") + """
SELECT * FROM t4_matches
WHERE match_date >= (SELECT max(match_date) FROM t4_matches) - INTERVAL 30 DAY
  AND match_date <= (SELECT max(match_date) FROM t4_matches)"""


# ------------------------------------------------------------ quality ---

def _q(s: str) -> str:
    return s.replace("'", "''")


def _dq(suite: str, etype: str, col: str | None, success: str, observed: str,
        unexpected: str, elements: str, details: str, src: str) -> str:
    c = "CAST(NULL AS VARCHAR)" if col is None else f"'{col}'"
    return (f"SELECT '{suite}' AS suite, '{etype}' AS expectation_type, {c} AS \"column\", "
            f"CAST({success} AS BOOLEAN) AS success, CAST({observed} AS DOUBLE) AS observed, "
            f"CAST({unexpected} AS BIGINT) AS unexpected_count, CAST({elements} AS BIGINT) AS element_count, "
            f"'{_q(details)}' AS details FROM ({src}) AS q")


def _row_count(suite: str, table: str, lo: int, hi: int) -> str:
    return _dq(suite, "expect_table_row_count_to_be_between", None, f"n >= {lo} AND n <= {hi}",
               "n", "NULL", "n", f"min_value={lo},max_value={hi}", f"SELECT count(*) AS n FROM {table}")


def _not_null(suite: str, table: str, col: str) -> str:
    return _dq(suite, "expect_column_values_to_not_be_null", col, "bad = 0",
               "CASE WHEN n > 0 THEN bad / n END", "bad", "n", "",
               f"SELECT count(*) AS n, count(*) FILTER (WHERE {col} IS NULL) AS bad FROM {table}")


def _completeness(suite: str, table: str, col: str, thr: float = 0.95) -> str:
    return _dq(suite, "expect_column_values_completeness_at_least", col,
               f"COALESCE(CASE WHEN n > 0 THEN k / n END >= {thr}, FALSE)",
               "CASE WHEN n > 0 THEN k / n END", "n - k", "n", f"threshold={thr}",
               f"SELECT count(*) AS n, count({col}) AS k FROM {table}")


def _in_range(suite: str, table: str, col: str, lo, hi) -> str:
    return _dq(suite, "expect_column_values_to_be_between", col, "bad = 0",
               "CASE WHEN k > 0 THEN bad / k END", "bad", "n", f"min_value={lo},max_value={hi}",
               f"SELECT count(*) AS n, count({col}) AS k, count(*) FILTER (WHERE {col} IS NOT NULL "
               f"AND ({col} < {lo} OR {col} > {hi})) AS bad FROM {table}")


def _bad_rows(suite: str, table: str, col: str, etype: str, bad_cond: str, details: str) -> str:
    return _dq(suite, etype, col, "bad = 0", "CASE WHEN k > 0 THEN bad / k END", "bad", "n", details,
               f"SELECT count(*) AS n, count({col}) AS k, count(*) FILTER (WHERE {col} IS NOT NULL "
               f"AND ({bad_cond})) AS bad FROM {table}")


def _unique(suite: str, table: str, cols: str) -> str:
    return _dq(suite, "expect_compound_columns_to_be_unique", cols, "dup = 0",
               "CASE WHEN n > 0 THEN dup / n END", "dup", "n", "",
               f"SELECT (SELECT count(*) FROM {table}) AS n, (SELECT COALESCE(sum(c), 0) FROM "
               f"(SELECT count(*) AS c FROM {table} GROUP BY {cols} HAVING count(*) > 1)) AS dup")


def _exists(suite: str, col: str, ok: bool) -> str:
    return _dq(suite, "expect_column_to_exist", col, "TRUE" if ok else "FALSE", "NULL", "NULL",
               "NULL", "", "SELECT 1")


_UNION = "\nUNION ALL\n"

ORACLE["dq_row_count"] = W("t2_standings", "t3_athletes") + _UNION.join([
    _row_count("standings", "t2_standings", 1, 100),
    _row_count("teams", "supplier", 1, 50),
    _row_count("athletes", "t3_athletes", 1, 1000)])

ORACLE["dq_not_null"] = W("t3_athletes") + _UNION.join(
    _not_null("athletes", "t3_athletes", c)
    for c in ("athlete_id", "athlete_age", "athlete_nationality"))

ORACLE["dq_suite"] = W("t3_athletes") + _UNION.join([
    _row_count("athletes", "t3_athletes", 1, 1000),
    _exists("athletes", "athlete_id", True),
    _exists("athletes", "athlete_team.id", True),
    _exists("athletes", "data.id", False),
    _not_null("athletes", "t3_athletes", "athlete_id"),
    _completeness("athletes", "t3_athletes", "athlete_age"),
    _in_range("athletes", "t3_athletes", "athlete_age", 18, 38),
    _unique("athletes", "t3_athletes", "athlete_id")])

ORACLE["dq_completeness"] = W("t3_athletes") + _UNION.join(
    _completeness("athletes", "t3_athletes", c)
    for c in ("athlete_age", "athlete_weight", "athlete_height", "athlete_nationality", "team_id"))

ORACLE["dq_uniqueness"] = W("t6_fact_player_stats") + _UNION.join([
    _unique("orders", "orders", "o_orderkey"),
    _unique("player_stats", "t6_fact_player_stats", "player_id,date_id"),
    _unique("lineitem", "lineitem", "l_orderkey,l_linenumber")])

ORACLE["dq_range"] = W("t4_matches") + _UNION.join([
    _in_range("matches", "t4_matches", "home_score", 0, 5),
    _in_range("matches", "t4_matches", "away_score", 0, 3),
    _in_range("matches", "t4_matches", "attendance", 1, 999)])

ORACLE["dq_format"] = W("t4_matches") + """,
ev AS (SELECT strftime(CAST(match_date AS TIMESTAMP), '%Y-%m-%dT%H:%MZ') AS event_date FROM t4_matches)
""" + _UNION.join([
    _bad_rows("events", "ev", "event_date", "expect_column_values_to_match_format",
              "try_strptime(event_date, '%Y-%m-%dT%H:%MZ') IS NULL",
              "format=yyyy-MM-dd'T'HH:mm'Z'"),
    _bad_rows("event_log", "events", "props", "expect_column_values_to_match_regex",
              """NOT regexp_matches(props, '^\\{"k": [0-9]+\\}$')""", 'regex=^\\{"k": [0-9]+\\}$'),
    _bad_rows("event_log", "events", "event_type", "expect_column_values_to_match_regex",
              "NOT regexp_matches(event_type, '^[a-z]+$')", "regex=^[a-z]+$")])


def _ddl(table: str, src: str, checks: list[tuple[str, str, str]]) -> str:
    return _UNION.join(
        f"SELECT '{table}' AS table_name, '{c}' AS \"column\", '{rule}' AS rule, "
        f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS violations, "
        f"CAST(count(*) AS BIGINT) AS element_count FROM {src}"
        for c, rule, cond in checks)


def _over(c: str, p: int, s: int) -> str:
    return f"{c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS DECIMAL({p},{s})) IS NULL"


ORACLE["dq_ddl_contract"] = W("t2_standings", "t3_athletes") + TPS_BODY + f""", {_PLAYERS},
pa AS (SELECT CAST(athlete_id AS VARCHAR) AS player_id, athlete_full_name AS player_name,
         athlete_weight AS weight_kg, athlete_height AS height_cm, athlete_nationality AS nationality,
         athlete_position AS position, CAST(team_id AS VARCHAR) AS team_id,
         {_AGE_GROUP.format(x='athlete_age')} AS age_group, {_BMI} AS bmi FROM players),
fa AS (SELECT CAST(team_id AS VARCHAR) AS team_id, CAST(group_id AS VARCHAR) AS group_id, * EXCLUDE (team_id, group_id)
       FROM tps)
""" + _ddl("dim_players", "pa", [
    ("player_id", "not_null", "player_id IS NULL"),
    ("player_name", "not_null", "player_name IS NULL"),
    ("player_id", "varchar(20)", "length(player_id) > 20"),
    ("player_name", "varchar(100)", "length(player_name) > 100"),
    ("nationality", "varchar(50)", "length(nationality) > 50"),
    ("position", "varchar(50)", "length(position) > 50"),
    ("team_id", "varchar(20)", "length(team_id) > 20"),
    ("age_group", "varchar(20)", "length(age_group) > 20"),
    ("weight_kg", "decimal(5,2)", _over("weight_kg", 5, 2)),
    ("height_cm", "decimal(5,2)", _over("height_cm", 5, 2)),
    ("bmi", "decimal(5,2)", _over("bmi", 5, 2))]) + _UNION + _ddl("fact_team_performance", "fa", [
    ("team_id", "not_null", "team_id IS NULL"),
    ("group_id", "not_null", "group_id IS NULL"),
    ("team_id", "varchar(20)", "length(team_id) > 20"),
    ("group_id", "varchar(20)", "length(group_id) > 20"),
    ("points_per_game", "decimal(5,2)", _over("points_per_game", 5, 2)),
    ("win_percentage", "decimal(5,2)", _over("win_percentage", 5, 2)),
    ("goals_per_game", "decimal(5,2)", _over("goals_per_game", 5, 2)),
    ("goals_conceded_per_game", "decimal(5,2)", _over("goals_conceded_per_game", 5, 2)),
    ("performance_rating", "decimal(8,2)", _over("performance_rating", 8, 2))])


# --------------------------------------------------------- monitoring ---

ORACLE["error_logs"] = W("t7_logs") + """
SELECT * FROM t7_logs WHERE message LIKE '%ERROR%' ORDER BY ts DESC, event_id LIMIT 100"""

ORACLE["perf_logs"] = W("t7_logs") + """
SELECT * FROM t7_logs WHERE message LIKE '%duration%' OR message LIKE '%processing time%'
ORDER BY ts DESC, event_id LIMIT 100"""

_BUCKET = "time_bucket(INTERVAL '300 seconds', {x}, TIMESTAMP '1970-01-01')"
_WIN = W("t8_metrics") + f""",
w AS (SELECT {_BUCKET.format(x='ts')} AS window_start, metric_name,
        CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sum_value, count(value) AS samples
      FROM t8_metrics GROUP BY 1, 2)
"""

ORACLE["metric_windows"] = _WIN + """
SELECT window_start, window_start + INTERVAL '300 seconds' AS window_end, metric_name, sum_value,
  samples, sum_value / samples AS avg_value
FROM w"""

ORACLE["alarm_missing_window"] = _WIN + f""",
b AS (SELECT unnest(['click', 'error', 'heartbeat', 'purchase', 'signup', 'view']) AS metric_name),
sp AS (SELECT metric_name, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:55:00',
         INTERVAL '300 seconds')) AS window_start FROM b)
SELECT sp.metric_name, sp.window_start, COALESCE(w.sum_value, 0.0) AS sum_value,
  CAST(COALESCE(w.samples, 0) AS BIGINT) AS samples, w.samples IS NULL AS missing,
  w.samples IS NULL OR w.sum_value < 1.0 AS breaching
FROM sp LEFT JOIN w ON sp.metric_name = w.metric_name AND sp.window_start = w.window_start"""

ORACLE["alarm_consecutive"] = _WIN + """,
x AS (SELECT metric_name, window_start, sum_value / samples AS avg_value,
        sum_value / samples > 80.0 AS breaching,
        LAG(window_start) OVER (PARTITION BY metric_name ORDER BY window_start) AS ps,
        LAG(sum_value / samples > 80.0) OVER (PARTITION BY metric_name ORDER BY window_start) AS pb
      FROM w)
SELECT metric_name, window_start, avg_value, breaching,
  breaching AND COALESCE(ps = window_start - INTERVAL '300 seconds' AND pb, FALSE) AS alarm
FROM x"""


# ------------------------------------------------------------- silver ---

_LONG = W("t1_standings_long") + """
SELECT '2024-07-01T00:00:00' AS ingestion_timestamp, 'api' AS source,
  CAST(group_id AS VARCHAR) AS group_id, group_name, CAST(NULL AS VARCHAR) AS group_abbreviation,
  CAST(team_id AS VARCHAR) AS team_id, team_name, CAST(NULL AS VARCHAR) AS team_abbreviation,
  stat_name, stat_value
FROM t1_standings_long"""

ORACLE["nested_explode"] = _LONG
ORACLE["nested_roundtrip"] = _LONG

ORACLE["silver_standings"] = W("t2_standings") + """
SELECT '2024-07-01T00:00:00' AS ingestion_timestamp, 'api' AS source,
  CAST(group_id AS VARCHAR) AS group_id, group_name, CAST(NULL AS VARCHAR) AS group_abbreviation,
  CAST(team_id AS VARCHAR) AS team_id, team_name, CAST(NULL AS VARCHAR) AS team_abbreviation,
  gamesPlayed, wins, losses, ties, points, pointsPerGame, goalsFor, goalsAgainst, goalDifferential,
  rank, '2024-07-01T00:00:00' AS transformation_timestamp, 'silver' AS data_layer
FROM t2_standings"""

ORACLE["project_rename"] = """
SELECT '2024-07-01T00:00:00' AS ingestion_timestamp, 'api' AS source,
  CAST(s_suppkey AS VARCHAR) AS team_id, CONCAT('s:', CAST(s_suppkey AS VARCHAR)) AS team_uid,
  lower(s_name) AS team_slug, n_name AS team_location, s_name AS team_name,
  CAST(NULL AS VARCHAR) AS team_abbreviation, s_name AS team_display_name,
  s_name AS team_short_display_name, CAST(NULL AS VARCHAR) AS team_color,
  CAST(NULL AS VARCHAR) AS team_alternate_color, s_acctbal >= 0 AS team_is_active,
  '2024-07-01T00:00:00' AS transformation_timestamp, 'silver' AS data_layer
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

ORACLE["flatten_struct"] = W("t3_athletes") + """
SELECT athlete_id, athlete_full_name, athlete_age, athlete_weight, athlete_height,
  athlete_nationality, athlete_position,
  CAST(team_id AS VARCHAR) AS athlete_team_id,
  CASE WHEN team_id IS NOT NULL THEN team_name END AS athlete_team_name,
  CAST(NULL AS VARCHAR) AS athlete_team_abbreviation
FROM t3_athletes"""


# ------------------------------------------------------ sources/sinks ---

ORACLE["scan_parquet"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01'"""

ORACLE["union_by_name"] = """
SELECT o_orderkey, o_custkey, o_totalprice, CAST(NULL AS TIMESTAMP) AS o_orderdate FROM orders
WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, CAST(NULL AS DOUBLE), o_orderdate FROM orders WHERE o_orderstatus <> 'F'"""

ORACLE["export_metadata"] = W("t2_standings") + """
SELECT 'standings' AS dataset_name, '2024-07-01T00:00:00' AS export_timestamp,
  count(*) AS record_count,
  string_split('group_id,group_name,team_id,team_name,gamesPlayed,wins,losses,ties,points,pointsPerGame,goalsFor,goalsAgainst,goalDifferential,rank', ',') AS columns
FROM t2_standings"""

ORACLE["global_row_number"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
  CAST(ROW_NUMBER() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS BIGINT) AS rn
FROM lineitem"""


_NATIONS = range(25)  # TPC-H fixes the nation dimension at 25 rows
ORACLE["head_to_head_matrix"] = W("t4_matches") + """,
p AS (SELECT home_team_id, away_team_id,
        CASE WHEN home_score > away_score THEN 1 WHEN home_score < away_score THEN -1 ELSE 0 END AS pts
      FROM t4_matches)
SELECT home_team_id, """ + ", ".join(
    f"CAST(sum(pts) FILTER (WHERE away_team_id = {k}) AS BIGINT) AS away_{k}" for k in _NATIONS) + """
FROM p GROUP BY home_team_id"""

ORACLE["dq_summary"] = "WITH r AS (" + ORACLE["dq_suite"] + """)
SELECT suite, bool_and(COALESCE(success, FALSE)) AS success, count(*) AS evaluated_expectations,
  count(*) FILTER (WHERE success) AS successful_expectations,
  count(*) FILTER (WHERE NOT COALESCE(success, FALSE)) AS unsuccessful_expectations,
  count(*) FILTER (WHERE success) * 100.0 / count(*) AS success_percent
FROM r GROUP BY suite"""

ORACLE["dq_validate"] = W("t2_standings") + _UNION.join([
    _row_count("standings", "t2_standings", 1, 100),
    _exists("standings", "group_id", True),
    _exists("standings", "group_name", True),
    _not_null("standings", "t2_standings", "group_id")])


ORACLE["stream_metric_windows"] = _WIN + """
SELECT window_start, window_start + INTERVAL '300 seconds' AS window_end, metric_name, sum_value,
  samples, sum_value / samples AS avg_value
FROM w"""

ORACLE["bronze_files"] = f"SELECT s.*, '2024' AS season FROM ({ORACLE['silver_standings']}) s"
ORACLE["stream_silver_standings"] = ORACLE["bronze_files"]

ORACLE["flatten_events"] = ORACLE["fact_match_results"]

# every table of the warehouse carries the audit columns
for _t in ("dim_teams", "dim_players", "dim_groups", "dim_dates", "fact_team_performance", "fact_player_stats",
           "fact_match_results"):
    ORACLE[_t] = f"""
SELECT t.*, TIMESTAMP '2024-07-01 00:00:00' AS created_at, TIMESTAMP '2024-07-01 00:00:00' AS updated_at
FROM ({ORACLE[_t]}) t"""

# ------------------------------------------- snapshots, seasons, loads ---

# two snapshots of each player, of which the newer one is the plain table
ORACLE["roster_latest_snapshot"] = ORACLE["team_roster_summary"]
ORACLE["dim_players_snapshots"] = ORACLE["dim_players"]

ORACLE["standings_two_seasons"] = W("t2_standings") + """
SELECT '2024-25' AS season, team_id, CAST(points AS INT) AS points, CAST(gamesPlayed AS INT) AS games_played FROM t2_standings
UNION ALL SELECT '2023-24', team_id, CAST(points + 1 AS INT), CAST(gamesPlayed AS INT) FROM t2_standings"""

ORACLE["two_loads"] = """
SELECT count(*) AS n_rows, count(*) AS n_keys, CAST(0 AS BIGINT) AS n_created_later,
  count(CASE WHEN c_custkey % 2 = 0 THEN 1 END) AS n_updated, CAST(sum(c_custkey % 7) AS BIGINT) AS kept_extra
FROM customer"""

ORACLE["unknown_stats"] = W("t2_standings") + """
SELECT CAST(team_id AS VARCHAR) AS team_id, points, 'deductions' AS stat_name, CAST(team_id % 3 AS DOUBLE) AS stat_value
FROM t2_standings"""

ORACLE["corrupt_documents"] = W("t1_base") + """
SELECT count(*) AS documents, count(CASE WHEN team_id % 10 = 0 THEN 1 END) AS corrupt FROM t1_base"""

ORACLE["flatten_athletes"] = W("t3_athletes") + """
SELECT '2024-07-01T00:00:00' AS ingestion_timestamp, CAST(athlete_id AS VARCHAR) AS athlete_id, athlete_full_name,
  athlete_age AS age, athlete_nationality AS country, CAST(team_id AS VARCHAR) AS team_id, team_name FROM t3_athletes"""

ORACLE["cast_decimal_text"] = """
SELECT p_partkey, CAST(p_size AS INT) AS size_int, CAST(NULL AS INT) AS too_large, CAST(NULL AS DATE) AS bad_date
FROM part"""

# ------------------------------------------------- seasons, table loads ---

_SEASONS = W("t2_standings") + """,
ss AS (SELECT *, '2024-25' AS season FROM t2_standings
  UNION ALL SELECT * REPLACE (points + team_id % 5 AS points), '2023-24' AS season FROM t2_standings WHERE team_id % 3 <> 0)"""
_PLAYER_SEASONS = W("t3_athletes") + """,
ps AS (SELECT *, '2024-25' AS season, CASE WHEN team_id IS NOT NULL THEN CAST(team_id AS VARCHAR) END AS team FROM t3_athletes
  UNION ALL SELECT * REPLACE (athlete_age - 1 AS athlete_age), '2023-24' AS season,
    CASE WHEN team_id IS NOT NULL THEN '0' END AS team FROM t3_athletes WHERE athlete_id % 4 <> 0)"""

ORACLE["gold_two_seasons"] = _SEASONS + """,
g AS (
  SELECT season, group_id, group_name, count(*) AS teams_in_group,
    CAST(sum(CAST(gamesPlayed AS INT)) AS BIGINT) AS total_games_played,
    CAST(sum(CAST(goalsFor AS INT)) AS BIGINT) AS total_goals_scored,
    avg(CAST(points AS INT)) AS avg_points_per_team,
    max(CAST(points AS INT)) AS group_leader_points, min(CAST(points AS INT)) AS group_lowest_points,
    avg(CAST(goalDifferential AS INT)) AS avg_goal_differential,
    max(CAST(goalDifferential AS INT)) AS best_goal_differential,
    min(CAST(goalDifferential AS INT)) AS worst_goal_differential
  FROM ss GROUP BY season, group_id, group_name),
s AS (
  SELECT *, group_leader_points - group_lowest_points AS points_spread,
    CASE WHEN group_leader_points - group_lowest_points > 0
         THEN 100 / (group_leader_points - group_lowest_points) ELSE 100.0 END AS competitiveness_score,
    CASE WHEN total_games_played > 0 THEN total_goals_scored / total_games_played ELSE 0 END AS goals_per_game
  FROM g)
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY season ORDER BY competitiveness_score DESC, group_id) AS BIGINT) AS competitiveness_rank
FROM s"""

ORACLE["gold_two_seasons_overview"] = _SEASONS + """
SELECT count(DISTINCT team_id) AS total_teams, count(DISTINCT group_id) AS total_groups,
  CAST(sum(CAST(gamesPlayed AS INT)) AS BIGINT) AS total_games_played,
  CAST(sum(CAST(goalsFor AS INT)) AS BIGINT) AS total_goals_scored, avg(CAST(goalsFor AS INT)) AS avg_goals_per_team,
  max(CAST(points AS INT)) AS max_points, min(CAST(points AS INT)) AS min_points,
  CAST(sum(CAST(goalsFor AS INT)) AS BIGINT) / CAST(sum(CAST(gamesPlayed AS INT)) AS BIGINT) AS goals_per_game,
  'Competition' AS competition_name, season
FROM ss GROUP BY season"""

ORACLE["gold_two_seasons_ranks"] = _SEASONS + """
SELECT season, group_id, team_id, CAST(points AS INT) AS points,
  CAST(ROW_NUMBER() OVER (PARTITION BY season ORDER BY CAST(points AS INT) DESC, CAST(goalDifferential AS INT) DESC, team_id) AS BIGINT) AS overall_rank
FROM ss"""

ORACLE["gold_two_seasons_rosters"] = _PLAYER_SEASONS + """
SELECT season, team AS team_id, team_name, CAST(NULL AS VARCHAR) AS team_abbreviation,
  count(*) AS total_players, avg(athlete_age) AS avg_age, min(athlete_age) AS min_age,
  max(athlete_age) AS max_age, avg(athlete_weight) AS avg_weight, avg(athlete_height) AS avg_height,
  array_to_string(list_sort(list_distinct(list(athlete_nationality))), ',') AS nationalities,
  array_to_string(list_sort(list_distinct(list(athlete_position))), ',') AS positions,
  CAST(len(list_distinct(list(athlete_nationality))) AS INT) AS nationality_count,
  CAST(len(list_distinct(list(athlete_position))) AS INT) AS position_count,
  max(athlete_age) - min(athlete_age) AS age_diversity
FROM ps WHERE team IS NOT NULL GROUP BY season, team, team_name"""

ORACLE["gold_two_seasons_players"] = _PLAYER_SEASONS + f""",
p AS (SELECT season, team, athlete_position AS position, {_AGE_GROUP.format(x='athlete_age')} AS age_group
      FROM ps WHERE athlete_full_name IS NOT NULL AND athlete_age IS NOT NULL)
SELECT season, 'age' AS "by", age_group AS name, position, count(*) AS players FROM p GROUP BY season, age_group, position
UNION ALL SELECT season, 'team', team, position, count(*) FROM p GROUP BY season, team, position"""

ORACLE["warehouse_two_seasons"] = W("t2_standings", "t3_athletes", "t4_matches", "t6_fact_player_stats") + """,
days AS (SELECT min(d) AS lo, max(d) AS hi FROM (
  SELECT DATE '2024-06-30' AS d UNION ALL SELECT DATE '2024-12-31'
  UNION ALL SELECT match_date FROM (SELECT event_id, min(match_date) AS match_date FROM t4_matches GROUP BY event_id)
  UNION ALL SELECT max(match_date) FROM t4_matches GROUP BY event_id
  UNION ALL SELECT date_id FROM t6_fact_player_stats)),
n AS (
  SELECT 'dim_teams' AS table_name, count(*) AS n, FALSE AS has_id FROM supplier
  UNION ALL SELECT 'dim_players', count(*), FALSE FROM t3_athletes WHERE athlete_full_name IS NOT NULL AND athlete_age IS NOT NULL
  UNION ALL SELECT 'dim_groups', count(DISTINCT group_id), FALSE FROM t2_standings
  UNION ALL SELECT 'dim_dates', date_diff('day', lo, hi) + 1, FALSE FROM days
  UNION ALL SELECT 'fact_team_performance', count(*) + count(*) FILTER (WHERE team_id % 3 <> 0), TRUE FROM t2_standings
  UNION ALL SELECT 'fact_player_stats', count(*), TRUE FROM (SELECT DISTINCT player_id, team_id, date_id FROM t6_fact_player_stats)
  UNION ALL SELECT 'fact_match_results', 2 * count(DISTINCT event_id), TRUE FROM t4_matches)
SELECT table_name, n AS n_rows, n AS n_keys, CASE WHEN has_id THEN n END AS n_identities, n AS n_kept FROM n"""

ORACLE["warehouse_season_dates"] = W("t2_standings") + """
SELECT DATE '2024-12-31' AS date_id, count(*) AS n_rows, count(*) AS n_keys FROM t2_standings
UNION ALL SELECT DATE '2024-06-30', count(*), count(*) FROM t2_standings WHERE team_id % 3 <> 0"""

ORACLE["two_competitions"] = W("t4_matches") + """
SELECT DISTINCT CAST(event_id AS VARCHAR) AS event_id, CAST(2 AS BIGINT) AS matches, CAST(2 AS BIGINT) AS ids, 'second' AS last_group
FROM t4_matches"""

ORACLE["unfinished_version"] = """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE c_name END AS c_name,
  TIMESTAMP '2024-07-01 00:00:00' AS created_at,
  CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2024-08-01 00:00:00' ELSE TIMESTAMP '2024-07-01 00:00:00' END AS updated_at
FROM customer"""

ORACLE["identity_reload"] = """
SELECT count(*) AS n_rows, count(*) AS n_keys,
  count(*) FILTER (WHERE c_custkey % 3 = 0) + 2 * count(*) FILTER (WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0) AS n_kept
FROM customer"""

ORACLE["alarm_episodes"] = _WIN + """,
sp AS (SELECT metric_name, unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:55:00', INTERVAL '300 seconds')) AS window_start
       FROM (SELECT unnest(['click', 'error', 'heartbeat', 'view']) AS metric_name)),
v AS (SELECT sp.metric_name, sp.window_start, sum_value / samples AS value, sum_value / samples > 60.0 AS breaching
      FROM sp LEFT JOIN w ON sp.metric_name = w.metric_name AND sp.window_start = w.window_start),
st AS (SELECT metric_name, window_start, value,
         CASE WHEN count(*) FILTER (WHERE breaching) OVER l >= 2 THEN 'ALARM' WHEN count(breaching) OVER l = 0 THEN 'INSUFFICIENT_DATA' ELSE 'OK' END AS state
       FROM v WINDOW l AS (PARTITION BY metric_name ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
i AS (SELECT *, row_number() OVER (PARTITION BY metric_name ORDER BY window_start)
         - row_number() OVER (PARTITION BY metric_name, state ORDER BY window_start) AS island FROM st)
SELECT metric_name, state, min(window_start) AS started, max(window_start) + INTERVAL '300 seconds' AS ended,
  count(*) AS periods, max(value) AS worst_value
FROM i GROUP BY metric_name, state, island"""

# ------------------------------------------------------ partial states ---

_REBUILT = W("t2_standings") + """,
ss AS (SELECT * REPLACE (points + CASE WHEN team_id % 3 = 0 THEN 7 ELSE 0 END AS points), '2024' AS season FROM t2_standings
  UNION ALL SELECT * REPLACE (points + CASE WHEN team_id % 2 = 1 THEN team_id % 4 ELSE 0 END AS points), '2023' AS season FROM t2_standings)"""
ORACLE["incremental_gold"] = ORACLE["gold_two_seasons"].replace(_SEASONS, _REBUILT).replace(
    "SELECT season, group_id, group_name, count(*)", "SELECT season, CAST(group_id AS VARCHAR) AS group_id, group_name, count(*)")
ORACLE["incremental_overview"] = ORACLE["gold_two_seasons_overview"].replace(_SEASONS, _REBUILT)

# ---------------------------------------------- sketches, open payloads ---

ORACLE["distinct_sketches"] = """
SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(quarter(l_shipdate) AS INT) AS quarter,
  count(*) AS row_count, count(DISTINCT l_suppkey) AS unique_l_suppkey
FROM lineitem GROUP BY 1, 2"""

ORACLE["table_metrics_sketched"] = W("t6_fact_player_stats") + """
SELECT count(*) AS row_count, count(DISTINCT player_id) AS unique_player_id, count(DISTINCT date_id) AS unique_dates
FROM t6_fact_player_stats"""

_ATHLETE_CONTRACT = ("id", "uid", "guid", "firstName", "lastName", "fullName", "displayName", "shortName", "weight", "height", "age",
                     "dateOfBirth", "birthPlace", "nationality", "position", "team", "jersey")
ORACLE["payload_drift"] = W("t3_athletes") + """,
seen AS (
  SELECT 'id' AS field, count(*) AS n, 'STRING' AS type FROM t3_athletes
  UNION ALL SELECT 'fullName', count(athlete_full_name), 'STRING' FROM t3_athletes
  UNION ALL SELECT 'age', count(athlete_age), 'BIGINT' FROM t3_athletes
  UNION ALL SELECT 'nickname', count(*), 'STRING' FROM t3_athletes WHERE athlete_id % 5 = 0
  UNION ALL SELECT 'contract', count(*), 'OBJECT<until: BIGINT>' FROM t3_athletes WHERE athlete_id % 7 = 0
  UNION ALL SELECT 'birthPlace', count(*), 'OBJECT<country: STRING>' FROM t3_athletes WHERE athlete_id % 2 = 0),
known AS (SELECT unnest([""" + ", ".join(f"'{c}'" for c in _ATHLETE_CONTRACT) + """]) AS field)
SELECT 'athletes' AS entity, COALESCE(seen.field, known.field) AS field, known.field IS NOT NULL AS in_contract,
  COALESCE(n, 0) AS occurrences, CAST(0 AS BIGINT) AS nulls, type
FROM seen FULL OUTER JOIN known ON seen.field = known.field"""

ORACLE["payload_variant"] = W("t3_athletes") + """
SELECT athlete_id, CASE WHEN athlete_id % 5 = 0 THEN 'nick' END AS nickname,
  CASE WHEN athlete_id % 7 = 0 THEN CAST(athlete_id % 4 + 2025 AS INT) END AS until,
  CASE WHEN athlete_id % 2 = 0 THEN athlete_nationality END AS country
FROM t3_athletes"""

ORACLE["teams_all_fields"] = ORACLE["project_rename"].replace(
    "s_acctbal >= 0 AS team_is_active,", """s_acctbal >= 0 AS team_is_active,
  concat('[{"href":"/logos/', s_suppkey, '"}]') AS team_logos, CAST(NULL AS VARCHAR) AS team_links,""")

ORACLE["athletes_all_fields"] = W("t3_athletes") + """
SELECT '2024-07-01T00:00:00' AS ingestion_timestamp, 'api' AS source, CAST(athlete_id AS VARCHAR) AS athlete_id,
  concat('s:', athlete_id) AS athlete_uid, md5(CAST(athlete_id AS VARCHAR)) AS athlete_guid,
  substr(athlete_full_name, 1, 4) AS athlete_first_name, substr(athlete_full_name, 5, 20) AS athlete_last_name,
  athlete_full_name, upper(athlete_full_name) AS athlete_display_name, lower(athlete_full_name) AS athlete_short_name,
  CASE WHEN athlete_weight IS NOT NULL THEN concat(CAST(athlete_weight AS INT), '.0') END AS athlete_weight,
  CASE WHEN athlete_height IS NOT NULL THEN concat(CAST(athlete_height AS INT), '.0') END AS athlete_height,
  CAST(athlete_age AS VARCHAR) AS athlete_age, concat('1990-01-', lpad(CAST(athlete_id % 28 + 1 AS VARCHAR), 2, '0')) AS athlete_date_of_birth,
  concat('{"city":"', team_name, '"}') AS athlete_birth_place, athlete_nationality,
  concat('{"name":"', athlete_position, '"}') AS athlete_position, CAST(athlete_id % 99 AS VARCHAR) AS athlete_jersey,
  CAST(team_id AS VARCHAR) AS team_id, team_name, 'T' AS team_abbreviation,
  '2024-07-01T00:00:00' AS transformation_timestamp, 'silver' AS data_layer
FROM t3_athletes"""

ORACLE["events_all_fields"] = W("t4_matches") + """,
r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY match_date DESC, match_status DESC, venue DESC, attendance DESC,
        CAST(group_id AS VARCHAR) DESC, CAST(home_team_id AS VARCHAR) DESC, CAST(home_score AS VARCHAR) DESC,
        CAST(away_team_id AS VARCHAR) DESC, CAST(away_score AS VARCHAR) DESC) AS k FROM t4_matches)
SELECT '2024-07-01T00:00:00' AS ingestion_timestamp, 'api' AS source, CAST(event_id AS VARCHAR) AS event_id, concat('e:', event_id) AS event_uid,
  strftime(match_date, '%Y-%m-%dT00:00Z') AS event_date, concat('Event ', event_id) AS event_name, concat('E', event_id) AS event_short_name,
  concat('{"name":"', match_status, '"}') AS event_status, concat('{"year":', year(match_date), '}') AS event_season,
  event_id % 2 = 0 AS event_time_valid, concat('[{"href":"/e/', event_id, '"}]') AS event_links, venue,
  CAST(group_id AS VARCHAR) AS group_id, CAST(home_team_id AS VARCHAR) AS home, CAST(away_team_id AS VARCHAR) AS away,
  '2024-07-01T00:00:00' AS transformation_timestamp, 'silver' AS data_layer
FROM r WHERE k = 1"""

# --------------------------------------------- files written, read back ---

ORACLE["bronze_assets"] = W("t1_base") + """
SELECT season, count(*) AS documents, count(*) AS named FROM t1_base, (VALUES ('2023'), ('2024')) s(season) GROUP BY season"""

ORACLE["lake_inventory"] = """
SELECT * FROM (VALUES ('silver', 'nation', TRUE), ('silver', 'customer', TRUE), ('gold', 'region', TRUE)) v(layer, dataset, has_rows)"""

_STANDINGS = """SELECT group_id, group_name, team_id, team_name, gamesPlayed, wins, losses, ties, points, pointsPerGame,
  goalsFor, goalsAgainst, goalDifferential FROM t2_standings"""
ORACLE["layer_write"] = W("t2_standings") + _STANDINGS

_TAGGED = W("t2_standings") + """
SELECT CAST(group_id AS INT) AS group_id, group_name, team_id, team_name, points, {tags} AS tags{more} FROM t2_standings"""
ORACLE["export_csv"] = ORACLE["export_bi"] = _TAGGED.format(
    tags="""concat('["', group_name, '","a \\"b\\", c"]')""", more="")
ORACLE["export_json"] = _TAGGED.format(tags="""concat(group_name, '|a "b", c')""", more=", (SELECT count(*) FROM t2_standings) AS record_count")

ORACLE["export_all"] = """
SELECT * FROM (VALUES ('nation', 'success', TRUE, FALSE), ('broken', 'failed', FALSE, TRUE), ('region', 'success', TRUE, FALSE))
  v(dataset, status, written, has_error)"""

ORACLE["warehouse_table"] = "SELECT * FROM nation"

_TEAM_TABLE = "(SELECT s_suppkey AS team_id, s_name AS team_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
ORACLE["quality_reports"] = W("t2_standings") + _UNION.join([
    _row_count("standings", "t2_standings", 1, 100), _exists("standings", "group_id", True), _exists("standings", "group_name", True),
    _not_null("standings", "t2_standings", "group_id"), _row_count("teams", _TEAM_TABLE, 1, 50), _exists("teams", "team_id", True),
    _exists("teams", "team_name", True), _not_null("teams", _TEAM_TABLE, "team_id"), _not_null("teams", _TEAM_TABLE, "team_name")])

ORACLE["layer_job"] = W("t2_standings") + f"""
SELECT 'silver' AS layer, 'standings' AS dataset, TRUE AS success, CAST(0 AS BIGINT) AS rejected, count(*) AS n_rows FROM t2_standings
UNION ALL SELECT 'silver', 'teams', TRUE, 0, count(*) FROM {_TEAM_TABLE}
UNION ALL SELECT 'gold', 'team_performance_summary', TRUE, NULL, count(*) FROM t2_standings
UNION ALL SELECT 'gold', 'competition_overview', TRUE, NULL, 1
UNION ALL SELECT 'gold', 'group_analysis', TRUE, NULL, count(DISTINCT group_id) FROM t2_standings"""

_RUN = [("silver", "standings", "TRUE", "0", "TRUE"), ("silver", "teams", "TRUE", "0", "FALSE"),
        *(("silver", e, "FALSE", "NULL", "FALSE") for e in ("athletes", "events", "player_stats")),
        ("quality", "standings", "TRUE", "NULL", "TRUE"), ("quality", "teams", "TRUE", "NULL", "FALSE"), ("quality", "athletes", "FALSE", "NULL", "FALSE"),
        *(("gold", g, "TRUE", "NULL", "FALSE") for g in ("team_performance_summary", "competition_overview", "group_analysis")),
        *(("gold", g, "FALSE", "NULL", "FALSE") for g in ("player_analytics", "team_roster_summary")),
        *(("warehouse", w, "TRUE", "0", "FALSE") for w in ("dim_teams", "dim_groups", "dim_dates", "fact_team_performance")),
        *(("warehouse", w, "FALSE", "NULL", "FALSE") for w in ("dim_players", "fact_player_stats", "fact_match_results")),
        *(("export", g, "TRUE", "NULL", "FALSE") for g in ("team_performance_summary", "competition_overview", "group_analysis"))]
ORACLE["pipeline_run"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{layer}', '{name}', {ok}, NOT {ok}, CAST({n} AS BIGINT), {skipped})" for layer, name, ok, n, skipped in _RUN) + (
    ") v(layer, dataset, success, has_error, rejected, skipped)")

ORACLE["dq_observed"] = ORACLE["dq_suite"]

ORACLE["quarantine"] = W("t3_athletes") + """
SELECT athlete_id, array_to_string([x FOR x IN [
    CASE WHEN athlete_id IS NULL THEN 'expect_column_values_to_not_be_null(athlete_id)' END,
    CASE WHEN athlete_age < 18 OR athlete_age > 38 THEN 'expect_column_values_to_be_between(athlete_age)' END,
    CASE WHEN athlete_nationality IS NULL THEN 'expect_column_values_to_not_be_null(athlete_nationality)' END] IF x IS NOT NULL], ',') AS broken
FROM t3_athletes"""

ORACLE["compacted_batches"] = """
SELECT l_linenumber, count(*) AS n_rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, TRUE AS one_file
FROM lineitem GROUP BY l_linenumber"""

# ------------------------------------------- views of the loaded warehouse ---

ORACLE["views_from_warehouse"] = ORACLE["v_team_performance"].replace(
    "SELECT s_name AS team_name, n_name AS group_name", "SELECT s_name AS team_name, CAST(NULL AS VARCHAR) AS team_abbreviation, n_name AS group_name")

ORACLE["table_metrics_loaded"] = W("t2_standings", "t6_fact_player_stats") + """
SELECT 'fact_team_performance' AS table_name, count(*) + count(*) FILTER (WHERE team_id % 3 <> 0) AS row_count,
  TIMESTAMP '2024-12-31 00:00:00' AS earliest_record, TIMESTAMP '2024-12-31 00:00:00' AS latest_record,
  count(DISTINCT team_id) AS unique_teams, CAST(2 AS BIGINT) AS unique_dates FROM t2_standings
UNION ALL SELECT 'fact_player_stats', count(*), TIMESTAMP '2024-12-31 00:00:00', TIMESTAMP '2024-12-31 00:00:00',
  count(DISTINCT player_id), count(DISTINCT date_id) FROM (SELECT DISTINCT player_id, team_id, date_id FROM t6_fact_player_stats)"""

ORACLE["data_quality_loaded"] = W("t2_standings", "t3_athletes") + """
SELECT 'Teams' AS table_name, count(*) AS record_count, CAST(0 AS BIGINT) AS null_names, CAST(0 AS BIGINT) AS null_ids FROM supplier
UNION ALL SELECT 'Players', count(*), 0, 0 FROM t3_athletes WHERE athlete_full_name IS NOT NULL AND athlete_age IS NOT NULL
UNION ALL SELECT 'Team Performance', count(*) + count(*) FILTER (WHERE team_id % 3 <> 0), 0, 0 FROM t2_standings"""
