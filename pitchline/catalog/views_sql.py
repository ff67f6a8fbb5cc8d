"""The league-shaped adapter views of FIXTURES.md §C as SQL text, for the
independent DuckDB oracle. The Spark side builds the same views with the
DataFrame API in :mod:`pitchline.sources.adapters`."""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "t1_base": """
SELECT n.n_nationkey AS group_id, n.n_name AS group_name, s.s_suppkey AS team_id, s.s_name AS team_name,
  CAST(COUNT(*) AS DOUBLE) AS gamesPlayed,
  CAST(COUNT(CASE WHEN l_returnflag='A' THEN 1 END) AS DOUBLE) AS wins,
  CAST(COUNT(CASE WHEN l_returnflag='R' THEN 1 END) AS DOUBLE) AS losses,
  CAST(COUNT(CASE WHEN l_returnflag='N' THEN 1 END) AS DOUBLE) AS ties,
  CAST(3*COUNT(CASE WHEN l_returnflag='A' THEN 1 END)+COUNT(CASE WHEN l_returnflag='N' THEN 1 END) AS DOUBLE) AS points,
  CAST(SUM(l_linenumber) AS DOUBLE) AS goalsFor,
  CAST(SUM(CAST(l_quantity AS INT) % 8) AS DOUBLE) AS goalsAgainst
FROM lineitem l JOIN supplier s ON l.l_suppkey=s.s_suppkey JOIN nation n ON s.s_nationkey=n.n_nationkey
GROUP BY n.n_nationkey, n.n_name, s.s_suppkey, s.s_name""",
    "t1_standings_long": """
SELECT group_id, group_name, team_id, team_name, 'gamesPlayed' AS stat_name, gamesPlayed AS stat_value FROM t1_base
UNION ALL SELECT group_id, group_name, team_id, team_name, 'wins', wins FROM t1_base
UNION ALL SELECT group_id, group_name, team_id, team_name, 'losses', losses FROM t1_base
UNION ALL SELECT group_id, group_name, team_id, team_name, 'ties', ties FROM t1_base
UNION ALL SELECT group_id, group_name, team_id, team_name, 'points', points FROM t1_base
UNION ALL SELECT group_id, group_name, team_id, team_name, 'pointsPerGame', ROUND(points/gamesPlayed,4) FROM t1_base
UNION ALL SELECT group_id, group_name, team_id, team_name, 'goalsFor', goalsFor FROM t1_base
UNION ALL SELECT group_id, group_name, team_id, team_name, 'goalsAgainst', goalsAgainst FROM t1_base
UNION ALL SELECT group_id, group_name, team_id, team_name, 'goalDifferential', goalsFor-goalsAgainst FROM t1_base
UNION ALL SELECT group_id, group_name, team_id, team_name, 'rank',
  CAST(ROW_NUMBER() OVER (PARTITION BY group_id ORDER BY points DESC, goalsFor-goalsAgainst DESC, team_id) AS DOUBLE) FROM t1_base""",
    "t2_standings": """
SELECT group_id, group_name, team_id, team_name,
  MAX(stat_value) FILTER (WHERE stat_name='gamesPlayed') AS gamesPlayed,
  MAX(stat_value) FILTER (WHERE stat_name='wins') AS wins,
  MAX(stat_value) FILTER (WHERE stat_name='losses') AS losses,
  MAX(stat_value) FILTER (WHERE stat_name='ties') AS ties,
  MAX(stat_value) FILTER (WHERE stat_name='points') AS points,
  MAX(stat_value) FILTER (WHERE stat_name='pointsPerGame') AS pointsPerGame,
  MAX(stat_value) FILTER (WHERE stat_name='goalsFor') AS goalsFor,
  MAX(stat_value) FILTER (WHERE stat_name='goalsAgainst') AS goalsAgainst,
  MAX(stat_value) FILTER (WHERE stat_name='goalDifferential') AS goalDifferential,
  MAX(stat_value) FILTER (WHERE stat_name='rank') AS rank
FROM t1_standings_long GROUP BY group_id, group_name, team_id, team_name""",
    "t3_athletes": """
SELECT c_custkey AS athlete_id, c_name AS athlete_full_name,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(16 + c_custkey % 25 AS INT) END AS athlete_age,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(60 + c_custkey % 40 AS DOUBLE) END AS athlete_weight,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(160 + c_custkey % 37 AS DOUBLE) END AS athlete_height,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CONCAT('NATION_', CAST(c_custkey % 7 AS VARCHAR(10))) END AS athlete_nationality,
  c_mktsegment AS athlete_position,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_nationkey END AS team_id, n_name AS team_name
FROM customer JOIN nation ON c_nationkey=n_nationkey""",
    "t4_matches": """
SELECT l_orderkey AS event_id, hn.n_nationkey AS home_team_id, an.n_nationkey AS away_team_id, hn.n_regionkey AS group_id,
  CAST(l_shipdate AS DATE) AS match_date, CAST(l_linenumber-1 AS INT) AS home_score, CAST(l_quantity AS INT) % 5 AS away_score,
  o_orderstatus AS match_status, CAST(CAST(l_partkey AS INT) % 1000 AS INT) AS attendance, p_brand AS venue
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation hn ON c_nationkey=hn.n_nationkey
JOIN supplier ON l_suppkey=s_suppkey JOIN nation an ON s_nationkey=an.n_nationkey JOIN part ON l_partkey=p_partkey
WHERE hn.n_nationkey<>an.n_nationkey""",
    "t5_fact_team_performance": """
SELECT s_suppkey AS team_id, s_nationkey AS group_id, CAST(CONCAT(CAST(YEAR(l_shipdate) AS VARCHAR(4)),'-12-31') AS DATE) AS date_id,
  COUNT(*) AS games_played, COUNT(CASE WHEN l_returnflag='A' THEN 1 END) AS wins,
  3*COUNT(CASE WHEN l_returnflag='A' THEN 1 END)+COUNT(CASE WHEN l_returnflag='N' THEN 1 END) AS points,
  CAST(SUM(l_linenumber) AS BIGINT) AS goals_for
FROM lineitem JOIN supplier ON l_suppkey=s_suppkey
GROUP BY s_suppkey, s_nationkey, CAST(CONCAT(CAST(YEAR(l_shipdate) AS VARCHAR(4)),'-12-31') AS DATE)""",
    "t6_fact_player_stats": """
SELECT o_custkey AS player_id, c_nationkey AS team_id, CAST(o_orderdate AS DATE) AS date_id, 1 AS games_played,
  CAST(o_orderkey % 4 AS INT) AS goals, CAST(o_orderkey % 3 AS INT) AS assists
FROM orders JOIN customer ON o_custkey=c_custkey""",
    "t7_logs": """
SELECT event_id, ts, CONCAT(UPPER(event_type), CASE WHEN event_id % 3 = 0 THEN ' duration ' WHEN event_id % 3 = 1
  THEN ' processing time ' ELSE ' size ' END, props) AS message, user_id AS log_stream FROM events""",
    "t8_metrics": """
SELECT ts, event_type AS metric_name, value FROM events""",
}

DEPENDS: dict[str, tuple[str, ...]] = {
    "t1_standings_long": ("t1_base",),
    "t2_standings": ("t1_standings_long",),
}


def with_views(*names: str) -> str:
    """``WITH`` clause defining the named views and what they depend on,
    in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPENDS.get(n, ()):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order) + "\n"
