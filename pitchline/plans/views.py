"""Reporting views over the star schema.

Plans: facts are reduced (latest snapshot, per-key pre-aggregation) before
they meet a dimension; dimensions are joined by equi-join and sized by
AQE at run time; ORDER BY ... LIMIT becomes a per-task top-k
(TakeOrderedAndProject), never a global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions import exprs as X
from pitchline.operators.filters import latest_snapshot

PERFORMANCE_MEASURES = ("games_played", "wins", "losses", "ties", "points", "goal_differential",
                        "group_rank", "overall_rank", "win_percentage", "performance_rating")


def _measures(df: DataFrame, names) -> list[str]:
    cols = set(df.columns)
    return [c for c in names if c in cols]


def v_team_performance_summary(fact: DataFrame, teams: DataFrame, groups: DataFrame, *, newest: bool = True) -> DataFrame:
    """G1: newest snapshot of team performance with team and group names
    (``newest=False``: ``fact`` is that snapshot already, read by partition)."""
    f = latest_snapshot(fact, "date_id") if newest else fact
    t_cols = ["team_id", "team_name"] + _measures(teams, ["team_abbreviation"])
    j = (f.join(teams.select(*t_cols), "team_id")
         .join(groups.select("group_id", "group_name"), "group_id"))
    return j.select(*t_cols[1:], "group_name", *_measures(f, PERFORMANCE_MEASURES))


def v_group_standings(fact: DataFrame, teams: DataFrame, groups: DataFrame, *, newest: bool = True) -> DataFrame:
    """Newest standings per group, ordered by group then rank
    (or points when no rank is stored); ``newest`` as for G1."""
    f = latest_snapshot(fact, "date_id") if newest else fact
    j = (f.join(teams.select("team_id", "team_name"), "team_id")
         .join(groups.select("group_id", "group_name"), "group_id"))
    order = [F.col("group_name")]
    order += [F.col("group_rank")] if "group_rank" in f.columns else [F.col("points").desc()]
    order += [F.col("team_name")]
    return j.select("group_name", "team_name", *_measures(f, (
        "points", "games_played", "wins", "losses", "ties", "goals_for", "goals_against",
        "goal_differential", "group_rank"))).orderBy(*order)


def v_recent_matches(matches: DataFrame, teams: DataFrame, groups: DataFrame,
                     n: int = 20) -> DataFrame:
    """The ``n`` newest matches with home/away team names (the team
    dimension plays two roles) and the group name. Every projected column
    is a tie-break, so the top-k is deterministic."""
    home = teams.select(F.col("team_id").alias("home_team_id"), F.col("team_name").alias("home_team"))
    away = teams.select(F.col("team_id").alias("away_team_id"), F.col("team_name").alias("away_team"))
    g = groups.select("group_id", "group_name")
    j = matches.join(home, "home_team_id").join(away, "away_team_id").join(g, "group_id")
    cols = ["match_date", "home_team", "away_team", "home_score", "away_score", "match_status",
            "group_name", "venue"]
    out = j.select("event_id", *cols)
    return out.orderBy(F.col("match_date").desc(), *[F.col(c).asc() for c in ["event_id", *cols[1:]]]
                       ).limit(n)


def top_scorers(stats: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Goals, assists and games by player, position and team, with
    ``ROUND(goals::DECIMAL / games, 2)``.

    The fact is summed per (player, team) first, so the dimension joins see
    one row per pair instead of one per match; the final regroup by names
    is what the view specifies (names need not be unique)."""
    per = stats.groupBy("player_id", "team_id").agg(
        F.sum("goals").alias("_g"), F.sum("assists").alias("_a"),
        F.sum("games_played").alias("_n"))
    j = (per.join(players.select("player_id", "player_name", "position"), "player_id")
         .join(teams.select("team_id", "team_name"), "team_id"))
    agg = j.groupBy("player_name", "position", "team_name").agg(
        F.sum("_g").cast("bigint").alias("total_goals"),
        F.sum("_a").cast("bigint").alias("total_assists"),
        F.sum("_n").cast("bigint").alias("total_games"))
    agg = agg.withColumn("goals_per_game",
                         X.goals_ratio_decimal("total_goals", "total_games").cast("decimal(18,2)"))
    return agg.orderBy(F.col("total_goals").desc(), F.col("total_assists").desc(), "player_name", "position", "team_name")


def _null_count(c: str) -> Column:
    return F.count(F.when(F.col(c).isNull(), 1))


def data_quality_check(dim_teams: DataFrame, dim_players: DataFrame, fact: DataFrame) -> DataFrame:
    """Record and NULL counts per table as one UNION ALL of three
    global aggregates (columns named by the first branch)."""
    teams = dim_teams.agg(F.lit("Teams").alias("table_name"), F.count(F.lit(1)).alias("record_count"),
                          _null_count("team_name").alias("null_names"),
                          _null_count("team_id").alias("null_ids"))
    players = dim_players.agg(F.lit("Players"), F.count(F.lit(1)),
                              _null_count("player_name"), _null_count("player_id"))
    perf = fact.agg(F.lit("Team Performance"), F.count(F.lit(1)),
                    _null_count("points"), _null_count("team_id"))
    return teams.union(players).union(perf)


def table_metrics(team_fact: DataFrame, player_fact: DataFrame,
                  created_col: str = "created_at", *, approx: bool = False) -> DataFrame:
    """Row count, load-time range and distinct keys per fact table
    (the second branch's distinct players land in ``unique_teams``).

    ``approx=True`` counts distinct keys with HyperLogLog++
    (``approx_count_distinct``: fixed memory per task, no Expand of the
    input), the choice for monitoring very large facts."""
    def distinct(c: str) -> Column:
        return (F.approx_count_distinct(c) if approx else F.count_distinct(c)).cast("bigint")

    a = team_fact.agg(F.lit("fact_team_performance").alias("table_name"),
                      F.count(F.lit(1)).alias("row_count"),
                      F.min(created_col).alias("earliest_record"),
                      F.max(created_col).alias("latest_record"),
                      distinct("team_id").alias("unique_teams"),
                      distinct("date_id").alias("unique_dates"))
    b = player_fact.agg(F.lit("fact_player_stats"), F.count(F.lit(1)), F.min(created_col),
                        F.max(created_col), distinct("player_id"), distinct("date_id"))
    return a.union(b)
