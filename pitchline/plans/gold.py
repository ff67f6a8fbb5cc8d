"""Gold datasets (E2-E4, F1-F3, K10): silver → curated tables.

Each builder is ``DataFrame → DataFrame``; writing (and audit columns) is
left to the layer job. Inputs are the silver shapes: wide standings with
the stat columns, athletes with an ``athlete_team`` struct. Where the input
has a ``season``, every total, count, rank and label is per season.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions import exprs as X
from pitchline.operators.filters import latest_snapshot, require_not_null
from pitchline.operators.ranking import global_row_number, rank_within

# Labels of the overview row; the season is that of rows without one of their own.
COMPETITION_NAME = "Competition"
SEASON = "2024-25"


def _present(df: DataFrame, mapping: list[tuple[str, object]]) -> list:
    """Select items whose source column exists (payload fields are optional)."""
    cols = set(df.columns)
    out = []
    for src, expr in mapping:
        if src in cols:
            out.append(expr)
    return out


STANDINGS_KEY = ("season", "group_id", "team_id")
ATHLETES_KEY = ("season", "athlete_id")


def _season(df: DataFrame) -> list[str]:
    """The season as a grouping key, where the data has it."""
    return ["season"] if "season" in df.columns else []


def _ranked(df: DataFrame, order: list, name: str) -> DataFrame:
    """Rows ranked in ``order``, within their season where there is one."""
    season = _season(df)
    return rank_within(df, season, order, name) if season else global_row_number(df, order, name)


def _snapshot(df: DataFrame, snapshot: str, key: tuple[str, ...] = STANDINGS_KEY) -> DataFrame:
    """The newest snapshot of each key (of the key columns that are there)."""
    if snapshot == "latest" and "ingestion_timestamp" in df.columns:
        return latest_snapshot(df, "ingestion_timestamp", by=[c for c in key if c in df.columns])
    return df


def team_performance_summary(standings: DataFrame, *, snapshot: str = "latest",
                             rank: bool = True) -> DataFrame:
    """Per-team performance with rates, rating and an overall rank (F1)
    of the season.

    ``overall_rank`` orders by points desc, goal difference desc and team id
    (the tie-break makes it deterministic); ``rank=False`` leaves it out,
    for consumers that do not read it."""
    s = _snapshot(standings, snapshot)
    perf = s.select(*_present(s, [
        ("season", F.col("season")),
        ("group_id", F.col("group_id")),
        ("group_name", F.col("group_name")),
        ("team_id", F.col("team_id")),
        ("team_name", F.col("team_name")),
        ("team_abbreviation", F.col("team_abbreviation")),
        ("gamesPlayed", X.to_int("gamesPlayed").alias("games_played")),
        ("wins", X.to_int("wins").alias("wins")),
        ("losses", X.to_int("losses").alias("losses")),
        ("ties", X.to_int("ties").alias("ties")),
        ("points", X.to_int("points").alias("points")),
        ("pointsPerGame", X.to_double("pointsPerGame").alias("points_per_game")),
        ("goalsFor", X.to_int("goalsFor").alias("goals_for")),
        ("goalsAgainst", X.to_int("goalsAgainst").alias("goals_against")),
        ("goalDifferential", X.to_int("goalDifferential").alias("goal_differential")),
        ("rank", X.to_int("rank").alias("group_rank")),
    ]))
    perf = require_not_null(perf, "games_played", "points")
    perf = perf.withColumns({
        "win_percentage": X.win_pct("wins", "games_played"),
        "goals_per_game": X.safe_ratio("goals_for", "games_played"),
        "goals_conceded_per_game": X.safe_ratio("goals_against", "games_played"),
        "performance_rating": X.performance_rating("points_per_game", "goal_differential"),
    })
    if not rank:
        return perf
    return _ranked(perf, [F.col("points").desc(), F.col("goal_differential").desc(),
                          F.col("team_id").asc(), *[c for c in ("group_id",) if c in perf.columns]], "overall_rank")


def player_analytics(athletes: DataFrame, *, snapshot: str = "latest") -> DataFrame:
    """Per-player profile with team fields, age group and BMI (K10), from
    the player's newest snapshot."""
    a = _snapshot(athletes, snapshot, ATHLETES_KEY)
    p = a.select(*_present(a, [
        ("season", F.col("season")),
        ("athlete_id", F.col("athlete_id")),
        ("athlete_full_name", F.col("athlete_full_name").alias("player_name")),
        ("athlete_display_name", F.col("athlete_display_name").alias("player_display_name")),
        ("athlete_age", X.to_int("athlete_age").alias("age")),
        ("athlete_weight", X.to_double("athlete_weight").alias("weight_kg")),
        ("athlete_height", X.to_double("athlete_height").alias("height_cm")),
        ("athlete_birth_place", F.col("athlete_birth_place").alias("birth_place")),
        ("athlete_nationality", F.col("athlete_nationality").alias("nationality")),
        ("athlete_position", F.col("athlete_position").alias("position")),
        ("athlete_team", F.col("athlete_team").alias("team_info")),
        ("athlete_jersey", F.col("athlete_jersey").alias("jersey_number")),
    ]))
    p = require_not_null(p, "player_name", "age")
    if "team_info" in p.columns:
        p = p.withColumns({
            "team_id": F.col("team_info.id"),
            "team_name": F.col("team_info.name"),
            "team_abbreviation": F.col("team_info.abbreviation"),
        })
    return p.withColumns({"age_group": X.age_group("age"),
                          "bmi": X.bmi("weight_kg", "height_cm")})


def team_roster_summary(athletes: DataFrame, *, sets: str = "array", snapshot: str = "latest") -> DataFrame:
    """Squad profile per team and season (E3): size, age/weight/height stats, distinct
    nationalities and positions, over each player's newest snapshot.

    ``sets``: ``"array"`` keeps sorted distinct arrays (memory per group is
    bounded by the number of distinct values, not by the squad size; the
    partial aggregate de-duplicates map-side), ``"string"`` joins them with
    commas, ``"count"`` keeps only the counts (``count(DISTINCT)``), the
    choice for high-cardinality columns at scale."""
    athletes = _snapshot(athletes, snapshot, ATHLETES_KEY)
    team = F.col("athlete_team")
    age = X.to_int("athlete_age")
    aggs = [F.count(F.lit(1)).alias("total_players"),
            F.avg(age).alias("avg_age"),
            F.min(age).alias("min_age"),
            F.max(age).alias("max_age"),
            F.avg(X.to_double("athlete_weight")).alias("avg_weight"),
            F.avg(X.to_double("athlete_height")).alias("avg_height")]
    if sets == "count":
        aggs += [F.count_distinct("athlete_nationality").alias("nationality_count"),
                 F.count_distinct("athlete_position").alias("position_count")]
    else:
        aggs += [F.sort_array(F.collect_set("athlete_nationality")).alias("nationalities"),
                 F.sort_array(F.collect_set("athlete_position")).alias("positions")]
    r = (athletes.groupBy(*_season(athletes), team.getField("id").alias("team_id"),
                          team.getField("name").alias("team_name"),
                          team.getField("abbreviation").alias("team_abbreviation"))
         .agg(*aggs)
         .where(F.col("team_id").isNotNull()))
    if sets != "count":
        r = r.withColumns({"nationality_count": F.size("nationalities"),
                           "position_count": F.size("positions")})
        if sets == "string":
            r = r.withColumns({"nationalities": F.array_join("nationalities", ","),
                               "positions": F.array_join("positions", ",")})
    return r.withColumn("age_diversity", F.col("max_age") - F.col("min_age"))


def competition_overview(standings: DataFrame, *, snapshot: str = "latest",
                         competition_name: str = COMPETITION_NAME,
                         season: str = SEASON, approx: bool = False) -> DataFrame:
    """Competition totals, one row a season (E2). Two exact distinct counts in one
    aggregate (Catalyst expands them); totals are summed per task first.
    ``approx=True`` uses HyperLogLog++ for the two distinct counts."""
    s = _snapshot(standings, snapshot)

    def distinct(c: str):
        return (F.approx_count_distinct(c) if approx else F.count_distinct(c)).cast("bigint")

    o = s.groupBy(*_season(s)).agg(
        distinct("team_id").alias("total_teams"),
        distinct("group_id").alias("total_groups"),
        F.sum(X.to_int("gamesPlayed")).alias("total_games_played"),
        F.sum(X.to_int("goalsFor")).alias("total_goals_scored"),
        F.avg(X.to_int("goalsFor")).alias("avg_goals_per_team"),
        F.max(X.to_int("points")).alias("max_points"),
        F.min(X.to_int("points")).alias("min_points"),
    )
    return o.withColumns({
        "goals_per_game": X.safe_ratio("total_goals_scored", "total_games_played"),
        "competition_name": F.lit(competition_name),
        "season": F.col("season") if _season(s) else F.lit(season),
    })


def group_analysis(standings: DataFrame, *, snapshot: str = "latest") -> DataFrame:
    """Per-group statistics and competitiveness rank (E4, C18, C19, F2) of
    the season."""
    s = _snapshot(standings, snapshot)
    pts, gd = X.to_int("points"), X.to_int("goalDifferential")
    g = s.groupBy(*_season(s), "group_id", "group_name").agg(
        F.count(F.lit(1)).alias("teams_in_group"),
        F.sum(X.to_int("gamesPlayed")).alias("total_games_played"),
        F.sum(X.to_int("goalsFor")).alias("total_goals_scored"),
        F.avg(pts).alias("avg_points_per_team"),
        F.max(pts).alias("group_leader_points"),
        F.min(pts).alias("group_lowest_points"),
        F.avg(gd).alias("avg_goal_differential"),
        F.max(gd).alias("best_goal_differential"),
        F.min(gd).alias("worst_goal_differential"),
    )
    return ranked_groups(g)


def ranked_groups(g: DataFrame) -> DataFrame:
    """Spread, competitiveness and rank of group totals."""
    g = g.withColumn("points_spread", F.col("group_leader_points") - F.col("group_lowest_points"))
    g = g.withColumns({
        "competitiveness_score": X.competitiveness("points_spread"),
        "goals_per_game": X.safe_ratio("total_goals_scored", "total_games_played"),
    })
    return _ranked(g, [F.col("competitiveness_score").desc(), F.col("group_id").asc(), "group_name"],
                   "competitiveness_rank")
