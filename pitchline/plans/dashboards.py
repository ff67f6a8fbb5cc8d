"""The data behind each dashboard tile.

Every tile is a grouped aggregate with map-side partial aggregation; the
two tiles that need per-team ordering (form, top performers) use a
``row_number() <= k`` filter, which Spark plans with a *partial window
group limit* before the shuffle, so each task ships at most ``k`` rows per
team and a hot team is reduced where it sits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchline.functions import exprs as X


def _season(df: DataFrame) -> list[str]:
    """The season as a grouping key, where the data has it."""
    return ["season"] if "season" in df.columns else []


def kpi_cards(standings: DataFrame) -> DataFrame:
    """Distinct teams and groups, total goals, goals per game."""
    goals, games = X.to_int("goalsFor"), X.to_int("gamesPlayed")
    k = standings.agg(F.count_distinct("team_name").alias("total_teams"),
                      F.count_distinct("group_name").alias("total_groups"),
                      F.sum(goals).alias("total_goals"),
                      F.sum(games).alias("_games"))
    return k.select("total_teams", "total_groups", "total_goals",
                    X.safe_ratio("total_goals", "_games").alias("avg_goals_per_game"))


def goals_distribution(standings: DataFrame) -> DataFrame:
    """Goals for, per team, descending."""
    return (standings.groupBy("team_id", "team_name")
            .agg(F.sum(X.to_int("goalsFor")).alias("goals_for"))
            .orderBy(F.col("goals_for").desc(), "team_id"))


def performance_trend(facts: DataFrame, date_col: str = "date_id",
                      team_col: str = "team_id") -> DataFrame:
    """Points (and games) by date and team."""
    return facts.groupBy(date_col, team_col).agg(
        F.sum("points").cast("bigint").alias("points"),
        F.sum("games_played").cast("bigint").alias("games_played"))


def age_distribution(players: DataFrame) -> DataFrame:
    """Player count by age group and position, per season where the
    players have one."""
    return players.groupBy(*_season(players), "age_group", "position").agg(F.count(F.lit(1)).alias("players"))


def team_composition(players: DataFrame) -> DataFrame:
    """Player count by team and position, per season where the players
    have one."""
    return players.groupBy(*_season(players), "team_id", "position").agg(F.count(F.lit(1)).alias("players"))


def venue_analysis(matches: DataFrame) -> DataFrame:
    """Matches and average attendance per venue."""
    return matches.groupBy("venue").agg(F.count(F.lit(1)).alias("matches"),
                                        F.avg("attendance").alias("avg_attendance"))


def with_outcome(matches: DataFrame) -> DataFrame:
    return matches.withColumn("outcome", X.outcome("home_score", "away_score"))


def score_distribution(matches: DataFrame) -> DataFrame:
    """Matches per (home score, away score, outcome)."""
    return (with_outcome(matches).groupBy("home_score", "away_score", "outcome")
            .agg(F.count(F.lit(1)).alias("matches")))


OUTCOMES = (X.WIN, X.DRAW, X.LOSS)


def fixture_calendar(matches: DataFrame) -> DataFrame:
    """Matches per date and outcome, one column per outcome (explicit
    pivot values: no discovery job, fixed schema; empty cells are 0)."""
    p = (with_outcome(matches).groupBy("match_date")
         .pivot("outcome", list(OUTCOMES)).agg(F.count(F.lit(1))))
    return p.select("match_date", *[F.coalesce(F.col(o), F.lit(0)).cast("bigint").alias(o.lower())
                                    for o in OUTCOMES])


def head_to_head(matches: DataFrame) -> DataFrame:
    """E14 (long form): home × away with results from the home side."""
    m = with_outcome(matches)
    return m.groupBy("home_team_id", "away_team_id").agg(
        F.count(F.lit(1)).alias("matches"),
        F.count(F.when(F.col("outcome") == X.WIN, 1)).alias("home_wins"),
        F.count(F.when(F.col("outcome") == X.DRAW, 1)).alias("draws"),
        F.count(F.when(F.col("outcome") == X.LOSS, 1)).alias("away_wins"))


def head_to_head_matrix(matches: DataFrame, away_teams: Sequence) -> DataFrame:
    """E14 (wide form): one column per away team (explicit list), cell =
    home wins - away wins."""
    m = with_outcome(matches).withColumn(
        "_pts", F.when(F.col("outcome") == X.WIN, 1).when(F.col("outcome") == X.LOSS, -1).otherwise(0))
    return m.groupBy("home_team_id").pivot("away_team_id", list(away_teams)).agg(F.sum("_pts"))


def team_results(matches: DataFrame) -> DataFrame:
    """Each match from both sides (team, opponent, goals, result letter) in
    ONE pass: every row emits its two perspectives with ``inline``, so the
    matches input is computed once (a union of two projections would plan
    the whole input twice)."""
    h, a = F.col("home_score"), F.col("away_score")

    def side(team: str, opp: str, gf: Column, ga: Column) -> Column:
        result = F.when(gf > ga, "W").when(gf == ga, "D").when(gf < ga, "L")
        return F.struct(F.col(team).alias("team_id"), F.col(opp).alias("opponent_id"),
                        gf.alias("goals_for"), ga.alias("goals_against"), result.alias("result"))

    both = F.array(side("home_team_id", "away_team_id", h, a),
                   side("away_team_id", "home_team_id", a, h))
    return matches.select("event_id", "match_date", F.inline(both))


def team_form(matches: DataFrame, n: int = 5) -> DataFrame:
    """each team's last ``n`` results, oldest first, e.g. ``"WDLWW"``.

    ``row_number() <= n`` over the newest-first order is planned with a
    partial group limit before the shuffle (at most ``n`` rows per team per
    task), then ``n`` rows per team are ordered and joined. The order ends
    with every column, so equal keys carry equal results."""
    r = team_results(matches)
    order = [F.col("match_date").desc(), F.col("event_id").desc(), F.col("opponent_id").desc(),
             F.col("goals_for").desc(), F.col("goals_against").desc()]
    last = r.withColumn("_rn", F.row_number().over(Window.partitionBy("team_id").orderBy(*order)))
    last = last.where(F.col("_rn") <= n)
    form = last.groupBy("team_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_rn").alias("rn"), "result")), asc=False)
        .alias("_s"), F.count(F.lit(1)).alias("games"))
    return form.select("team_id", F.array_join(F.transform("_s", lambda s: s["result"]), "")
                       .alias("form"), "games")


RADAR_METRICS = ("win_percentage", "goals_per_game", "goals_conceded_per_game", "points_per_game")


def team_vs_average(summary: DataFrame, metrics: Sequence[str] = RADAR_METRICS,
                    teams: Sequence | None = None, digits: int | None = None) -> DataFrame:
    """each (selected) team's radar metrics next to the league average.

    The averages come from ONE uncorrelated scalar subquery (a struct of
    all metric averages over the whole league, computed once), so no window
    over all rows and no cross join. ``digits`` rounds the averages, for
    those who want them free of the summation order of the doubles."""
    league = summary.select(F.struct(*[F.avg(m).alias(m) for m in metrics])).scalar()
    avgs = {m: league.getField(m) if digits is None else F.round(league.getField(m), digits) for m in metrics}
    out = summary if teams is None else summary.where(F.col("team_id").isin(list(teams)))
    cols: list[Column] = [F.col("team_id")]
    for m in metrics:
        cols += [F.col(m), avgs[m].alias(f"avg_{m}"), (F.col(m) - avgs[m]).alias(f"diff_{m}")]
    return out.select(*cols)


def top_performers(stats: DataFrame, metric: str, k: int = 10,
                   by: str = "player_id") -> DataFrame:
    """H4: top ``k`` players by a summed metric (goals, assists, games); the
    player id breaks ties. Pre-aggregated per player, then a per-task top-k."""
    total = f"total_{metric}"
    agg = stats.groupBy(by).agg(F.sum(metric).cast("bigint").alias(total))
    return agg.orderBy(F.col(total).desc(), F.col(by).asc()).limit(k)
