"""Incremental gold from mergeable partial states.

The group and competition totals are kept as a table of signed counts:
how many teams of a group have a value of a measure. Sums, averages, counts
and extremes all follow from it; two such tables are merged by adding their
counts; and a replaced snapshot is taken back by adding its rows with minus
one, extremes included. A micro-batch reads its own files, the newest rows
of the teams (to know what it replaces) and the counts, never old files.

Both tables are versioned (:mod:`pitchline.sinks.versions`). The counts are
published first and the rows second, each under the batch's name, so a batch
that is replayed after a failure anywhere in between changes nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitchline.functions import exprs as X
from pitchline.operators.ranking import materialize
from pitchline.plans import gold, silver
from pitchline.plans.warehouse import one_row_per_key
from pitchline.sinks import versions
from pitchline.streaming.incremental import bronze_stream

KEY = ["season", "group_id", "team_id"]
GROUP = ["season", "group_id", "group_name"]
#: Measures whose values are counted; ``TEAMS`` counts the rows themselves.
MEASURES = ("gamesPlayed", "goalsFor", "points", "goalDifferential")
TEAMS = "teams"
ROWS, COUNTS = "standings_rows", "standings_counts"


def team_rows(standings: DataFrame) -> DataFrame:
    """The newest row of each team of a batch: key, name of the group,
    snapshot time and measures as whole numbers."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in standings.columns else F.lit("")
    rows = standings.select(
        *(text(c).alias(c) for c in KEY), "group_name", text("ingestion_timestamp").alias("_newest"),
        text("ingestion_timestamp").alias("ingestion_timestamp"), *(X.to_int(m).alias(m) for m in MEASURES))
    return one_row_per_key(rows, KEY, newest=["_newest"])


def contributions(rows: DataFrame, sign: int) -> DataFrame:
    """What the rows add to the counts (or take from them)."""
    long = rows.withColumn(TEAMS, F.lit(0)).unpivot(GROUP, [TEAMS, *MEASURES], "measure", "value")
    return long.where(F.col("value").isNotNull()).select(*GROUP, "measure", "value", F.lit(sign).cast("bigint").alias("n"))


def merged(*states: DataFrame) -> DataFrame:
    """The sum of count tables; what has come to nothing is left out."""
    both = states[0]
    for more in states[1:]:
        both = both.unionByName(more)
    return both.groupBy(*GROUP, "measure", "value").agg(F.sum("n").alias("n")).where("n <> 0")


def apply_batch(spark: SparkSession, root: str, standings: DataFrame, load: str) -> None:
    """Merge the silver standings of one micro-batch into both tables. Rows
    older than what a team has already, and a batch applied before, change
    nothing."""
    rows_base = versions.manifest(spark, root, ROWS)
    if rows_base and load in rows_base["loads"]:
        return
    new = team_rows(standings)
    if rows_base is None:
        fresh, replaced = materialize(new, "fresh"), None
    else:
        known = versions.read_manifest(spark, root, ROWS, rows_base)
        before = known.select(*KEY, F.col("ingestion_timestamp").alias("_before"))
        fresh = materialize(new.join(before, KEY, "left").where(
            F.col("_before").isNull() | (F.col("_before") < F.col("ingestion_timestamp"))).drop("_before"), "fresh")
        replaced = known.join(fresh.select(*KEY), KEY, "left_semi")

    counts_base = versions.manifest(spark, root, COUNTS)
    if counts_base is None or load not in counts_base["loads"]:
        states = [contributions(fresh, 1)]
        if replaced is not None:
            states.append(contributions(replaced, -1))
        if counts_base is not None:
            states.append(versions.read_manifest(spark, root, COUNTS, counts_base))
        versions.write_version(merged(*states), root, COUNTS, load, counts_base)
    rows = fresh if rows_base is None else known.join(fresh.select(*KEY), KEY, "left_anti").unionByName(fresh)
    versions.write_version(rows, root, ROWS, load, rows_base)


def counts(spark: SparkSession, root: str) -> DataFrame:
    return versions.read_current(spark, root, COUNTS)


def rows(spark: SparkSession, root: str) -> DataFrame:
    return versions.read_current(spark, root, ROWS)


def _total(measure: str):
    return F.sum(F.when(F.col("measure") == measure, F.col("value") * F.col("n")))


def _number(measure: str):
    return F.sum(F.when(F.col("measure") == measure, F.col("n")))


def _values(measure: str):
    return F.when(F.col("measure") == measure, F.col("value"))


def group_analysis(counted: DataFrame) -> DataFrame:
    """E4 from the counts: the same table as :func:`gold.group_analysis`."""
    return gold.ranked_groups(counted.groupBy(*GROUP).agg(
        _number(TEAMS).alias("teams_in_group"), _total("gamesPlayed").alias("total_games_played"),
        _total("goalsFor").alias("total_goals_scored"), (_total("points") / _number("points")).alias("avg_points_per_team"),
        F.max(_values("points")).alias("group_leader_points"), F.min(_values("points")).alias("group_lowest_points"),
        (_total("goalDifferential") / _number("goalDifferential")).alias("avg_goal_differential"),
        F.max(_values("goalDifferential")).alias("best_goal_differential"),
        F.min(_values("goalDifferential")).alias("worst_goal_differential")))


def competition_overview(counted: DataFrame, team_rows: DataFrame, competition_name: str = gold.COMPETITION_NAME) -> DataFrame:
    """E2 from the counts; the distinct teams of a season come from the rows."""
    teams = team_rows.groupBy("season").agg(F.count_distinct("team_id").alias("total_teams"))
    totals = counted.groupBy("season").agg(
        F.count_distinct("group_id").alias("total_groups"), _total("gamesPlayed").alias("total_games_played"),
        _total("goalsFor").alias("total_goals_scored"), (_total("goalsFor") / _number("goalsFor")).alias("avg_goals_per_team"),
        F.max(_values("points")).alias("max_points"), F.min(_values("points")).alias("min_points"))
    return totals.join(teams, "season").withColumns({
        "goals_per_game": X.safe_ratio("total_goals_scored", "total_games_played"),
        "competition_name": F.lit(competition_name)})


def stream_gold(spark: SparkSession, bronze_root: str, state_root: str, checkpoint: str, *, layout: str = "lines",
                available_now: bool = True) -> StreamingQuery:
    """New standings documents into the partial states, a micro-batch at a
    time; the documents read are those of new files."""

    def batch(df: DataFrame, batch_id: int) -> None:
        apply_batch(spark, state_root, silver.silver_standings(df), f"batch-{batch_id}")

    w = (bronze_stream(spark, bronze_root, "standings", layout=layout).writeStream
         .foreachBatch(batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="6 hours")
    return w.start()
