"""Warehouse star schema loads (K1-K9) mirroring the DDL as Spark types.

Dimensions are de-duplicated with grouped aggregates (map-side partial
aggregation, no window per key), facts are cast to the DDL types with
``try_cast`` (an overflowing DECIMAL(5,2) becomes NULL and is counted by
the quality contract instead of failing the load), and surrogate keys come
from :func:`pitchline.operators.ranking.surrogate_key`.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.functions import exprs as X
from pitchline.operators.filters import latest_snapshot
from pitchline.operators.ranking import surrogate_key

# VARCHAR lengths and DECIMAL types of the warehouse DDL.
VARCHAR_LIMITS = {
    "dim_teams": {"team_id": 20, "team_name": 100, "team_abbreviation": 10,
                  "team_display_name": 100, "team_location": 100, "team_color": 10,
                  "team_alternate_color": 10},
    "dim_players": {"player_id": 20, "player_name": 100, "player_display_name": 100,
                    "birth_place": 100, "nationality": 50, "position": 50, "team_id": 20,
                    "age_group": 20},
    "dim_groups": {"group_id": 20, "group_name": 100, "group_abbreviation": 10},
    "dim_dates": {"day_name": 20, "month_name": 20, "season": 10},
    "fact_team_performance": {"team_id": 20, "group_id": 20},
    "fact_player_stats": {"player_id": 20, "team_id": 20},
    "fact_match_results": {"event_id": 20, "home_team_id": 20, "away_team_id": 20,
                           "group_id": 20, "match_status": 20, "venue": 100},
}
NOT_NULL = {
    "dim_teams": ("team_id", "team_name"),
    "dim_players": ("player_id", "player_name"),
    "dim_groups": ("group_id", "group_name"),
    "dim_dates": ("date_id",),
    "fact_team_performance": ("team_id", "group_id", "date_id"),
    "fact_player_stats": ("player_id", "team_id", "date_id"),
    "fact_match_results": ("event_id", "home_team_id", "away_team_id", "group_id", "match_date"),
}
DECIMALS = {
    "dim_players": {"weight_kg": (5, 2), "height_cm": (5, 2), "bmi": (5, 2)},
    "fact_team_performance": {"points_per_game": (5, 2), "win_percentage": (5, 2),
                              "goals_per_game": (5, 2), "goals_conceded_per_game": (5, 2),
                              "performance_rating": (8, 2)},
    "fact_player_stats": {"pass_completion_rate": (5, 2)},
}


def _dec(x: Column | str, p: int, s: int) -> Column:
    return (F.col(x) if isinstance(x, str) else x).try_cast(f"decimal({p},{s})")


def _str(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("string")


def dim_teams(teams: DataFrame) -> DataFrame:
    """K1: one row per team from silver teams, newest snapshot wins; the
    nested logos become JSON text; ``team_is_active`` defaults to TRUE."""
    t = teams
    if "ingestion_timestamp" in t.columns:
        t = latest_snapshot(t, "ingestion_timestamp", by=["team_id"])
    cols = set(t.columns)

    def opt(name: str, typ: str = "string") -> Column:
        return F.col(name) if name in cols else F.lit(None).cast(typ).alias(name)

    logos = F.lit(None).cast("string")
    if "team_logos" in cols:  # JSON text already, or nested
        logos = F.col("team_logos") if dict(t.dtypes)["team_logos"] == "string" else F.to_json("team_logos")
    sel = t.select(
        _str("team_id").alias("team_id"),
        F.col("team_name"),
        opt("team_abbreviation"), opt("team_display_name"), opt("team_location"),
        opt("team_color"), opt("team_alternate_color"),
        F.coalesce(opt("team_is_active", "boolean"), F.lit(True)).alias("team_is_active"),
        logos.alias("team_logos"))
    # one row per key, deterministic: the greatest row (a partial aggregate,
    # so a key repeated in many snapshots is reduced map-side)
    return one_row_per_key(sel, ["team_id"])


def one_row_per_key(df: DataFrame, key: Sequence[str], newest: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """One row for each value of ``key``: the newest by the columns
    ``newest`` (which are dropped), of equals the greatest row. A partial
    aggregate, so a key repeated in many rows is reduced map-side. The column
    ``count``, if named, says how many rows the key had."""
    rest = [c for c in df.columns if c not in key and c not in newest]
    row = F.max(F.struct(*newest, *rest)).alias("_r")
    n = [F.count(F.lit(1)).alias(count)] if count else []
    return df.groupBy(*key).agg(row, *n).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest], *([count] if count else []))


def season_date(season: Column, day: str, start_month: int = 7) -> Column:
    """The date of a season's rows in a load of ``day``: that day for the
    season it lies in (and for rows of no season), the last day of the season
    for any other. ``season`` begins with its first year."""
    today = F.lit(day).cast("date")
    first = F.substring(season, 1, 4).try_cast("int")
    now = F.year(today) - F.when(F.month(today) < start_month, 1).otherwise(0)
    last = F.date_sub(F.make_date(first + 1, F.lit(start_month), F.lit(1)), 1)
    return F.when(first != now, last).otherwise(today)


def dim_players(players: DataFrame) -> DataFrame:
    """K2: from gold player analytics, one row per player, that of the newest
    season; DDL types (DECIMAL(5,2) via try_cast)."""
    cols = set(players.columns)

    def opt(name: str, typ: str = "string") -> Column:
        return F.col(name) if name in cols else F.lit(None).cast(typ).alias(name)

    rows = players.select(
        opt("season").alias("_season"),
        _str("athlete_id").alias("player_id"),
        F.col("player_name"),
        opt("player_display_name"),
        F.col("age").cast("int").alias("age"),
        _dec("weight_kg", 5, 2).alias("weight_kg"),
        _dec("height_cm", 5, 2).alias("height_cm"),
        opt("birth_place"), opt("nationality"), opt("position"),
        X.to_int(opt("jersey_number")).alias("jersey_number"),
        _str(opt("team_id")).alias("team_id"),
        F.col("age_group"),
        _dec("bmi", 5, 2).alias("bmi"),
    )
    return one_row_per_key(rows, ["player_id"], newest=["_season"])


def dim_groups(standings: DataFrame) -> DataFrame:
    """K3: distinct groups; the newest name per id (of names that are as
    new, the smallest)."""
    cols = set(standings.columns)
    if "ingestion_timestamp" in cols:
        standings = latest_snapshot(standings, "ingestion_timestamp", by=["group_id"])
    abbr = F.min("group_abbreviation") if "group_abbreviation" in cols else F.lit(None).cast("string")
    return (standings.groupBy(_str("group_id").alias("group_id"))
            .agg(F.min("group_name").alias("group_name"), abbr.alias("group_abbreviation")))


def season_label(d: Column, start_month: int = 7) -> Column:
    """'2024-25' style season of a date; seasons start in ``start_month``."""
    y = F.year(d) - F.when(F.month(d) < start_month, 1).otherwise(0)
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def dim_dates(lo: Column | str | _dt.date, hi: Column | str | _dt.date,
              source: DataFrame | None = None, season_start: int = 7) -> DataFrame:
    """K4: calendar rows for every day in ``[lo, hi]``.

    ``lo``/``hi`` are dates, or column expressions aggregated over
    ``source`` (e.g. ``F.min("date_id")``) so the range follows the data.
    The spine holds one row per day of the range: bounded by the calendar,
    not by the data volume."""
    if source is not None:
        bounds = source.agg(F.to_date(lo).alias("lo"), F.to_date(hi).alias("hi"))
    else:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        bounds = spark.range(1).select(F.to_date(F.lit(str(lo))).alias("lo"),
                                       F.to_date(F.lit(str(hi))).alias("hi"))
    d = F.col("date_id")
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date_id"))
    return days.select(
        d, F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"), F.weekofyear(d).alias("week"),
        F.dayofweek(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        season_label(d, season_start).alias("season"))


def fact_team_performance(summary: DataFrame, date_id: Column | str | _dt.date,
                          *, key: bool = True, start: int | Column = 0) -> DataFrame:
    """K5: gold team summary stamped with its snapshot date, DDL types."""
    d = date_id if isinstance(date_id, Column) else F.lit(str(date_id)).cast("date")
    f = summary.select(
        _str("team_id").alias("team_id"), _str("group_id").alias("group_id"),
        d.alias("date_id"),
        "games_played", "wins", "losses", "ties", "points",
        _dec("points_per_game", 5, 2).alias("points_per_game"),
        "goals_for", "goals_against", "goal_differential", "group_rank",
        F.col("overall_rank").cast("int").alias("overall_rank"),
        _dec("win_percentage", 5, 2).alias("win_percentage"),
        _dec("goals_per_game", 5, 2).alias("goals_per_game"),
        _dec("goals_conceded_per_game", 5, 2).alias("goals_conceded_per_game"),
        _dec("performance_rating", 8, 2).alias("performance_rating"))
    return surrogate_key(f, name="performance_id", start=start) if key else f


def next_key(table: DataFrame, name: str) -> Column:
    """Where the identity of the next load of ``table`` starts: behind the
    greatest key so far (a scalar subquery)."""
    return table.select(F.coalesce(F.max(name) + 1, F.lit(0).cast("bigint"))).scalar()


def audited(df: DataFrame, ts: str) -> DataFrame:
    """The audit columns that every table of the warehouse carries."""
    stamp = F.lit(ts).cast("timestamp_ntz")
    return df.withColumns({"created_at": stamp, "updated_at": stamp})


PLAYER_STAT_COLUMNS = ("games_played", "goals", "assists", "yellow_cards", "red_cards",
                       "minutes_played", "shots", "shots_on_target", "pass_completion_rate")


def fact_player_stats(stats: DataFrame, *, key: bool = True, start: int | Column = 0) -> DataFrame:
    """K6: player statistics. Accepts the wide form, or the long form
    ``(player_id, team_id, date_id, stat_name, stat_value)`` of the silver
    layer, which is pivoted with an explicit name list: a maximum a name in
    one grouped pass (no discovery job, and one shuffle: ``pivot`` groups by
    key and name first, then by key).
    Of repeated snapshots the newest counts."""
    s = stats
    if "ingestion_timestamp" in s.columns:
        s = latest_snapshot(s, "ingestion_timestamp", by=["player_id", "team_id", "date_id"])
    if "stat_name" in s.columns:
        keys = ["player_id", "team_id", "date_id"]
        s = s.groupBy(*keys).agg(*(F.max(F.when(F.col("stat_name") == c, F.col("stat_value"))).alias(c)
                                   for c in PLAYER_STAT_COLUMNS))
    cols = set(s.columns)
    out = [_str("player_id").alias("player_id"), _str("team_id").alias("team_id"),
           F.col("date_id").try_cast("date").alias("date_id")]
    for c in PLAYER_STAT_COLUMNS:  # all of them, whatever the input carries
        value = F.col(c) if c in cols else F.lit(None).cast("string")
        out.append((_dec(value, 5, 2) if c == "pass_completion_rate" else X.to_int(value)).alias(c))
    f = s.select(*out)
    return surrogate_key(f, name="stat_id", start=start) if key else f


def fact_match_results(events: DataFrame, *, key: bool = True, start: int | Column = 0) -> DataFrame:
    """K7: one row per match from silver events, newest snapshot per event.

    Home and away sides are picked out of the ``competitors`` array by their
    place in it on each row: no explode + regroup, hence no shuffle. Scores are ``try_cast`` (a missing score stays NULL)."""
    if "ingestion_timestamp" in events.columns:
        events = latest_snapshot(events, "ingestion_timestamp", by=["event_id"])
    comp = F.explode("event_competitions").alias("c")
    text = dict(events.dtypes)["event_status"] == "string"  # JSON text, or nested
    status = F.get_json_object("event_status", "$.name") if text else F.col("event_status.name")
    e = events.select("event_id", "event_date", "event_status", comp)
    # an event may have several competitions: the group tells them apart

    def side(which: str) -> Column:
        at = F.array_position("c.competitors.homeAway", which)  # 0 if there is none, which gets NULL
        return F.get("c.competitors", (at - 1).cast("int"))

    f = e.select(
        _str("event_id").alias("event_id"),
        side("home")["teamId"].alias("home_team_id"),
        side("away")["teamId"].alias("away_team_id"),
        F.col("c.groupId").alias("group_id"),
        F.col("event_date").try_cast("date").alias("match_date"),
        X.to_int(side("home")["score"]).alias("home_score"),
        X.to_int(side("away")["score"]).alias("away_score"),
        status.alias("match_status"),
        F.col("c.attendance").try_cast("int").alias("attendance"),
        F.col("c.venue").alias("venue"))
    return surrogate_key(f, name="match_id", start=start) if key else f


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str], *,
           ts: str, created_col: str = "created_at",
           updated_col: str = "updated_at") -> DataFrame:
    """K9: reload a table. Incoming values win; ``created_at`` is kept from
    the existing row (or stamped ``ts`` for new keys); ``updated_at`` is
    ``ts`` for every incoming key and kept for untouched rows.

    A full outer join on the key (sort-merge; AQE splits skewed keys). The
    caller writes the result to a *new* version folder, never over the
    input being read."""
    key = list(key)
    audit = (created_col, updated_col)
    # columns of either side stay: those that only the table has keep their
    # values, those that only the load has are NULL in untouched rows
    new_cols = [c for c in incoming.columns if c not in key and c not in audit]
    old_cols = [c for c in existing.columns if c not in key and c not in audit]
    stamp = F.lit(ts).cast(existing.schema[created_col].dataType)
    old = existing.select(*key, *[F.col(c).alias(f"_old_{c}") for c in old_cols],
                          F.col(created_col).alias("_old_created"),
                          F.col(updated_col).alias("_old_updated"))
    new = incoming.select(*key, *[F.col(c).alias(f"_new_{c}") for c in new_cols],
                          F.lit(True).alias("_new"))
    j = old.join(new, key, "full_outer")
    is_new = F.col("_new").isNotNull()

    def merged(c: str) -> Column:
        if c not in new_cols:
            return F.col(f"_old_{c}")
        if c not in old_cols:
            return F.col(f"_new_{c}")
        return F.when(is_new, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}"))

    return j.select(
        *key, *[merged(c).alias(c) for c in [*new_cols, *(c for c in old_cols if c not in new_cols)]],
        F.coalesce(F.col("_old_created"), stamp).alias(created_col),
        F.when(is_new, stamp).otherwise(F.col("_old_updated")).alias(updated_col))
