"""League-shaped views over the driver's TPC-H-style tables (FIXTURES.md §C).

The competition model (groups, teams, athletes, matches, facts, logs and
metrics) is bound to the benchmark tables as follows:

* group = nation, team = supplier, athlete = customer, match = line item
  between a customer nation (home) and a supplier nation (away);
* logs and metrics come from ``events``.

Everything is expressed with the DataFrame API. Big inputs are aggregated
*before* they meet a dimension (a team's totals only depend on
``l_suppkey``), so each join sees one row per key instead of one per line
item. ``nation``/``region`` are broadcast by hint because TPC-H fixes their
size (25 and 5 rows) at every scale factor; every other join is left to the
optimizer and AQE, which broadcast only when the runtime size is under
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchline.operators.joins import broadcast_fixed
from pitchline.operators.ranking import rank_within
from pitchline.sources.tables import Tables

# The ten stat names of a standings entry, in payload order.
STAT_NAMES = ("gamesPlayed", "wins", "losses", "ties", "points",
              "pointsPerGame", "goalsFor", "goalsAgainst", "goalDifferential",
              "rank")


def _count_flag(flag: str) -> Column:
    return F.count(F.when(F.col("l_returnflag") == flag, 1))


def t1_base(t: Tables) -> DataFrame:
    """One row per team (supplier) in its group (nation) with raw totals."""
    per_team = (t.lineitem
                .groupBy("l_suppkey")
                .agg(F.count(F.lit(1)).alias("_games"),
                     _count_flag("A").alias("_wins"),
                     _count_flag("R").alias("_losses"),
                     _count_flag("N").alias("_ties"),
                     F.sum("l_linenumber").alias("_gf"),
                     F.sum(F.col("l_quantity").cast("int") % 8).alias("_ga")))
    teams = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    groups = broadcast_fixed(t.nation.select("n_nationkey", "n_name"))
    joined = (per_team.join(teams, per_team.l_suppkey == teams.s_suppkey)
              .join(groups, teams.s_nationkey == groups.n_nationkey))
    return joined.select(
        F.col("n_nationkey").alias("group_id"),
        F.col("n_name").alias("group_name"),
        F.col("s_suppkey").alias("team_id"),
        F.col("s_name").alias("team_name"),
        F.col("_games").cast("double").alias("gamesPlayed"),
        F.col("_wins").cast("double").alias("wins"),
        F.col("_losses").cast("double").alias("losses"),
        F.col("_ties").cast("double").alias("ties"),
        (F.col("_wins") * 3 + F.col("_ties")).cast("double").alias("points"),
        F.col("_gf").cast("double").alias("goalsFor"),
        F.col("_ga").cast("double").alias("goalsAgainst"),
    )


def t1_wide(t: Tables, rank: bool = True) -> DataFrame:
    """T1 with the derived stats (points per game, goal difference, rank).
    ``rank=False`` leaves the rank out: it is the only part that sorts and
    writes, so it is built only for consumers that read it."""
    base = t1_base(t).withColumns({
        "pointsPerGame": F.round(F.col("points") / F.col("gamesPlayed"), 4),
        "goalDifferential": F.col("goalsFor") - F.col("goalsAgainst"),
    })
    if not rank:
        return base
    base = rank_within(base, by=["group_id"],
                       order=[F.col("points").desc(),
                              F.col("goalDifferential").desc(),
                              F.col("team_id").asc()],
                       name="_rank")
    return base.withColumn("rank", F.col("_rank").cast("double")).drop("_rank")


def t1_standings_long(t: Tables, rank: bool = True) -> DataFrame:
    """The exploded ``(stat_name, stat_value)`` form of T1: input of E1."""
    names = [n for n in STAT_NAMES if rank or n != "rank"]
    return t1_wide(t, rank).unpivot(["group_id", "group_name", "team_id", "team_name"],
                                    names, "stat_name", "stat_value")


def t3_athletes(t: Tables) -> DataFrame:
    """Athletes (customers) with injected nulls; team columns stay flat."""
    k = F.col("c_custkey")

    def unless(mod: int, value: Column) -> Column:
        return F.when(k % mod == 0, F.lit(None)).otherwise(value)

    nation = broadcast_fixed(t.nation.select("n_nationkey", "n_name"))
    cust = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey).select(
        k.alias("athlete_id"),
        F.col("c_name").alias("athlete_full_name"),
        unless(19, (F.lit(16) + k % 25).cast("int")).alias("athlete_age"),
        unless(13, (F.lit(60) + k % 40).cast("double")).alias("athlete_weight"),
        unless(11, (F.lit(160) + k % 37).cast("double")).alias("athlete_height"),
        unless(17, F.concat(F.lit("NATION_"), (k % 7).cast("string"))).alias("athlete_nationality"),
        F.col("c_mktsegment").alias("athlete_position"),
        unless(23, F.col("c_nationkey")).alias("team_id"),
        F.col("n_name").alias("team_name"),
    )


def t4_matches(t: Tables, venue: bool = False) -> DataFrame:
    """Matches: one per line item whose customer and supplier nations differ
    (a team does not play itself, so the other line items are no matches).
    ``venue=True`` adds the venue, which needs a join with ``part``."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                           "l_quantity", "l_shipdate")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    cust = t.customer.select("c_custkey", "c_nationkey")
    supp = t.supplier.select("s_suppkey", "s_nationkey")
    home = broadcast_fixed(t.nation.select(F.col("n_nationkey").alias("h_nationkey"),
                                           F.col("n_regionkey").alias("h_regionkey")))
    # home side: order -> customer -> nation (nation broadcast, fixed size)
    home_of_order = (orders.join(cust, orders.o_custkey == cust.c_custkey)
                     .join(home, F.col("c_nationkey") == F.col("h_nationkey"))
                     .select("o_orderkey", "o_orderstatus", "h_nationkey", "h_regionkey"))
    extra = []
    if venue:
        part = t.part.select("p_partkey", "p_brand")
        li = li.join(part, li.l_partkey == part.p_partkey)
        extra = [F.col("p_brand").alias("venue")]
    # the order comes last: what is grouped by event then lies together already
    m = (li.join(supp, li.l_suppkey == supp.s_suppkey)
         .join(home_of_order, li.l_orderkey == home_of_order.o_orderkey)
         .where(F.col("h_nationkey") != F.col("s_nationkey")))
    return m.select(
        F.col("l_orderkey").alias("event_id"),
        F.col("h_nationkey").alias("home_team_id"),
        F.col("s_nationkey").alias("away_team_id"),
        F.col("h_regionkey").alias("group_id"),
        F.col("l_shipdate").cast("date").alias("match_date"),
        (F.col("l_linenumber") - 1).cast("int").alias("home_score"),
        (F.col("l_quantity").cast("int") % 5).alias("away_score"),
        F.col("o_orderstatus").alias("match_status"),
        (F.col("l_partkey") % 1000).cast("int").alias("attendance"),
        *extra)


def t5_fact_team_performance(t: Tables) -> DataFrame:
    """One snapshot per team and ship year (date_id = Dec 31 of the year)."""
    per = (t.lineitem
           .groupBy("l_suppkey", F.year("l_shipdate").alias("_y"))
           .agg(F.count(F.lit(1)).alias("games_played"),
                _count_flag("A").alias("wins"),
                _count_flag("N").alias("_ties"),
                F.sum("l_linenumber").cast("bigint").alias("goals_for")))
    supp = t.supplier.select("s_suppkey", "s_nationkey")
    return per.join(supp, per.l_suppkey == supp.s_suppkey).select(
        F.col("s_suppkey").alias("team_id"),
        F.col("s_nationkey").alias("group_id"),
        F.make_date(F.col("_y"), F.lit(12), F.lit(31)).alias("date_id"),
        "games_played", "wins",
        (F.col("wins") * 3 + F.col("_ties")).alias("points"),
        "goals_for",
    )


def t6_fact_player_stats(t: Tables) -> DataFrame:
    """One player-stat row per order."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = t.customer.select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_custkey").alias("player_id"),
        F.col("c_nationkey").alias("team_id"),
        F.col("o_orderdate").cast("date").alias("date_id"),
        F.lit(1).alias("games_played"),
        (F.col("o_orderkey") % 4).cast("int").alias("goals"),
        (F.col("o_orderkey") % 3).cast("int").alias("assists"),
    )


def t7_logs(t: Tables) -> DataFrame:
    """Application log lines: a third of them with a duration, a third with
    a processing time."""
    kind = (F.when(F.col("event_id") % 3 == 0, " duration ").when(F.col("event_id") % 3 == 1, " processing time ")
            .otherwise(" size "))
    return t.events.select(
        "event_id", "ts", F.concat(F.upper("event_type"), kind, F.col("props")).alias("message"),
        F.col("user_id").alias("log_stream"))


def t8_metrics(t: Tables) -> DataFrame:
    """Metric samples ``(ts, metric_name, value)``; the values carry two
    decimals, so as decimals their sums do not depend on the order."""
    return t.events.select("ts", F.col("event_type").alias("metric_name"),
                           F.col("value").cast("decimal(18,2)").alias("value"))


def teams_silver(t: Tables) -> DataFrame:
    """Silver teams bound to suppliers; ``team_is_active`` is NULL for a
    negative balance (the DDL default then applies)."""
    nation = broadcast_fixed(t.nation.select("n_nationkey", "n_name"))
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return s.join(nation, s.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("team_id"),
        F.col("s_name").alias("team_name"),
        F.col("s_name").alias("team_display_name"),
        F.col("n_name").alias("team_location"),
        F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal") > 1000).alias("team_is_active"))


def event_matches(t: Tables) -> DataFrame:
    """The matches of the silver events before they are nested: columns in
    the order in which the nested rows compare, texts as texts, so that the
    greatest row of an event is the same before and after."""
    texts = ("group_id", "home_team_id", "home_score", "away_team_id", "away_score")
    return t4_matches(t, venue=True).select("event_id", "match_date", "match_status", "venue", "attendance",
                                            *(F.col(c).cast("string").alias(c) for c in texts))


def nested_events(matches: DataFrame) -> DataFrame:
    """Silver events from :func:`event_matches`: the nested competition
    payload (our schema, FIXTURES A4/A5) with home and away competitors."""
    def competitor(side: str) -> Column:
        return F.struct(F.lit(side).alias("homeAway"), F.col(f"{side}_team_id").alias("teamId"), F.col(f"{side}_score").alias("score"))

    competition = F.struct("venue", "attendance", F.col("group_id").alias("groupId"),
                           F.array(competitor("home"), competitor("away")).alias("competitors"))
    return matches.select(
        "event_id",
        F.date_format("match_date", "yyyy-MM-dd'T'HH:mm'Z'").alias("event_date"),
        F.struct(F.col("match_status").alias("name")).alias("event_status"),
        F.array(competition).alias("event_competitions"))


def events_silver(t: Tables) -> DataFrame:
    """Silver events built from T4, one a match."""
    return nested_events(event_matches(t))


# Envelope of the bronze documents built from the tables.
BRONZE_TS, BRONZE_SOURCE, BRONZE_VERSION = "2024-07-01T00:00:00", "api", "1.0"


def _metadata() -> Column:
    return F.struct(F.lit(BRONZE_TS).alias("ingestion_timestamp"),
                    F.lit(BRONZE_SOURCE).alias("source"), F.lit(BRONZE_VERSION).alias("version"))


def standings_documents(t: Tables, wide: DataFrame | None = None) -> DataFrame:
    """Bronze standings documents, one per team (groups → entries → stats);
    every array holds a bounded number of elements. ``wide``: other rows
    than those of T1."""
    w = t1_wide(t) if wide is None else wide
    none = F.lit(None).cast("string")
    stats = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("double").alias("value"))
                      for n in STAT_NAMES])
    team = F.struct(F.col("team_id").cast("string").alias("id"), F.col("team_name").alias("name"),
                    none.alias("abbreviation"))
    entry = F.struct(team.alias("team"), stats.alias("stats"))
    group = F.struct(F.col("group_id").cast("string").alias("id"), F.col("group_name").alias("name"),
                     none.alias("abbreviation"),
                     F.struct(F.array(entry).alias("entries")).alias("standings"))
    return w.select(_metadata().alias("metadata"),
                    F.struct(F.array(group).alias("children")).alias("data"))


def teams_documents(t: Tables) -> DataFrame:
    """Bronze teams documents, one team item per document."""
    nation = broadcast_fixed(t.nation.select("n_nationkey", "n_name"))
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    j = s.join(nation, s.s_nationkey == nation.n_nationkey)
    sid = F.col("s_suppkey").cast("string")
    none = F.lit(None).cast("string")
    href = "array<struct<href:string>>"
    item = F.struct(sid.alias("id"), F.concat(F.lit("s:"), sid).alias("uid"),
                    F.lower("s_name").alias("slug"), F.col("n_name").alias("location"),
                    F.col("s_name").alias("name"), none.alias("abbreviation"),
                    F.col("s_name").alias("displayName"), F.col("s_name").alias("shortDisplayName"),
                    none.alias("color"), none.alias("alternateColor"),
                    (F.col("s_acctbal") >= 0).alias("isActive"),
                    F.array(F.struct(F.concat(F.lit("/logos/"), sid).alias("href"))).alias("logos"),
                    F.lit(None).cast(href).alias("links"))
    return j.select(_metadata().alias("metadata"), F.struct(F.array(item).alias("items")).alias("data"))
