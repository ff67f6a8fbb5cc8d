"""Registered queries: each SURVEY §2 key as ``(spark, sf_dir) -> DataFrame``
over the driver's tables bound through the league adapter views."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.functions import exprs as X
from pitchline.operators import filters as Flt
from pitchline.operators import joins as J
from pitchline.operators import ranking as R
from pitchline.operators.audit import with_audit
from pitchline.operators.joins import broadcast_fixed
from pitchline.operators.reshape import pivot_stats
from pitchline.plans import dashboards as D
from pitchline.plans import gold
from pitchline.plans import monitoring as M
from pitchline.plans import quality as Q
from pitchline.plans import silver as S
from pitchline.plans import views as V
from pitchline.plans import warehouse as W
from pitchline.sinks import files as Out
from pitchline.sources import adapters as A
from pitchline.sources import bronze
from pitchline.sources.tables import Tables, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Injected audit timestamp, so audit columns are reproducible.
AUDIT_TS = "2024-07-01T00:00:00"


def query(fn=None, *, name: str | None = None):
    """Register ``fn(tables)`` under ``name`` (default: the function name)."""
    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Tables(spark, sf_dir))
        run.__name__ = f.__name__
        run.__doc__ = f.__doc__
        QUERIES[name or f.__name__] = run
        return f
    return register(fn) if fn is not None else register


def standings(t: Tables, rank: bool = False) -> DataFrame:
    """Silver standings (E1 applied to the long form); with the rank
    within the group only for those who read it."""
    names = [n for n in A.STAT_NAMES if rank or n != "rank"]
    return pivot_stats(A.t1_standings_long(t, rank), names)


def athletes(t: Tables) -> DataFrame:
    """T3 with the team wrapped in the silver ``athlete_team`` struct."""
    a = A.t3_athletes(t)
    team = F.struct(F.col("team_id").cast("string").alias("id"),
                    F.col("team_name").alias("name"),
                    F.lit(None).cast("string").alias("abbreviation"))
    return a.withColumn("athlete_team", F.when(F.col("team_id").isNotNull(), team)).drop(
        "team_id", "team_name")


# ---------------------------------------------------------------- gold ---

@query(name="pivot_stats")
def pivot_stats_q(t: Tables) -> DataFrame:
    return standings(t, rank=True)


@query
def team_performance_summary(t: Tables) -> DataFrame:
    return gold.team_performance_summary(standings(t, rank=True))


@query
def competition_overview(t: Tables) -> DataFrame:
    return gold.competition_overview(standings(t))


@query
def group_analysis(t: Tables) -> DataFrame:
    return gold.group_analysis(standings(t))


@query
def team_roster_summary(t: Tables) -> DataFrame:
    return gold.team_roster_summary(athletes(t), sets="string")


@query
def player_analytics(t: Tables) -> DataFrame:
    return gold.player_analytics(athletes(t)).drop("team_info")


# ------------------------------------------------- scalar expressions ---

@query
def age_bucket(t: Tables) -> DataFrame:
    """C15's bucketing bound to ``part.p_size``."""
    return t.part.select("p_partkey", "p_size", X.age_group("p_size").alias("age_group"))


@query
def bmi(t: Tables) -> DataFrame:
    a = A.t3_athletes(t)
    return a.select("athlete_id", X.bmi("athlete_weight", "athlete_height").alias("bmi"))


@query
def cast_safe(t: Tables) -> DataFrame:
    """Numeric casts of raw strings; junk becomes NULL, never an error."""
    e = t.events
    return e.select(
        "event_id",
        X.to_int(F.get_json_object("props", "$.k")).alias("k_int"),
        X.to_int("event_type").alias("type_int"),
        X.to_double(F.col("value").cast("string")).alias("value_double"),
        X.to_bigint(F.concat(F.col("user_id").cast("string"), F.lit("x"))).alias("junk_bigint"))


@query
def kpi_points_per_game(t: Tables) -> DataFrame:
    s = standings(t)
    return s.select("team_id", X.safe_ratio("points", "gamesPlayed").alias("points_per_game"))


@query
def expected_points(t: Tables) -> DataFrame:
    s = standings(t)
    gd = X.to_int("goalDifferential")
    return s.select("team_id", gd.alias("goal_differential"),
                    X.expected_points(gd).alias("expected_points"))


@query
def qualification_status(t: Tables) -> DataFrame:
    s = standings(t, rank=True)
    r = X.to_int("rank")
    return s.select("group_id", "team_id", r.alias("group_rank"),
                    X.qualification(r).alias("qualification_status"))


@query
def match_outcome(t: Tables) -> DataFrame:
    m = A.t4_matches(t)
    return m.select("event_id", "home_team_id", "away_team_id", "home_score", "away_score",
                    X.outcome("home_score", "away_score").alias("outcome"))


@query
def team_stats_table(t: Tables) -> DataFrame:
    """Dashboard table: team, games, W-D-L record, points, GF, GA, GD."""
    p = gold.team_performance_summary(standings(t), rank=False)
    return p.select("team_id", "team_name", "games_played",
                    X.wdl("wins", "ties", "losses").alias("record"), "points",
                    "goals_for", "goals_against", "goal_differential")


@query
def audit_columns(t: Tables) -> DataFrame:
    s = standings(t).select("group_id", "team_id", "points")
    return with_audit(s, "silver", "standings", ts=AUDIT_TS)


# ----------------------------------------------------------- filters ---

@query
def filter_not_null(t: Tables) -> DataFrame:
    a = A.t3_athletes(t)
    return Flt.require_not_null(a, "athlete_age", "athlete_weight").select(
        "athlete_id", "athlete_age", "athlete_weight")


@query
def having_filter(t: Tables) -> DataFrame:
    """Filter on a group key after the aggregate (pushed below it)."""
    a = A.t3_athletes(t)
    return (a.groupBy("team_id").agg(F.count(F.lit(1)).alias("players"))
            .where(F.col("team_id").isNotNull()))


@query
def latest_snapshot(t: Tables) -> DataFrame:
    """D3: the newest date comes from the dates of the line items alone; as a
    value it filters them before anything is summed or joined."""
    newest = t.lineitem.select(F.make_date(F.max(F.year("l_shipdate")), F.lit(12), F.lit(31))).first()[0]
    return Flt.latest_snapshot(A.t5_fact_team_performance(t), "date_id", newest=F.lit(newest))


# --------------------------------------------------------- warehouse ---

SNAPSHOT_DATE = "2024-12-31"


def player_dim(t: Tables) -> DataFrame:
    return W.dim_players(gold.player_analytics(athletes(t)))


@query
def dim_teams(t: Tables) -> DataFrame:
    return W.audited(W.dim_teams(A.teams_silver(t)), AUDIT_TS)


@query
def dim_players(t: Tables) -> DataFrame:
    return W.audited(player_dim(t), AUDIT_TS)


@query
def dim_groups(t: Tables) -> DataFrame:
    return W.audited(W.dim_groups(standings(t)), AUDIT_TS)


@query
def dim_dates(t: Tables) -> DataFrame:
    """Calendar over the span of the player-stat facts."""
    return W.audited(W.dim_dates(F.min("date_id"), F.max("date_id"), source=A.t6_fact_player_stats(t)), AUDIT_TS)


# Fact loads carry an identity key (unique, engine-assigned); the compared
# projection leaves it out, and tests check it is unique.

@query
def fact_team_performance(t: Tables) -> DataFrame:
    f = W.fact_team_performance(gold.team_performance_summary(standings(t, rank=True)), SNAPSHOT_DATE)
    return W.audited(f.drop("performance_id"), AUDIT_TS)


@query
def fact_player_stats(t: Tables) -> DataFrame:
    return W.audited(W.fact_player_stats(A.t6_fact_player_stats(t)).drop("stat_id"), AUDIT_TS)


@query
def fact_match_results(t: Tables) -> DataFrame:
    return W.audited(W.fact_match_results(A.events_silver(t)).drop("match_id"), AUDIT_TS)


@query
def surrogate_key(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_orderdate")
    return R.surrogate_key(o, [F.col("o_orderdate"), F.col("o_orderkey")], "order_sk", dense=True)


@query
def upsert(t: Tables) -> DataFrame:
    """Reload per-team totals: the existing load covers ship dates before
    1998, the incoming one from 1997 on; overlapping teams are updated."""
    li = t.lineitem.select("l_suppkey", "l_shipdate", "l_quantity")

    def load(cond: Column, ts: str) -> DataFrame:
        return (li.where(cond).groupBy(F.col("l_suppkey").alias("team_id"))
                .agg(F.count(F.lit(1)).alias("games"),
                     F.sum(F.col("l_quantity").cast("int")).cast("bigint").alias("quantity"))
                .withColumns({"created_at": F.lit(ts).cast("timestamp_ntz"),
                              "updated_at": F.lit(ts).cast("timestamp_ntz")}))

    existing = load(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"),
                    "2024-01-01 00:00:00")
    incoming = load(F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"),
                    "2024-06-01 00:00:00").drop("created_at", "updated_at")
    return W.upsert(existing, incoming, ["team_id"], ts="2024-06-01 00:00:00")


# -------------------------------------------------------------- views ---

def team_dim(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").cast("string").alias("team_id"), F.col("s_name").alias("team_name"))


def group_dim(t: Tables) -> DataFrame:
    return broadcast_fixed(t.nation.select(F.col("n_nationkey").cast("string").alias("group_id"),
                                           F.col("n_name").alias("group_name")))


def stored_fact(t: Tables) -> DataFrame:
    """The newest snapshot of the stored team fact, which is partitioned by
    date and holds two: the newest one, and a year before it one in which
    nobody had a point. Written in one pass, read by partition."""
    from pitchline.sinks import versions

    root = _scratch(t, "fact")
    new = W.fact_team_performance(gold.team_performance_summary(standings(t, rank=True)), SNAPSHOT_DATE, key=False)
    new = new.withColumn("old", F.explode(F.array(F.lit(False), F.lit(True)))).withColumns({
        "date_id": F.when(F.col("old"), F.add_months("date_id", -12)).otherwise(F.col("date_id")),
        "points": F.when(F.col("old"), 0).otherwise(F.col("points"))}).drop("old")
    versions.write_version(new, root, "fact_team_performance", "1", None, ["date_id"])
    return versions.read_newest(t.spark, root, "fact_team_performance", "date_id")


@query
def v_team_performance(t: Tables) -> DataFrame:
    return V.v_team_performance_summary(stored_fact(t), team_dim(t), group_dim(t), newest=False)


@query
def v_group_standings(t: Tables) -> DataFrame:
    return V.v_group_standings(stored_fact(t), team_dim(t), group_dim(t), newest=False)


@query
def v_recent_matches(t: Tables) -> DataFrame:
    nations = broadcast_fixed(t.nation.select(F.col("n_nationkey").alias("team_id"),
                                              F.col("n_name").alias("team_name")))
    regions = broadcast_fixed(t.region.select(F.col("r_regionkey").alias("group_id"),
                                              F.col("r_name").alias("group_name")))
    return V.v_recent_matches(A.t4_matches(t, venue=True), nations, regions, n=20)


@query
def top_scorers(t: Tables) -> DataFrame:
    players = t.customer.select(F.col("c_custkey").alias("player_id"),
                                F.col("c_name").alias("player_name"),
                                F.col("c_mktsegment").alias("position"))
    teams = broadcast_fixed(t.nation.select(F.col("n_nationkey").alias("team_id"),
                                            F.col("n_name").alias("team_name")))
    return V.top_scorers(A.t6_fact_player_stats(t), players, teams)


@query
def data_quality_check(t: Tables) -> DataFrame:
    return V.data_quality_check(W.dim_teams(A.teams_silver(t)), player_dim(t),
                                A.t5_fact_team_performance(t))


@query
def table_metrics(t: Tables) -> DataFrame:
    stamp = {"created_at": F.lit(AUDIT_TS).cast("timestamp_ntz")}
    return V.table_metrics(A.t5_fact_team_performance(t).withColumns(stamp),
                           A.t6_fact_player_stats(t).withColumns(stamp))


@query
def fk_violations(t: Tables) -> DataFrame:
    """Player-stat facts whose player is missing from the player dimension."""
    dim = player_dim(t).select(F.col("player_id").cast("bigint").alias("player_id"))
    return J.fk_violations(A.t6_fact_player_stats(t), dim, ["player_id"])


@query
def fk_conform(t: Tables) -> DataFrame:
    dim = player_dim(t).select(F.col("player_id").cast("bigint").alias("player_id"))
    return J.conform(A.t6_fact_player_stats(t), dim, ["player_id"])


# --------------------------------------------------------- dashboards ---

@query
def kpi_cards(t: Tables) -> DataFrame:
    return D.kpi_cards(standings(t))


@query
def goals_distribution(t: Tables) -> DataFrame:
    return D.goals_distribution(standings(t))


@query
def performance_trend(t: Tables) -> DataFrame:
    return D.performance_trend(A.t5_fact_team_performance(t))


@query
def age_distribution(t: Tables) -> DataFrame:
    return D.age_distribution(gold.player_analytics(athletes(t)))


@query
def team_composition(t: Tables) -> DataFrame:
    return D.team_composition(gold.player_analytics(athletes(t)))


@query
def venue_analysis(t: Tables) -> DataFrame:
    return D.venue_analysis(A.t4_matches(t, venue=True))


@query
def score_distribution(t: Tables) -> DataFrame:
    return D.score_distribution(A.t4_matches(t))


@query
def fixture_calendar(t: Tables) -> DataFrame:
    return D.fixture_calendar(A.t4_matches(t))


@query
def head_to_head(t: Tables) -> DataFrame:
    return D.head_to_head(A.t4_matches(t))


@query
def team_form(t: Tables) -> DataFrame:
    return D.team_form(A.t4_matches(t), n=5)


@query
def team_vs_average(t: Tables) -> DataFrame:
    return D.team_vs_average(gold.team_performance_summary(standings(t), rank=False), digits=6)


@query
def top_performers(t: Tables) -> DataFrame:
    return D.top_performers(A.t6_fact_player_stats(t), "goals", k=10)


@query
def param_filters(t: Tables) -> DataFrame:
    """Season 1996-97 (D6), some groups and home teams (D7), finished or
    open matches only (D9 match-type parameter)."""
    m = A.t4_matches(t, venue=True).withColumn("season", W.season_label(F.col("match_date")))
    return Flt.param_filters(m, season="1996-97", groups=[0, 1, 3], teams=[0, 1, 2, 3, 5, 8, 13, 21],
                             team_col="home_team_id", extra={"match_status": ["F", "O"]})


@query
def last_n_days(t: Tables) -> DataFrame:
    """The days up to the newest match. A first pass without the venues
    finds that day; as a value it filters the line items of the second one
    before they are joined."""
    newest = A.t4_matches(t).agg(F.max("match_date")).first()[0]
    return Flt.last_n_days(A.t4_matches(t, venue=True), "match_date", days=30, as_of=newest)


# ------------------------------------------------------------ quality ---

@query
def dq_row_count(t: Tables) -> DataFrame:
    """Q1: the row-count bound of each entity suite."""
    return (Q.run_suite(standings(t), "standings", [Q.row_count_between(1, 100)])
            .unionByName(Q.run_suite(A.teams_silver(t), "teams", [Q.row_count_between(1, 50)]))
            .unionByName(Q.run_suite(A.t3_athletes(t), "athletes", [Q.row_count_between(1, 1000)])))


@query
def dq_not_null(t: Tables) -> DataFrame:
    return Q.run_suite(A.t3_athletes(t), "athletes",
                       [Q.not_null("athlete_id"), Q.not_null("athlete_age"),
                        Q.not_null("athlete_nationality")])


ATHLETE_SUITE = [Q.row_count_between(1, 1000), Q.column_exists("athlete_id"),
                 Q.column_exists("athlete_team.id"), Q.column_exists("data.id"),
                 Q.not_null("athlete_id"), Q.completeness("athlete_age", Q.COMPLETENESS_THRESHOLD),
                 Q.in_range("athlete_age", 18, 38), Q.unique("athlete_id")]


@query
def dq_suite(t: Tables) -> DataFrame:
    """Q4: a whole suite in one aggregate pass (+ one grouped count for
    uniqueness)."""
    return Q.run_suite(athletes(t), "athletes", ATHLETE_SUITE)


@query
def dq_completeness(t: Tables) -> DataFrame:
    cols = ["athlete_age", "athlete_weight", "athlete_height", "athlete_nationality", "team_id"]
    return Q.run_suite(A.t3_athletes(t), "athletes",
                       [Q.completeness(c, Q.COMPLETENESS_THRESHOLD) for c in cols])


@query
def dq_uniqueness(t: Tables) -> DataFrame:
    return (Q.run_suite(t.orders, "orders", [Q.unique("o_orderkey")])
            .unionByName(Q.run_suite(A.t6_fact_player_stats(t), "player_stats",
                                     [Q.unique("player_id", "date_id")]))
            .unionByName(Q.run_suite(t.lineitem, "lineitem", [Q.unique("l_orderkey", "l_linenumber")])))


@query
def dq_range(t: Tables) -> DataFrame:
    return Q.run_suite(A.t4_matches(t), "matches",
                       [Q.in_range("home_score", 0, 5), Q.in_range("away_score", 0, 3),
                        Q.in_range("attendance", 1, 999)])


@query
def dq_format(t: Tables) -> DataFrame:
    ev = Q.run_suite(A.events_silver(t), "events",
                     [Q.matches_format("event_date", "yyyy-MM-dd'T'HH:mm'Z'")])
    logs = Q.run_suite(t.events, "event_log",
                       [Q.matches_regex("props", r'^\{"k": [0-9]+\}$'),
                        Q.matches_regex("event_type", "^[a-z]+$")])
    return ev.unionByName(logs)


@query
def dq_ddl_contract(t: Tables) -> DataFrame:
    """Q11: DDL contract of dim_players and fact_team_performance checked on
    the values before the typed load."""
    p = gold.player_analytics(athletes(t)).withColumn(
        "player_id", F.col("athlete_id").cast("string"))
    f = gold.team_performance_summary(standings(t), rank=False).withColumns(
        {"team_id": F.col("team_id").cast("string"), "group_id": F.col("group_id").cast("string")})
    return (Q.ddl_violations(p, "dim_players", W.NOT_NULL["dim_players"],
                             W.VARCHAR_LIMITS["dim_players"], W.DECIMALS["dim_players"])
            .unionByName(Q.ddl_violations(f, "fact_team_performance",
                                          W.NOT_NULL["fact_team_performance"],
                                          W.VARCHAR_LIMITS["fact_team_performance"],
                                          W.DECIMALS["fact_team_performance"])))


# --------------------------------------------------------- monitoring ---

@query
def error_logs(t: Tables) -> DataFrame:
    return M.error_logs(A.t7_logs(t))


@query
def perf_logs(t: Tables) -> DataFrame:
    return M.perf_logs(A.t7_logs(t))


@query
def metric_windows(t: Tables) -> DataFrame:
    return M.metric_windows(A.t8_metrics(t), 300)


@query
def alarm_missing_window(t: Tables) -> DataFrame:
    """Pipeline-style alarm (sum < 1, missing = breaching) on 300 s periods
    of January 2024 (the 6 h period of the monitor is always filled by this
    data): all metrics stop before its end, ``heartbeat`` never starts."""
    return M.alarm_missing_window(A.t8_metrics(t), ["click", "error", "heartbeat", "purchase", "signup", "view"],
                                  dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), period_s=300, threshold=1.0)


@query
def alarm_consecutive(t: Tables) -> DataFrame:
    return M.alarm_consecutive(A.t8_metrics(t))


# ------------------------------------------------------------- silver ---

def parsed_standings(t: Tables) -> DataFrame:
    """Standings documents through their JSON text and back (B1 → A1)."""
    text = A.standings_documents(t).select(F.to_json(F.struct("metadata", "data")).alias("value"))
    doc = F.from_json("value", bronze.document_schema("standings", corrupt=False))
    return text.select(doc.alias("d")).select("d.*")


@query
def nested_explode(t: Tables) -> DataFrame:
    return S.explode_standings(A.standings_documents(t))


@query
def nested_roundtrip(t: Tables) -> DataFrame:
    return S.explode_standings(parsed_standings(t))


@query
def silver_standings(t: Tables) -> DataFrame:
    return S.silver_standings(parsed_standings(t), ts=AUDIT_TS).drop("other_stats")


@query
def project_rename(t: Tables) -> DataFrame:
    return S.silver_teams(A.teams_documents(t), ts=AUDIT_TS).drop("team_logos", "team_links")


@query
def flatten_struct(t: Tables) -> DataFrame:
    return S.flatten_struct(athletes(t), sep="_")


# ------------------------------------------------------ sources/sinks ---

@query
def scan_parquet(t: Tables) -> DataFrame:
    """A2: projection + filter reach the Parquet scan (ReadSchema /
    PushedFilters)."""
    li = read_table(t.spark, t.sf_dir, "lineitem.parquet")
    return (li.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"))


@query
def union_by_name(t: Tables) -> DataFrame:
    """Part frames with different columns concatenated by name."""
    o = t.orders
    a = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    b = o.where(F.col("o_orderstatus") != "F").select("o_orderdate", "o_orderkey", "o_custkey")
    return a.unionByName(b, allowMissingColumns=True)


@query
def export_metadata(t: Tables) -> DataFrame:
    """The metadata record written next to a JSON export."""
    return Out.export_metadata(standings(t, rank=True), "standings", ts=AUDIT_TS)


@query
def global_row_number(t: Tables) -> DataFrame:
    """a dense rank over the whole fact table, spread over all tasks."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    return R.global_row_number(li, [F.col("l_extendedprice").desc(), "l_orderkey", "l_partkey",
                                    "l_suppkey", "l_linenumber"], "rn")


@query
def head_to_head_matrix(t: Tables) -> DataFrame:
    """E14 wide form: one column per away team; the team list is the nation
    dimension, whose size TPC-H fixes (25 rows), so the width is bounded."""
    away = list(range(25))
    m = D.head_to_head_matrix(A.t4_matches(t), away)
    return m.select("home_team_id", *[F.col(str(k)).cast("bigint").alias(f"away_{k}") for k in away])


@query
def dq_summary(t: Tables) -> DataFrame:
    """Q4 statistics of a suite run: success, evaluated, successful, failed,
    percent."""
    return Q.suite_summary(Q.run_suite(athletes(t), "athletes", ATHLETE_SUITE))


@query
def dq_validate(t: Tables) -> DataFrame:
    """Q5: the entity's own suite picked from the registry."""
    return Q.validate(standings(t), "standings")


# ---------------------------------------------------------- streaming ---

@query
def stream_metric_windows(t: Tables) -> DataFrame:
    """L4: the metric-window stream over the events files (AvailableNow):
    every window, those still open at the end included."""
    from pitchline.streaming.incremental import run_metric_stream

    base = _scratch(t, "metric-stream")
    return run_metric_stream(
        t.spark, f"{t.sf_dir}/events*.parquet", t.events.schema, f"{base}/out", f"{base}/ckpt",
        select=lambda s: s.select("ts", F.col("event_type").alias("metric_name"),
                                  F.col("value").cast("decimal(18,2)").alias("value")))


def _scratch(t: Tables, tag: str) -> str:
    """A fresh folder for files a query lands, under the shared checkpoint
    folder of this application."""
    import uuid

    from pitchline.session import ensure_checkpoint_dir
    return (f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/pitchline/"
            f"{t.spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}")


def _land_standings(t: Tables, root: str) -> None:
    docs = A.standings_documents(t).select("data.*", F.lit("2024").alias("season"))
    Out.land_bronze(docs, root, "standings", A.BRONZE_SOURCE, partition_by=["season"],
                    ts=A.BRONZE_TS, compression="gzip")


@query
def bronze_files(t: Tables) -> DataFrame:
    """B1 → A1 through real files: the standings documents are landed as
    gzip JSON Lines under ``season=`` folders, read back with the explicit
    schema and turned into silver standings."""
    root = _scratch(t, "bronze")
    _land_standings(t, root)
    docs = bronze.read_bronze(t.spark, root, "standings", layout="lines")
    return S.silver_standings(docs, ts=AUDIT_TS).drop("other_stats")


@query
def stream_silver_standings(t: Tables) -> DataFrame:
    """L1: the incremental bronze → silver stream (AvailableNow, one
    idempotent batch partition per micro-batch) over landed files."""
    from pitchline.streaming.incremental import stream_silver
    root = _scratch(t, "stream")
    _land_standings(t, f"{root}/bronze")
    stream_silver(t.spark, f"{root}/bronze", f"{root}/silver", "standings", f"{root}/ckpt",
                  ts=AUDIT_TS, layout="lines").awaitTermination()
    return t.spark.read.parquet(f"{root}/silver/standings").drop("batch_id", "other_stats")


# ------------------------------------------- snapshots, seasons, loads ---

def snapshots(t: Tables) -> DataFrame:
    """Two snapshots of every player; in the older one all were a year older
    and played elsewhere."""
    new = athletes(t).withColumn("ingestion_timestamp", F.lit("2024-07-01T06:00:00"))
    old = new.withColumns({
        "ingestion_timestamp": F.lit("2024-07-01T00:00:00"), "athlete_age": F.col("athlete_age") + 1,
        "athlete_team": F.col("athlete_team").withField("id", F.lit("0"))})
    return new.unionByName(old)


@query
def roster_latest_snapshot(t: Tables) -> DataFrame:
    """E3 over repeated snapshots: each player counts once."""
    return gold.team_roster_summary(snapshots(t), sets="string")


@query
def dim_players_snapshots(t: Tables) -> DataFrame:
    """K2 over repeated snapshots: one row per player."""
    return W.audited(W.dim_players(gold.player_analytics(snapshots(t))), AUDIT_TS)


@query
def standings_two_seasons(t: Tables) -> DataFrame:
    """F1's input over two seasons, the newer one with a stale snapshot:
    the newest row per season, group and team."""
    s = standings(t)

    def load(season: str, ts: str, points: Column) -> DataFrame:
        return s.withColumns({"season": F.lit(season), "ingestion_timestamp": F.lit(ts), "points": points})

    both = (load("2024-25", "2024-12-01T06:00:00", F.col("points"))
            .unionByName(load("2024-25", "2024-12-01T00:00:00", F.lit(0.0)))
            .unionByName(load("2023-24", "2024-06-01T00:00:00", F.col("points") + 1)))
    return gold.team_performance_summary(both, rank=False).select("season", "team_id", "points", "games_played")


@query
def two_loads(t: Tables) -> DataFrame:
    """K8/K9 over two loads: identity keys of the second load start behind
    the first; a narrower reload keeps the other column and created_at."""
    c = t.customer.select("c_custkey", (F.col("c_custkey") % 7).alias("extra"))
    first = R.materialize(R.surrogate_key(c.where("c_custkey % 3 <> 0"), name="sk"), "load")
    second = R.surrogate_key(c.where("c_custkey % 3 = 0"), name="sk", start=W.next_key(first, "sk"))
    table = W.audited(R.materialize(first.unionByName(second), "load"), "2024-01-01 00:00:00")
    reload = t.customer.where("c_custkey % 2 = 0").select("c_custkey", F.lit(1).alias("seen"))
    out = W.upsert(table, reload, ["c_custkey"], ts="2024-06-01 00:00:00")
    later = F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("sk").alias("n_keys"),
                   F.count(F.when(F.col("created_at") >= later, 1)).alias("n_created_later"),
                   F.count(F.when(F.col("updated_at") >= later, 1)).alias("n_updated"),
                   F.sum("extra").cast("bigint").alias("kept_extra"))


@query
def cast_decimal_text(t: Tables) -> DataFrame:
    """Decimal numbers in text, numbers out of range, dates that are none."""
    return t.part.select(
        "p_partkey", X.to_int(F.concat(F.col("p_size").cast("string"), F.lit(".0"))).alias("size_int"),
        X.to_int(F.concat(F.col("p_size").cast("string"), F.lit("0000000000"))).alias("too_large"),
        F.concat(F.lit("2024-13-"), F.col("p_size").cast("string")).try_cast("date").alias("bad_date"))


# ------------------------------------------ nothing lost on the way ---

@query
def unknown_stats(t: Tables) -> DataFrame:
    """A stat outside the ten names survives in ``other_stats``."""
    extra = F.struct(F.lit("deductions").alias("name"), (F.col("_id") % 3).cast("double").alias("value"))
    docs = A.standings_documents(t).withColumn("_id", F.col("data.children")[0]["standings"]["entries"][0]["team"]["id"].cast("long"))
    docs = docs.withColumn("data", F.col("data").withField("children", F.transform("data.children", lambda g: g.withField(
        "standings", F.struct(F.transform(g["standings"]["entries"], lambda e: e.withField(
            "stats", F.array_append(e["stats"], extra))).alias("entries"))))))
    wide = S.silver_standings(docs.drop("_id"), ts=AUDIT_TS)
    return wide.select("team_id", "points", F.explode("other_stats").alias("stat_name", "stat_value"))


@query
def corrupt_documents(t: Tables) -> DataFrame:
    """A1: documents that are no valid JSON are kept and counted."""
    d = A.standings_documents(t)
    team = F.col("data.children")[0]["standings"]["entries"][0]["team"]["id"].cast("long")
    text = F.to_json(F.struct("metadata", "data"))
    text = F.when(team % 10 == 0, F.substring(text, 1, 40)).otherwise(text)
    doc = F.from_json(text, bronze.document_schema("standings"), {"columnNameOfCorruptRecord": "_corrupt_record"})
    return bronze.corrupt_documents(d.select(doc.alias("d")).select("d.*"))


@query
def flatten_athletes(t: Tables) -> DataFrame:
    """Athletes from documents through their JSON text."""
    a = A.t3_athletes(t)
    item = F.struct(F.col("athlete_id").cast("string").alias("id"), F.col("athlete_full_name").alias("fullName"),
                    F.concat(F.col("athlete_age").cast("string"), F.lit(".0")).alias("age"),
                    F.struct(F.col("athlete_nationality").alias("country")).alias("birthPlace"),
                    F.struct(F.col("team_id").cast("string").alias("id"), F.col("team_name").alias("name")).alias("team"))
    docs = a.select(F.to_json(F.struct(A._metadata().alias("metadata"), F.struct(F.array(item).alias("items")).alias("data"))).alias("v"))
    parsed = docs.select(F.from_json("v", bronze.document_schema("athletes", corrupt=False)).alias("d")).select("d.*")
    return S.silver_athletes(parsed, ts=AUDIT_TS).select(
        "ingestion_timestamp", "athlete_id", "athlete_full_name", X.to_int("athlete_age").alias("age"),
        F.get_json_object("athlete_birth_place", "$.country").alias("country"),
        F.col("athlete_team.id").alias("team_id"), F.col("athlete_team.name").alias("team_name"))


@query
def flatten_events(t: Tables) -> DataFrame:
    """Events from documents through their JSON text, to match rows."""
    e = A.events_silver(t)
    item = F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_date").alias("date"),
                    F.col("event_status").alias("status"), F.col("event_competitions").alias("competitions"))
    docs = e.select(F.to_json(F.struct(A._metadata().alias("metadata"), F.struct(F.array(item).alias("events")).alias("data"))).alias("v"))
    parsed = docs.select(F.from_json("v", bronze.document_schema("events", corrupt=False)).alias("d")).select("d.*")
    silver = S.silver_events(parsed, ts=AUDIT_TS).drop("ingestion_timestamp")  # an event id repeats for its line items
    return W.fact_match_results(silver, key=False)


# ------------------------------------------------- seasons, table loads ---

def two_seasons(t: Tables, rank: bool = False) -> DataFrame:
    """Standings of two seasons; in the older one only some teams played,
    with other points."""
    s = standings(t, rank).withColumn("ingestion_timestamp", F.lit("2024-12-01T06:00:00"))
    old = s.where("team_id % 3 <> 0").withColumns({"points": F.col("points") + F.col("team_id") % 5, "season": F.lit("2023-24")})
    return s.withColumn("season", F.lit("2024-25")).unionByName(old)


def two_player_seasons(t: Tables) -> DataFrame:
    """Athletes of two seasons; a year earlier they were a year younger, and
    some elsewhere."""
    a = athletes(t).withColumn("ingestion_timestamp", F.lit("2024-12-01T06:00:00"))
    old = a.where("athlete_id % 4 <> 0").withColumns({
        "athlete_age": F.col("athlete_age") - 1, "season": F.lit("2023-24"),
        "athlete_team": F.col("athlete_team").withField("id", F.lit("0"))})
    return a.withColumn("season", F.lit("2024-25")).unionByName(old)


@query
def gold_two_seasons(t: Tables) -> DataFrame:
    """Groups are analysed and ranked season by season."""
    return gold.group_analysis(two_seasons(t))


@query
def gold_two_seasons_overview(t: Tables) -> DataFrame:
    """One overview row a season."""
    return gold.competition_overview(two_seasons(t))


@query
def gold_two_seasons_ranks(t: Tables) -> DataFrame:
    """the overall rank within the season."""
    return gold.team_performance_summary(two_seasons(t)).select("season", "group_id", "team_id", "points", "overall_rank")


@query
def gold_two_seasons_rosters(t: Tables) -> DataFrame:
    """Each player counts once a season."""
    return gold.team_roster_summary(two_player_seasons(t), sets="string")


@query
def gold_two_seasons_players(t: Tables) -> DataFrame:
    """Players by age group and by team, season by season."""
    p = gold.player_analytics(two_player_seasons(t))
    ages = D.age_distribution(p).select("season", F.lit("age").alias("by"), F.col("age_group").alias("name"), "position", "players")
    teams = D.team_composition(p).select("season", F.lit("team").alias("by"), F.col("team_id").alias("name"), "position", "players")
    return ages.unionByName(teams)


def _player_stats_long(t: Tables) -> DataFrame:
    """Player statistics in the long form of the silver layer."""
    s = A.t6_fact_player_stats(t).groupBy("player_id", "team_id", "date_id").agg(
        *(F.sum(c).cast("double").alias(c) for c in ("games_played", "goals", "assists")))
    return s.unpivot(["player_id", "team_id", "date_id"], ["games_played", "goals", "assists"], "stat_name", "stat_value")


def _one_event(t: Tables) -> DataFrame:
    """The greatest row of each event, found before the rows are nested."""
    return A.nested_events(W.one_row_per_key(A.event_matches(t), ["event_id"]))


def _one_match_an_event(t: Tables) -> DataFrame:
    """Events with two competitions each, in different groups."""
    e = _one_event(t)
    other = F.col("event_competitions")[0].withField("groupId", F.lit("second"))
    return e.withColumn("event_competitions", F.array_append("event_competitions", other))


@query
def warehouse_two_seasons(t: Tables) -> DataFrame:
    """K1-K8 in the flow: silver of two seasons to gold and into all seven
    tables, loaded twice: rows, distinct keys, identity values, and rows that
    kept their identity and created_at over the reload."""
    from pitchline.plans import run
    from pitchline.sinks import versions

    root = _loaded_warehouse(t)
    tables = run.warehouse_loads(t.spark, root, "2024-12-31")
    first = {n: versions.read_current(t.spark, f"{root}/warehouse", n) for n in tables}
    _must(run.load_warehouse(t.spark, root, ts="2024-12-31T06:00:00"))
    out = []
    for name, load in tables.items():
        now = versions.read_current(t.spark, f"{root}/warehouse", name)
        same = [*load.key, "created_at", *([load.identity] if load.identity else [])]
        kept = now.select(*same).intersect(first[name].select(*same))
        ids = F.count_distinct(load.identity) if load.identity else F.lit(None).cast("bigint")
        out.append(now.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                           F.count_distinct(*load.key).alias("n_keys"), ids.alias("n_identities"))
                   .withColumn("n_kept", kept.select(F.count(F.lit(1))).scalar()))
    return functools.reduce(DataFrame.unionByName, out)


def _must(status: list[tuple]) -> None:
    failed = [r for r in status if not r[2]]
    if failed:
        raise RuntimeError(f"jobs failed: {failed}")


def _loaded_warehouse(t: Tables) -> str:
    """Silver of two seasons, gold from it, and all seven tables loaded once.
    The silver tables do not read each other: they are written side by side."""
    from concurrent.futures import ThreadPoolExecutor

    from pitchline.plans import run

    root = _scratch(t, "flow")
    silver = {"standings": lambda t: two_seasons(t, rank=True), "teams": A.teams_silver, "athletes": two_player_seasons,
              "events": _one_match_an_event, "player_stats": _player_stats_long}
    with ThreadPoolExecutor(run.AT_ONCE) as pool:
        list(pool.map(lambda x: Out.write_layer(x[1](t), f"{root}/silver", x[0]), silver.items()))
    _must(run.run_layer(t.spark, "gold", root, ts=AUDIT_TS))
    _must(run.load_warehouse(t.spark, root, ts="2024-12-31T00:00:00"))
    return root


@query
def views_from_warehouse(t: Tables) -> DataFrame:
    """G1 over the loaded warehouse: names and the newest season's facts."""
    from pitchline.plans import run

    return run.warehouse_views(t.spark, _loaded_warehouse(t))["v_team_performance_summary"]()


@query
def table_metrics_loaded(t: Tables) -> DataFrame:
    """E7/I2 over the loaded warehouse, with the load times of its rows."""
    from pitchline.plans import run

    return run.warehouse_views(t.spark, _loaded_warehouse(t))["table_metrics"]()


@query
def data_quality_loaded(t: Tables) -> DataFrame:
    """I1/E6 over the loaded warehouse."""
    from pitchline.plans import run

    return run.warehouse_views(t.spark, _loaded_warehouse(t))["data_quality_check"]()


@query
def warehouse_season_dates(t: Tables) -> DataFrame:
    """K5: the facts of an earlier season are dated by its last day."""
    summary = gold.team_performance_summary(two_seasons(t, rank=True))
    f = W.fact_team_performance(summary, W.season_date(F.col("season"), SNAPSHOT_DATE), key=False)
    return f.groupBy("date_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("team_id", "group_id").alias("n_keys"))


@query
def two_competitions(t: Tables) -> DataFrame:
    """K7: an event of two competitions is two matches, told apart by group."""
    from pitchline.sinks import versions

    root = _scratch(t, "matches")
    rows = R.materialize(W.fact_match_results(_one_match_an_event(t), key=False), "matches")  # a load reads its rows more than once
    versions.reload(t.spark, root, "fact_match_results", rows, ["event_id", "group_id"], version="1", ts=AUDIT_TS, identity="match_id")
    return versions.read_current(t.spark, root, "fact_match_results").groupBy("event_id").agg(
        F.count(F.lit(1)).alias("matches"), F.count_distinct("match_id").alias("ids"), F.max("group_id").alias("last_group"))


@query
def unfinished_version(t: Tables) -> DataFrame:
    """A load that wrote its rows but did not publish them, and one
    that was refused because another was faster, leave the table as it was."""
    from pitchline.sinks import commits, versions

    root = _scratch(t, "versions")
    c = t.customer.select("c_custkey", "c_name")
    versions.reload(t.spark, root, "dim", c, ["c_custkey"], version="1", ts=AUDIT_TS)
    base = versions.manifest(t.spark, root, "dim")
    Out.write_layer(c.where("c_custkey % 7 = 0"), f"{root}/dim", "version=2")  # died before its manifest
    versions.reload(t.spark, root, "dim", c.where("c_custkey % 2 = 0").withColumn("c_name", F.lower("c_name")), ["c_custkey"],
                    version="3", ts="2024-08-01T00:00:00")
    try:
        versions.write_version(c.limit(0), root, "dim", "4", base)
        raise RuntimeError("a load on an old version was published")
    except commits.Conflict:
        pass
    return versions.read_current(t.spark, root, "dim")


@query
def identity_reload(t: Tables) -> DataFrame:
    """K8: three loads of overlapping rows. A row keeps the key of its first
    load, no key is given twice, and a load run again changes nothing."""
    from pitchline.sinks import versions

    root = _scratch(t, "identity")
    c = t.customer.select("c_custkey", "c_name")
    seen = []
    for load, part in (("a", c.where("c_custkey % 3 = 0")), ("b", c.where("c_custkey % 2 = 0")), ("b", c), ("c", c)):
        versions.reload(t.spark, root, "dim", part, ["c_custkey"], version=load, ts=AUDIT_TS, identity="sk")
        seen.append(versions.read_current(t.spark, root, "dim").select("c_custkey", "sk"))
    first, second, again, last = seen
    kept = functools.reduce(DataFrame.unionByName, (x.join(last, ["c_custkey", "sk"], "left_semi") for x in (first, second, again)))
    return last.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("sk").alias("n_keys")).withColumn(
        "n_kept", kept.select(F.count(F.lit(1))).scalar())


@query
def alarm_episodes(t: Tables) -> DataFrame:
    """L3: episodes of the state of a 2-of-3 alarm on 5-minute averages in
    January 2024; ``heartbeat`` never reports."""
    states = M.period_states(A.t8_metrics(t), ["click", "error", "heartbeat", "view"], dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1),
                             threshold=60.0, points=2, out_of=3)
    return M.alarm_episodes(states)


# ------------------------------------------------------ partial states ---

def _season_batches(t: Tables) -> list[tuple[DataFrame, str, str]]:
    """Standings documents in three deliveries: all teams; a newer snapshot
    of some with a season before it; and a stale snapshot with new teams of
    that season. Each is (documents, season, snapshot time)."""
    wide = R.materialize(A.t1_wide(t), "wide")
    docs = lambda rows: A.standings_documents(t, rows).select("data.*")
    points = lambda by: {"points": F.col("points") + by}
    return [
        [(docs(wide), "2024", "2024-12-01T00:00:00")],
        [(docs(wide.where("team_id % 3 = 0").withColumns(points(7))), "2024", "2024-12-02T00:00:00"),
         (docs(wide.where("team_id % 2 = 0")), "2023", "2024-12-02T00:00:00")],
        [(docs(wide.where("team_id % 2 = 0").withColumns(points(-50))), "2024", "2024-11-30T00:00:00"),
         (docs(wide.where("team_id % 2 = 1").withColumns(points(F.col("team_id") % 4))), "2023", "2024-12-03T00:00:00")]]


def _streamed_gold(t: Tables) -> str:
    from pitchline.streaming.partials import stream_gold

    root = _scratch(t, "partials")
    for batch in _season_batches(t):
        for docs, season, ts in batch:
            Out.land_bronze(docs.withColumn("season", F.lit(season)), f"{root}/bronze", "standings", A.BRONZE_SOURCE,
                            partition_by=["season"], ts=ts)
        stream_gold(t.spark, f"{root}/bronze", f"{root}/state", f"{root}/ckpt").awaitTermination()
    return f"{root}/state"


@query
def incremental_gold(t: Tables) -> DataFrame:
    """Group analysis from partial states after three micro-batches
    with replaced and stale snapshots, equal to the full rebuild."""
    from pitchline.streaming import partials

    return partials.group_analysis(partials.counts(t.spark, _streamed_gold(t)))


@query
def incremental_overview(t: Tables) -> DataFrame:
    """The season overviews from the same partial states."""
    from pitchline.streaming import partials

    state = _streamed_gold(t)
    return partials.competition_overview(partials.counts(t.spark, state), partials.rows(t.spark, state))


# ---------------------------------------------- sketches, open payloads ---

@query
def distinct_sketches(t: Tables) -> DataFrame:
    """Sketches of the suppliers a day, stored from two loads that
    overlap in time, and merged to quarters; only sketches are read for it.
    At up to some thousand keys the counts are exact."""
    from pitchline.plans import sketches as Sk
    from pitchline.sinks import versions

    root = _scratch(t, "sketches")
    li = t.lineitem.select(F.col("l_shipdate").cast("date").alias("day"), "l_suppkey", "l_linenumber")
    for load, part in (("a", li.where("l_linenumber <= 4")), ("b", li.where("l_linenumber > 4")), ("b", li)):
        Sk.append_sketches(t.spark, root, "by_day", Sk.sketch_by(part, ["day"], ["l_suppkey"], lg=15), ["day"], load)
    days = versions.read_current(t.spark, root, "by_day")
    quarters = Sk.merged(days, [F.year("day").alias("year"), F.quarter("day").alias("quarter")])
    return Sk.estimates(quarters)


@query
def table_metrics_sketched(t: Tables) -> DataFrame:
    """E7 from sketches a date: rows, distinct players and dates of the
    player facts."""
    from pitchline.plans import sketches as Sk

    days = Sk.sketch_by(A.t6_fact_player_stats(t), ["date_id"], ["player_id"], lg=15)
    stored = R.materialize(days, "sketches")
    return Sk.estimates(Sk.merged(stored)).withColumn("unique_dates", stored.select(F.count(F.lit(1))).scalar())


def _drifted_athletes(t: Tables, root: str) -> None:
    """Athlete documents with fields outside the contract, one of them of two
    types, and with fields that are null or missing."""
    a = A.t3_athletes(t)
    k = F.col("athlete_id")
    item = F.struct(
        k.cast("string").alias("id"), F.col("athlete_full_name").alias("fullName"), F.col("athlete_age").alias("age"),
        F.when(k % 5 == 0, F.lit("nick")).alias("nickname"),
        F.when(k % 7 == 0, F.struct((k % 4 + 2025).alias("until"))).alias("contract"),
        F.when(k % 2 == 0, F.struct(F.col("athlete_nationality").alias("country"))).alias("birthPlace"))
    docs = a.select(F.struct(A._metadata().alias("metadata"), F.struct(F.array(item).alias("items")).alias("data")).alias("d"))
    docs.select("d.*").write.mode("overwrite").json(f"{root}/athletes/season=2024")


@query
def payload_drift(t: Tables) -> DataFrame:
    """The fields of landed documents against the contract."""
    from pitchline.plans import drift

    root = _scratch(t, "drift")
    _drifted_athletes(t, root)
    return drift.drift_report(drift.read_documents(t.spark, root, "athletes"), "athletes")


@query
def payload_variant(t: Tables) -> DataFrame:
    """Fields that no schema names, taken out of the VARIANT by path."""
    from pitchline.plans import drift

    root = _scratch(t, "drift")
    _drifted_athletes(t, root)
    items = drift.items(drift.read_documents(t.spark, root, "athletes"), "athletes")
    return items.select(drift.field("id", "bigint").alias("athlete_id"), drift.field("nickname", "string").alias("nickname"),
                        drift.field("contract.until", "int").alias("until"), drift.field("birthPlace.country", "string").alias("country"))


def _parsed(documents: DataFrame, entity: str) -> DataFrame:
    """Documents through their JSON text and the entity's explicit schema."""
    text = documents.select(F.to_json(F.struct("metadata", "data")).alias("v"))
    return text.select(F.from_json("v", bronze.document_schema(entity, corrupt=False)).alias("d")).select("d.*")


@query
def teams_all_fields(t: Tables) -> DataFrame:
    """C4: all 13 payload fields of the teams, logos and links as JSON text."""
    return S.silver_teams(_parsed(A.teams_documents(t), "teams"), ts=AUDIT_TS)


ATHLETE_FIELDS = ("id", "uid", "guid", "firstName", "lastName", "fullName", "displayName", "shortName", "weight", "height", "age",
                  "dateOfBirth", "birthPlace", "nationality", "position", "jersey")


@query
def athletes_all_fields(t: Tables) -> DataFrame:
    """All 17 payload fields of the athletes."""
    a = A.t3_athletes(t)
    name, k = F.col("athlete_full_name"), F.col("athlete_id").cast("string")
    values = {"id": k, "uid": F.concat(F.lit("s:"), k), "guid": F.md5(k), "firstName": F.substring(name, 1, 4), "lastName": F.substring(name, 5, 20),
              "fullName": name, "displayName": F.upper(name), "shortName": F.lower(name), "weight": F.col("athlete_weight").cast("string"),
              "height": F.col("athlete_height").cast("string"), "age": F.col("athlete_age").cast("string"),
              "dateOfBirth": F.concat(F.lit("1990-01-"), F.lpad((F.col("athlete_id") % 28 + 1).cast("string"), 2, "0")),
              "birthPlace": F.struct(F.col("team_name").alias("city")), "nationality": F.col("athlete_nationality"),
              "position": F.struct(F.col("athlete_position").alias("name")), "jersey": (F.col("athlete_id") % 99).cast("string")}
    team = F.struct(F.col("team_id").cast("string").alias("id"), F.col("team_name").alias("name"), F.lit("T").alias("abbreviation"))
    item = F.struct(*(values[f].alias(f) for f in ATHLETE_FIELDS), team.alias("team"))
    docs = a.select(A._metadata().alias("metadata"), F.struct(F.array(item).alias("items")).alias("data"))
    silver = S.silver_athletes(_parsed(docs, "athletes"), ts=AUDIT_TS)
    return silver.select(*[c for c in silver.columns if c != "athlete_team"], F.col("athlete_team.id").alias("team_id"),
                         F.col("athlete_team.name").alias("team_name"), F.col("athlete_team.abbreviation").alias("team_abbreviation"))


@query
def events_all_fields(t: Tables) -> DataFrame:
    """All 10 payload fields of the events; of the competitions venue,
    group and the sides."""
    e = _one_event(t)
    k = F.col("event_id").cast("string")
    item = F.struct(k.alias("id"), F.concat(F.lit("e:"), k).alias("uid"), F.col("event_date").alias("date"), F.concat(F.lit("Event "), k).alias("name"),
                    F.concat(F.lit("E"), k).alias("shortName"), F.col("event_status").alias("status"), F.col("event_competitions").alias("competitions"),
                    F.struct(F.substring("event_date", 1, 4).cast("int").alias("year")).alias("season"), (F.col("event_id") % 2 == 0).alias("timeValid"),
                    F.array(F.struct(F.concat(F.lit("/e/"), k).alias("href"))).alias("links"))
    docs = e.select(A._metadata().alias("metadata"), F.struct(F.array(item).alias("events")).alias("data"))
    silver = S.silver_events(_parsed(docs, "events"), ts=AUDIT_TS)
    c = F.col("event_competitions")[0]
    return silver.select(*[x for x in silver.columns if x != "event_competitions"], c["venue"].alias("venue"), c["groupId"].alias("group_id"),
                         c["competitors"][0]["teamId"].alias("home"), c["competitors"][1]["teamId"].alias("away"))


# --------------------------------------------- files written, read back ---

def _two_season_documents(t: Tables, root: str) -> None:
    """Standings documents of two seasons, landed under their folders."""
    docs = A.standings_documents(t).select("data.*")
    for season in ("2023", "2024"):
        Out.land_bronze(docs.withColumn("season", F.lit(season)), root, "standings", A.BRONZE_SOURCE, partition_by=["season"], ts=A.BRONZE_TS)


@query
def bronze_assets(t: Tables) -> DataFrame:
    """A4: names of the files that hold the documents, and their season
    folders; files of another kind in the same folders are not read."""
    root = _scratch(t, "assets")
    _two_season_documents(t, root)
    t.spark.range(3).write.mode("append").csv(f"{root}/standings/season=2024")
    docs = bronze.read_bronze(t.spark, root, "standings")
    return docs.groupBy("season").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("asset_name").rlike("^part-[0-9]+")).alias("named"))


@query
def lake_inventory(t: Tables) -> DataFrame:
    """A5: layers and datasets of a lake, with files that hold something."""
    from pitchline.sources.inventory import lake_inventory as inventory

    root = _scratch(t, "lake")
    Out.write_layer(t.nation, f"{root}/silver", "nation")
    Out.write_layer(t.customer, f"{root}/silver", "customer", partition_by=["c_mktsegment"])
    Out.write_layer(t.region, f"{root}/gold", "region")
    found = inventory(t.spark, root)
    return found.select("layer", "dataset", (F.col("bytes") > 0).alias("has_rows"))


@query
def layer_write(t: Tables) -> DataFrame:
    """A layer written and read back; a second write replaces it."""
    root = _scratch(t, "layer")
    for _ in range(2):
        Out.write_layer(standings(t), root, "standings", partition_by=["group_id"])
    return read_table(t.spark, root, "standings")


def _exported(t: Tables, fmt: str) -> str:
    s = standings(t).withColumn("tags", F.array(F.col("group_name"), F.lit('a "b", c')))
    return Out.export(s, _scratch(t, "export"), "standings", fmt, ts=AUDIT_TS)


_CSV = "group_id int, group_name string, team_id bigint, team_name string, points double, tags string"


def _read_csv(t: Tables, path: str) -> DataFrame:
    df = t.spark.read.option("header", "true").option("escape", "\\").csv(path)
    return df.select(*[F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in _CSV.split(", ")])


@query
def export_csv(t: Tables) -> DataFrame:
    """A CSV export read back, nested columns as JSON text."""
    return _read_csv(t, _exported(t, "csv"))


@query
def export_bi(t: Tables) -> DataFrame:
    """The BI extract read back."""
    return _read_csv(t, _exported(t, "bi"))


@query
def export_json(t: Tables) -> DataFrame:
    """A JSON export read back beside the count of its metadata."""
    path = _exported(t, "json")
    meta = t.spark.read.json(f"{path}/metadata").select("record_count").scalar()
    schema = "group_id int, group_name string, team_id bigint, team_name string, points double, tags array<string>"
    return t.spark.read.schema(schema).json(f"{path}/records").withColumn("tags", F.array_join("tags", "|")).withColumn("record_count", meta)


@query
def export_all(t: Tables) -> DataFrame:
    """All datasets exported; one that fails does not stop the others."""
    def broken() -> DataFrame:
        return t.nation.select("no_such_column")

    status = Out.export_all(t.spark, {"nation": lambda: t.nation, "broken": broken, "region": lambda: t.region}, _scratch(t, "export"), "csv", ts=AUDIT_TS)
    return status.select("dataset", "status", F.col("path").isNotNull().alias("written"), F.col("error").isNotNull().alias("has_error"))


@query
def warehouse_table(t: Tables) -> DataFrame:
    """A table of the catalog written, replaced, and read by its name."""
    path = _scratch(t, "table")
    name = f"dim_{path.rsplit('-', 1)[1]}"
    for rows in (t.nation.limit(0), t.nation):
        Out.write_warehouse(rows, name, path=path)
    rows = R.materialize(t.spark.table(name), "table")
    t.spark.sql(f"DROP TABLE {name}")
    return rows


def _landed_lake(t: Tables) -> str:
    """Bronze documents of standings and teams."""
    root = _scratch(t, "lake")
    _land_standings(t, f"{root}/bronze")
    Out.land_bronze(A.teams_documents(t).select("data.*", F.lit("2024").alias("season")), f"{root}/bronze", "teams", A.BRONZE_SOURCE,
                    partition_by=["season"], ts=A.BRONZE_TS)
    return root


@query
def quality_reports(t: Tables) -> DataFrame:
    """Q12: the reports that the silver jobs append."""
    from pitchline.plans import run

    root = _landed_lake(t)
    run.run_silver(t.spark, root, ts=AUDIT_TS, only=["standings", "teams"])
    return read_table(t.spark, root, "reports")


@query
def layer_job(t: Tables) -> DataFrame:
    """The silver and gold jobs of landed documents: what was written."""
    from pitchline.plans import run

    root = _landed_lake(t)
    made = ["team_performance_summary", "competition_overview", "group_analysis"]
    status = run.run_layer(t.spark, "silver", root, ts=AUDIT_TS, only=["standings", "teams"])
    status += run.run_layer(t.spark, "gold", root, ts=AUDIT_TS, only=made)
    status = t.spark.createDataFrame(status, run.RUN_STATUS).select("layer", "dataset", "success", "rejected")
    rows = functools.reduce(DataFrame.unionByName, (read_table(t.spark, f"{root}/{layer}", n).groupBy(
        F.lit(layer).alias("layer"), F.lit(n).alias("dataset")).agg(F.count(F.lit(1)).alias("n_rows"))
        for layer, n in [("silver", "standings"), ("silver", "teams"), *(("gold", n) for n in made)]))
    return status.join(rows, ["layer", "dataset"], "left")


@query
def pipeline_run(t: Tables) -> DataFrame:
    """The whole run over documents of two entities, and again after it
    was interrupted: what is there is skipped, what is missing fails alone."""
    from pitchline.plans import run

    root = _landed_lake(t)
    run.run_silver(t.spark, root, ts=AUDIT_TS, only=["standings"])
    return run.run_pipeline(t.spark, root, ts=AUDIT_TS, resume=True).select(
        "layer", "dataset", "success", F.col("error").isNotNull().alias("has_error"), "rejected", "skipped")


@query
def dq_observed(t: Tables) -> DataFrame:
    """Q4/Q12: the suite's report from the counts that are taken while the
    table is written; equal to that of ``dq_suite``."""
    return Q.write_checked(athletes(t), f"{_scratch(t, 'checked')}/athletes", "athletes", ATHLETE_SUITE)


@query
def quarantine(t: Tables) -> DataFrame:
    """Q4: rows that break a rule are set apart, with what they broke."""
    path = f"{_scratch(t, 'checked')}/athletes"
    Q.write_checked(athletes(t), path, "athletes", [*ATHLETE_SUITE, Q.not_null("athlete_nationality")])
    table = t.spark.read.parquet(path)
    apart = table.where(F.col(Q.STATE) == Q.QUARANTINED).select("athlete_id", F.array_join(Q.BROKEN, ",").alias("broken"))
    return apart.unionByName(Q.passed(table).select("athlete_id", F.lit("").alias("broken")))


@query
def compacted_batches(t: Tables) -> DataFrame:
    """Twelve micro-batches packed every four: all rows, in a bounded
    number of files."""
    from pitchline.sinks import compaction

    root = _scratch(t, "batches")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    for i in range(12):
        Out.write_batch(li.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(12)) == i), root, "lineitem", i)
        if i % 4 == 3:
            compaction.compact(t.spark, root, "lineitem")
    rows = compaction.read_packed(t.spark, root, "lineitem")
    files = rows.select("_metadata.file_path").distinct().select(F.count(F.lit(1)) == 1).scalar()
    return rows.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")).withColumn(
        "one_file", files)
