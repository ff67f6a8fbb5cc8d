"""Layer jobs (N1, N2): build every dataset of a layer from one session.

Each dataset is one distributed write; a failing dataset is reported and
does not stop the others. The registries map dataset names to builders so
ingestion, quality and transformation share one set of entity names.

The datasets of a layer do not read each other, so up to ``AT_ONCE`` of
their jobs run side by side, each in a scheduler pool of its own. With
``resume`` a run skips what an earlier one built from the same files
(:mod:`pitchline.sinks.ledger`).
"""

from __future__ import annotations

import datetime as _dt
import functools
import operator
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.operators.audit import with_audit
from pitchline.operators.filters import require_not_null
from pitchline.operators.ranking import materialize
from pitchline.plans import gold, quality, silver, views, warehouse
from pitchline.sinks import ledger, versions
from pitchline.sinks.files import export_all, write_layer
from pitchline.sources.bronze import corrupt_count, read_bronze
from pitchline.sources.tables import read_table

Builder = Callable[..., DataFrame]
AT_ONCE = 4


SILVER_BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "standings": silver.silver_standings,
    "teams": silver.silver_teams,
    "athletes": silver.silver_athletes,
    "events": silver.silver_events,
    "player_stats": silver.silver_player_stats,
}


def _gold(source: str, fn: Callable[[DataFrame], DataFrame]) -> tuple[str, Callable[[DataFrame], DataFrame]]:
    return source, lambda rows: fn(quality.passed(rows))


#: The gold datasets: the silver entity they are built from, and how.
GOLD_BUILDERS = {
    "team_performance_summary": _gold("standings", gold.team_performance_summary),
    "player_analytics": _gold("athletes", gold.player_analytics),
    "team_roster_summary": _gold("athletes", gold.team_roster_summary),
    "competition_overview": _gold("standings", gold.competition_overview),
    "group_analysis": _gold("standings", gold.group_analysis),
}

RUN_STATUS = T.StructType([T.StructField("layer", T.StringType()),
                           T.StructField("dataset", T.StringType()),
                           T.StructField("success", T.BooleanType()),
                           T.StructField("error", T.StringType()),
                           # documents that are no JSON, rows without a key
                           T.StructField("rejected", T.LongType()),
                           # built by an earlier run from the same inputs
                           T.StructField("skipped", T.BooleanType())])


class Job(NamedTuple):
    """One dataset of a layer: its work, which may return what to note about
    it, and the folders that it reads."""

    dataset: str
    work: Callable[[], dict | None]
    inputs: Sequence[str]


def _run_jobs(spark: SparkSession, root: str, layer: str, jobs: Sequence[Job], resume: bool) -> list[tuple[tuple, dict]]:
    """Run the jobs side by side; for each its status row and what was noted
    (``rejected`` among it). A failing job does not stop the others."""
    def run(job: Job) -> tuple[tuple, dict]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{layer}-{job.dataset}")
        try:
            inputs = ledger.fingerprint(spark, job.inputs)
            before = ledger.is_done(spark, root, layer, job.dataset, inputs) if resume else None
            noted = before or (job.work() or {})
            if not before:
                ledger.note(spark, root, layer, job.dataset, inputs, **noted)
            return (layer, job.dataset, True, None, noted.get("rejected"), bool(before)), noted
        except Exception as e:  # noqa: BLE001 - one dataset must not stop the others
            return (layer, job.dataset, False, f"{type(e).__name__}: {e}", None, False), {}

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(run, jobs))


def run_layer(spark: SparkSession, layer: str, root: str, *, ts: str | None = None, only: list[str] | None = None,
              bronze_layout: str = "lines", resume: bool = False) -> list[tuple]:
    """Build and write every dataset of ``layer`` ("silver" or "gold")
    under ``root/<layer>`` (``bronze_layout``: how the bronze files hold their
    documents). Returns one status row per dataset (``RUN_STATUS``); silver
    rows count the corrupt documents of their entity."""
    if layer == "silver":
        rows, _ = run_silver(spark, root, ts=ts, only=only, bronze_layout=bronze_layout, resume=resume)
        return [r for r in rows if r[0] == "silver"]

    def one(name: str) -> None:
        source, build = GOLD_BUILDERS[name]
        write_layer(with_audit(build(read_table(spark, f"{root}/silver", source)), "gold", name, ts), f"{root}/gold", name)

    jobs = [Job(n, lambda n=n: one(n), [f"{root}/silver/{source}"])
            for n, (source, _) in GOLD_BUILDERS.items() if not only or n in only]
    return [row for row, _ in _run_jobs(spark, root, "gold", jobs, resume)]


def run_silver(spark: SparkSession, root: str, *, ts: str | None = None, only: list[str] | None = None,
               bronze_layout: str = "lines", resume: bool = False) -> tuple[list[tuple], bool]:
    """Write each silver entity and validate it with its suite (Q5, Q12) in
    the same pass over its documents; reports are appended to
    ``root/reports``, failing rows are set apart
    (:func:`quality.write_checked`), corrupt documents counted. Returns the
    status rows of both, and whether every expectation of every entity held.

    The count of corrupt documents is taken below the standings' pivot, so a
    stage that is run again after a loss may count some twice."""

    def one(entity: str) -> dict:
        documents = Observation()
        docs = read_bronze(spark, f"{root}/bronze", entity, layout=bronze_layout)
        docs = docs.observe(documents, corrupt_count().alias("corrupt"))
        built = SILVER_BUILDERS[entity](docs, ts=ts)
        suite = quality.SUITES.get(entity, [])
        report = quality.write_checked(built, f"{root}/silver/{entity}", entity, suite)
        noted = {"rejected": documents.get["corrupt"]}
        if suite:
            report = materialize(report, "report")  # evaluated once: a row an expectation
            write_layer(report, root, "reports", mode="append")
            noted["held"] = not report.where(~F.coalesce(F.col("success"), F.lit(False))).limit(1).count()
        return noted

    entities = [e for e in SILVER_BUILDERS if not only or e in only]
    found = _run_jobs(spark, root, "silver", [Job(e, lambda e=e: one(e), [f"{root}/bronze/{e}"]) for e in entities], resume)
    rows = [row for row, _ in found]
    checked = {row[1]: (row, noted) for row, noted in found if row[1] in quality.SUITES}
    rows += [("quality", e, "held" in noted, row[3], None, row[5]) for e, (row, noted) in checked.items()]
    return rows, all(noted.get("held", False) for _, noted in checked.values())


class Load(NamedTuple):
    """One table of the warehouse: its rows, its natural key, its identity."""

    build: Callable[[], DataFrame]
    key: list[str]
    inputs: tuple[str, ...]  # datasets of silver and gold
    identity: str | None = None
    partition_by: tuple[str, ...] = ()


def warehouse_loads(spark: SparkSession, root: str, day: str) -> dict[str, Load]:
    """All seven tables from silver and gold (a load of ``day``). Facts of
    earlier seasons are dated by their season, so that (team, group, date)
    stays a key; an event's competitions are told apart by their group."""

    def silver_of(name: str) -> DataFrame:
        return quality.passed(read_table(spark, f"{root}/silver", name))

    def gold_of(name: str) -> DataFrame:
        return read_table(spark, f"{root}/gold", name)

    def team_performance() -> DataFrame:
        summary = gold_of("team_performance_summary")
        date = warehouse.season_date(F.col("season"), day) if "season" in summary.columns else day
        return warehouse.fact_team_performance(summary, date, key=False)

    def dates() -> DataFrame:
        """Every day from the first to the last one that a fact names."""
        summary = gold_of("team_performance_summary")
        seasons = warehouse.season_date(F.col("season"), day) if "season" in summary.columns else F.lit(day).cast("date")
        found = summary.select(seasons.alias("d"))
        for name, column in (("events", "event_date"), ("player_stats", "date_id")):
            if versions.commits.names(spark, f"{root}/silver/{name}"):  # an entity may not have landed yet
                found = found.unionByName(silver_of(name).select(F.col(column).try_cast("date").alias("d")))
        return warehouse.dim_dates(F.min("d"), F.max("d"), source=found)

    summary, players = "gold/team_performance_summary", "gold/player_analytics"
    return {
        "dim_teams": Load(lambda: warehouse.dim_teams(silver_of("teams")), ["team_id"], ("silver/teams",)),
        "dim_players": Load(lambda: warehouse.dim_players(gold_of("player_analytics")), ["player_id"], (players,)),
        "dim_groups": Load(lambda: warehouse.dim_groups(silver_of("standings")), ["group_id"], ("silver/standings",)),
        "dim_dates": Load(dates, ["date_id"], (summary, "silver/events", "silver/player_stats")),
        "fact_team_performance": Load(team_performance, ["team_id", "group_id", "date_id"], (summary,), "performance_id", ("date_id",)),
        "fact_player_stats": Load(lambda: warehouse.fact_player_stats(silver_of("player_stats"), key=False),
                                  ["player_id", "team_id", "date_id"], ("silver/player_stats",), "stat_id"),
        "fact_match_results": Load(lambda: warehouse.fact_match_results(silver_of("events"), key=False),
                                   ["event_id", "group_id"], ("silver/events",), "match_id"),
    }


def load_warehouse(spark: SparkSession, root: str, *, ts: str, resume: bool = False) -> list[tuple]:
    """Reload the tables of the warehouse; each load is a new version. Rows
    of earlier loads keep created_at and their identity value. Rows without
    a key are left out and counted; of rows that share one the greatest is
    loaded. They are grouped and counted in one pass and written once; the
    checks and the load read what is written."""
    version = "".join(c for c in ts if c.isdigit())

    def one(name: str, load: Load) -> dict:
        grouped = materialize(warehouse.one_row_per_key(load.build(), load.key, count="_rows"), name)
        versions.reload(spark, f"{root}/warehouse", name, require_not_null(grouped, *load.key).drop("_rows"), load.key,
                        version=version, ts=ts, identity=load.identity, partition_by=load.partition_by)
        keyless = grouped.where(functools.reduce(operator.or_, (F.col(c).isNull() for c in load.key)))
        return {"rejected": keyless.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).first()["n"]}

    jobs = [Job(n, lambda n=n, x=x: one(n, x), [f"{root}/{i}" for i in x.inputs])
            for n, x in warehouse_loads(spark, root, ts[:10]).items()]
    return [row for row, _ in _run_jobs(spark, root, "warehouse", jobs, resume)]


def warehouse_views(spark: SparkSession, root: str) -> dict[str, Callable[[], DataFrame]]:
    """The reporting views over the loaded warehouse (G1-G4, E5, E7, I1):
    current versions of its tables; of the team facts the newest date alone,
    by its partition, where the view asks for the newest snapshot."""
    place = f"{root}/warehouse"

    def table(name: str) -> DataFrame:
        return versions.read_current(spark, place, name)

    def newest() -> DataFrame:
        return versions.read_newest(spark, place, "fact_team_performance", "date_id")

    return {
        "v_team_performance_summary": lambda: views.v_team_performance_summary(
            newest(), table("dim_teams"), table("dim_groups"), newest=False),
        "v_group_standings": lambda: views.v_group_standings(newest(), table("dim_teams"), table("dim_groups"), newest=False),
        "v_recent_matches": lambda: views.v_recent_matches(table("fact_match_results"), table("dim_teams"), table("dim_groups")),
        "top_scorers": lambda: views.top_scorers(table("fact_player_stats"), table("dim_players"), table("dim_teams")),
        "data_quality_check": lambda: views.data_quality_check(
            table("dim_teams"), table("dim_players"), table("fact_team_performance")),
        "table_metrics": lambda: views.table_metrics(table("fact_team_performance"), table("fact_player_stats")),
    }


def run_pipeline(spark: SparkSession, root: str, *, ts: str | None = None, bronze_layout: str = "lines",
                 gate: bool = False, export_format: str = "csv", resume: bool = False) -> DataFrame:
    """Bronze → silver → quality report → gold → warehouse load → export,
    one session. Returns the status rows (one per dataset, with the whole
    error of those that failed). With ``gate`` the layers after the report
    run only if every expectation held; with ``resume`` datasets that an
    earlier run built from the same files are skipped, so that a run after a
    failure does what is left."""
    stamp = ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()
    rows, passed = run_silver(spark, root, ts=ts, bronze_layout=bronze_layout, resume=resume)
    if passed or not gate:
        rows += run_layer(spark, "gold", root, ts=ts, resume=resume)
        rows += load_warehouse(spark, root, ts=stamp, resume=resume)
        done = [name for layer, name, ok, _, _, skipped in rows if layer == "gold" and ok and not skipped]
        exported = export_all(spark, {n: lambda n=n: read_table(spark, f"{root}/gold", n) for n in done},
                              root, export_format, ts=stamp)
        rows += [("export", r["dataset"], r["status"] == "success", r["error"], None, False) for r in exported.collect()]
    return spark.createDataFrame(rows, RUN_STATUS)
