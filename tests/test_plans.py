"""Plan checks: pushdown and pruning reach the scan, no Python UDF on any
registered query, top-k and window-group-limit instead of full sorts,
fixed-size dimensions broadcast, big inputs aggregated before joins."""

import pytest

import os

from conftest import SF_SMALL
from pitchline.catalog.queries import ATHLETE_SUITE, QUERIES, athletes
from pitchline.plans import gold, quality
from pitchline.session import ensure_checkpoint_dir
from pitchline.sources import adapters as A
from pitchline.sources.tables import Tables


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_udf(spark, key):
    plan = physical(QUERIES[key](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "MapInArrow",
                 "FlatMapGroupsInPandas", "FlatMapGroupsInArrow", "FlatMapCoGroups"):
        assert node not in plan, f"{key} uses {node}"


def written(spark) -> int:
    base = ensure_checkpoint_dir(spark).removeprefix("file:").rstrip("/")
    return sum(len(files) for _, _, files in os.walk(base))


@pytest.mark.parametrize("key", ["kpi_points_per_game", "dim_groups", "audit_columns", "competition_overview",
                                 "team_stats_table", "team_vs_average", "head_to_head"])
def test_building_writes_nothing(spark, key):
    before = written(spark)
    QUERIES[key](spark, SF_SMALL)
    assert written(spark) == before


def scans(plan: str, table: str) -> int:
    return plan.count(f"{table}.parquet")


def test_tables_are_scanned_once(spark):
    for key, table in (("head_to_head", "lineitem"), ("alarm_missing_window", "events"), ("last_n_days", "lineitem"),
                       ("latest_snapshot", "lineitem"), ("dq_uniqueness", "lineitem"), ("dq_suite", "customer"), ("alarm_episodes", "events")):
        assert scans(physical(QUERIES[key](spark, SF_SMALL)), table) == 1, key
    for key in ("head_to_head", "team_form", "match_outcome", "score_distribution", "fixture_calendar"):
        assert scans(physical(QUERIES[key](spark, SF_SMALL)), "/part") == 0, key


def test_scan_pushdown_and_pruning(spark):
    plan = physical(QUERIES["scan_parquet"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert ("ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,"
            "l_shipdate:timestamp_ntz>") in plan


def test_top_k_not_full_sort(spark):
    for key in ("v_recent_matches", "error_logs", "top_performers"):
        assert "TakeOrderedAndProject" in physical(QUERIES[key](spark, SF_SMALL)), key


def test_form_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in physical(QUERIES["team_form"](spark, SF_SMALL))


def test_team_totals_aggregate_before_join(spark):
    t = Tables(spark, SF_SMALL)
    plan = optimized(A.t1_base(t))
    # the lineitem aggregate sits below the joins with supplier and nation
    join_at = plan.index("Join Inner")
    agg_at = plan.index("Aggregate [l_suppkey")
    assert agg_at > join_at
    assert "BroadcastHashJoin" in physical(A.t1_base(t))


def test_nested_pruning(spark, workdir):
    athletes(Tables(spark, SF_SMALL)).write.parquet(f"{workdir}/athletes")
    stored = spark.read.parquet(f"{workdir}/athletes")
    plan = physical(gold.team_roster_summary(stored.drop("athlete_name"), sets="count").select("team_id", "total_players"))
    read = plan[plan.index("ReadSchema: "):].split("\n")[0]
    assert read == "ReadSchema: struct<athlete_team:struct<id:string,name:string,abbreviation:string>>"
    assert "struct<athlete_team:struct<id:string>>" in physical(stored.select("athlete_team.id"))


def test_snapshot_of_the_newest_partition(spark):
    for key in ("v_team_performance", "v_group_standings"):
        plan = physical(QUERIES[key](spark, SF_SMALL))
        assert scans(plan, "lineitem") == 0 and "PartitionFilters: [isnotnull(date_id" in plan, key


def test_dates_filter_before_the_sums(spark):
    plan = optimized(QUERIES["latest_snapshot"](spark, SF_SMALL))
    assert plan.index("Aggregate") < plan.index("year(cast(l_shipdate")  # the filter stands below


def test_quality_is_taken_in_the_write(spark):
    source = athletes(Tables(spark, SF_SMALL))
    rows, _ = quality.marked(source, ATHLETE_SUITE)
    plan = physical(rows)
    assert "CollectMetrics" in plan and scans(plan, "customer") == 1 and "Exchange hashpartitioning" not in plan
