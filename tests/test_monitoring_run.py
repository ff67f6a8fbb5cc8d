"""Alarm fixtures (FIXTURES A11) and the layer jobs."""

import datetime as dt
import json
import os

from pitchline.plans import monitoring as M
from pitchline.plans.run import run_pipeline


def metrics(spark, rows):
    return spark.createDataFrame(rows, "ts timestamp_ntz, metric_name string, value double")


def test_missing_window_is_breaching(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=h), "PipelineExecution", 1.0) for h in (0, 1, 13, 19)]
    r = M.alarm_missing_window(metrics(spark, rows), ["PipelineExecution", "Absent"], t0, t0 + dt.timedelta(hours=30),
                               period_s=21600, threshold=1.0).collect()
    state = {(x.window_start - t0).total_seconds() / 3600: (x.missing, x.breaching) for x in r
             if x.metric_name == "PipelineExecution"}
    # the metric stopped after 19 h: the last period is flagged
    assert state == {0: (False, False), 6: (True, True), 12: (False, False), 18: (False, False), 24: (True, True)}
    assert [x.breaching for x in r if x.metric_name == "Absent"] == [True] * 5


def test_values_are_not_rounded(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=300 * i), "cpu", 80.004) for i in range(2)]
    assert [x.alarm for x in M.alarm_consecutive(metrics(spark, rows)).orderBy("window_start").collect()] == [False, True]


def test_two_hot_periods_in_a_row(spark):
    t0 = dt.datetime(2024, 1, 1)
    vals = [50, 90, 95, 20, 85, 99, 99]   # one 300 s period each; period 5 missing
    rows = [(t0 + dt.timedelta(seconds=300 * i + 10), "cpu", float(v)) for i, v in enumerate(vals)
            if i != 5]
    r = {x.window_start: x for x in M.alarm_consecutive(metrics(spark, rows)).collect()}
    alarms = [(k - t0).seconds // 300 for k, x in sorted(r.items()) if x.alarm]
    assert alarms == [2]          # 1-2 hot in a row; 4 then gap then 6 does not count


def test_error_logs_newest_first(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(minutes=i), "ERROR x" if i % 3 == 0 else "INFO y", 1)
            for i in range(30)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, message string, log_stream long")
    got = [r.event_id for r in M.error_logs(df, n=3).collect()]
    assert got == [27, 24, 21]


def test_run_pipeline(spark, workdir):
    root = f"{workdir}/lake"
    doc = {"metadata": {"ingestion_timestamp": "2024-09-01T00:00:00", "source": "api",
                        "version": "1.0"},
           "data": {"children": [{"id": "A", "name": "Group A", "abbreviation": "A", "standings": {
               "entries": [{"team": {"id": "t1", "name": "Alpha", "abbreviation": "ALP"},
                            "stats": [{"name": "gamesPlayed", "value": 2.0},
                                      {"name": "points", "value": 4.0},
                                      {"name": "goalsFor", "value": 3.0}]}]}}]}}
    os.makedirs(f"{root}/bronze/standings/2024")
    with open(f"{root}/bronze/standings/2024/a.json", "w") as f:
        json.dump(doc, f, indent=2)
    status = {(r.layer, r.dataset): r for r in run_pipeline(
        spark, root, ts="2024-09-01T01:00:00", bronze_layout="document").collect()}
    assert status["silver", "standings"].success
    # no teams landed: an isolated failure, with its cause
    assert not status["silver", "teams"].success and "PATH_NOT_FOUND" in status["silver", "teams"].error
    # the other entities keep their report
    assert status["quality", "standings"].success and not status["quality", "teams"].success
    assert {r.suite for r in spark.read.parquet(f"{root}/reports").collect()} == {"standings"}
    for layer, name in (("gold", "team_performance_summary"), ("gold", "competition_overview"),
                        ("warehouse", "dim_groups"), ("warehouse", "fact_team_performance"),
                        ("export", "team_performance_summary")):
        assert status[layer, name].success, status[layer, name].error
    tps = spark.read.parquet(f"{root}/gold/team_performance_summary").first()
    assert (tps.team_id, tps.overall_rank, tps.dataset_name) == ("t1", 1, "team_performance_summary")
    assert tps.season == "2024"
    # a second run reloads: created_at stays, updated_at moves
    run_pipeline(spark, root, ts="2024-09-02T01:00:00", bronze_layout="document")
    from pitchline.sinks.versions import read_current
    group = read_current(spark, f"{root}/warehouse", "dim_groups").first()
    assert (group.created_at.day, group.updated_at.day) == (1, 2)
    # the gate stops behind a failed report
    gated = run_pipeline(spark, root, ts="2024-09-03T01:00:00", bronze_layout="document", gate=True)
    assert {r.layer for r in gated.collect()} == {"silver", "quality"}


def _land(root, entity, docs):
    os.makedirs(f"{root}/bronze/{entity}/2024", exist_ok=True)
    with open(f"{root}/bronze/{entity}/2024/a.json", "w") as f:
        f.write("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))


def _document(**data):
    return {"metadata": {"ingestion_timestamp": "2024-09-01T00:00:00", "source": "api", "version": "1.0"}, "data": data}


def test_resumed_run_builds_what_is_left(spark, workdir):
    """Corrupt documents and quarantined rows are counted and set apart; a run
    after a failure builds the failed dataset alone."""
    root = f"{workdir}/lake"
    group = {"id": "A", "name": "Group A", "abbreviation": "A", "standings": {"entries": [
        {"team": {"id": "t1", "name": "Alpha", "abbreviation": "ALP"}, "stats": [{"name": "gamesPlayed", "value": 2.0}, {"name": "points", "value": 4.0}]}]}}
    nameless = {**group, "id": None}
    _land(root, "standings", [_document(children=[group]), "{not json", _document(children=[nameless])])
    _land(root, "events", [_document(events=[{"id": "e1", "date": "2024-09-01T18:00Z", "competitions": [
        {"groupId": g, "competitors": [{"homeAway": "home", "teamId": "t1", "score": "1"}, {"homeAway": "away", "teamId": "t2", "score": "0"}]}
        for g in ("A", "B", None)]}])])
    _land(root, "player_stats", [_document(items=[{"playerId": "p1", "teamId": "t1", "date": "2024-09-01", "stats": [{"name": "goals", "value": 2.0}]}])])
    _land(root, "athletes", [_document(items=[{"id": "p1", "fullName": "Ann", "age": "20"}])])
    first = {(r.layer, r.dataset): r for r in run_pipeline(spark, root, ts="2024-09-01T01:00:00").collect()}
    assert first["silver", "standings"].rejected == 1 and not first["silver", "teams"].success
    assert first["warehouse", "fact_match_results"].rejected == 1 and first["warehouse", "dim_dates"].success
    silver = spark.read.parquet(f"{root}/silver/standings")
    assert sorted((r.quality_state, r.broken_rules) for r in silver.collect()) == [
        ("passed", []), ("quarantined", ["expect_column_values_to_not_be_null(group_id)"])]
    assert spark.read.parquet(f"{root}/gold/group_analysis").count() == 1
    from pitchline.sinks.versions import read_current
    matches = read_current(spark, f"{root}/warehouse", "fact_match_results").collect()
    assert sorted(m.group_id for m in matches) == ["A", "B"] and len({m.match_id for m in matches}) == 2
    stats = read_current(spark, f"{root}/warehouse", "fact_player_stats").first()
    assert (stats.goals, stats.assists, str(stats.date_id)) == (2, None, "2024-09-01")

    _land(root, "teams", [_document(items=[{"id": "t1", "name": "Alpha"}])])
    again = {(r.layer, r.dataset): r for r in run_pipeline(spark, root, ts="2024-09-02T01:00:00", resume=True).collect()}
    built = {k for k, r in again.items() if r.success and not r.skipped}
    assert built == {("silver", "teams"), ("quality", "teams"), ("warehouse", "dim_teams")}
    assert again["silver", "standings"].rejected == 1
    last = run_pipeline(spark, root, ts="2024-09-03T01:00:00", resume=True)
    assert last.where("not skipped").count() == 0


def test_pools_do_not_mix_up_rows(spark, workdir):
    from pitchline.plans.run import Job, _run_jobs

    def work(i):
        if i == 3:
            raise RuntimeError("boom")
        return {"rejected": spark.range(i).count()}

    rows = [row for row, _ in _run_jobs(spark, workdir, "layer", [Job(f"d{i}", lambda i=i: work(i), []) for i in range(8)], False)]
    assert [(r[1], r[2], r[4]) for r in rows] == [(f"d{i}", i != 3, None if i == 3 else i) for i in range(8)]
    assert "boom" in rows[3][3]
