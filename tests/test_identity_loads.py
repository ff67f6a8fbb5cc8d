"""Loads of the warehouse at size: what is grouped is written once, and rows
that have their identity are not joined and written again to keep it."""

from pitchline.plans import run
from pitchline.sinks import versions
from pitchline.sinks.files import write_layer

T1, T2 = "2024-01-01T00:00:00", "2024-02-01T00:00:00"


def rows(spark, data):
    return spark.createDataFrame(data, "k long, v string")


def test_first_load_and_reload_of_known_keys_write_no_copy(spark, workdir, monkeypatch):
    monkeypatch.setattr(versions, "materialize", None)  # a call would fail
    args = dict(root=workdir, name="t", key=["k"], identity="sk")
    versions.reload(spark, incoming=rows(spark, [(3, "c"), (1, "a"), (2, None)]), version="1", ts=T1, **args)
    versions.reload(spark, incoming=rows(spark, [(1, "x"), (3, None)]), version="2", ts=T2, **args)
    got = sorted((r.k, r.v, r.sk, r.created_at.month, r.updated_at.month) for r in versions.read_current(spark, workdir, "t").collect())
    assert got == [(1, "x", 0, 1, 2), (2, None, 1, 1, 1), (3, None, 2, 1, 2)]
    assert versions.read_current(spark, workdir, "t").columns == ["k", "v", "sk", "created_at", "updated_at"]


def test_new_keys_get_a_range_of_their_own(spark, workdir):
    args = dict(root=workdir, name="t", key=["k"], identity="sk")
    for load, data in (("1", [(2, "b"), (4, "d")]), ("2", [(1, "a"), (2, "y"), (None, "n")]), ("3", []), ("4", [(4, "z")])):
        versions.reload(spark, incoming=rows(spark, data), version=load, ts=T1, **args)
    got = {r.k: (r.v, r.sk) for r in versions.read_current(spark, workdir, "t").collect()}
    assert {k: v for k, (v, _) in got.items()} == {1: "a", 2: "y", 4: "z", None: "n"}
    assert (got[2][1], got[4][1]) == (0, 1) and {got[1][1], got[None][1]} == {2, 3}


def test_empty_first_load(spark, workdir):
    versions.reload(spark, workdir, "t", rows(spark, []), ["k"], version="1", ts=T1, identity="sk")
    assert dict(versions.read_current(spark, workdir, "t").dtypes)["sk"] == "bigint"
    assert versions.read_current(spark, workdir, "t").count() == 0


def test_grouped_rows_are_read_as_written(spark, workdir, monkeypatch):
    stats = [("p1", "t1", "2024-01-01", "goals", 1.0), ("p1", "t1", "2024-01-01", "assists", 2.0), ("p1", "t1", None, "goals", 5.0),
             (None, "t1", "2024-01-01", "goals", 3.0), (None, "t1", "2024-01-01", "goals", 4.0), (None, None, "2024-01-02", "goals", 4.0)]
    df = spark.createDataFrame(stats, "player_id string, team_id string, date_id string, stat_name string, stat_value double")
    write_layer(df, f"{workdir}/silver", "player_stats")
    loads = {n: x for n, x in run.warehouse_loads(spark, workdir, T1[:10]).items() if n == "fact_player_stats"}
    monkeypatch.setattr(run, "warehouse_loads", lambda *a: loads)
    plans, reload = [], versions.reload

    def spy(spark, root, name, incoming, *a, **k):
        plans.append(incoming._jdf.queryExecution().executedPlan().toString())
        return reload(spark, root, name, incoming, *a, **k)

    monkeypatch.setattr(versions, "reload", spy)
    (status,) = run.load_warehouse(spark, workdir, ts=T1)
    assert status[2:5] == (True, None, 3)  # (p1, t1, null) and two groups without a player
    assert "Aggregate" not in plans[0] and "Scan parquet" in plans[0]
    (row,) = versions.read_current(spark, f"{workdir}/warehouse", "fact_player_stats").collect()
    assert (row.player_id, row.goals, row.assists, row.stat_id) == ("p1", 1, 2, 0)
