"""Steps that the loads of the warehouse share: one shuffle a grouping, rows
numbered without file names, identities reserved from a plain count."""

import datetime as dt

from pyspark.sql import functions as F

from pitchline.operators.ranking import global_row_number
from pitchline.plans import warehouse
from pitchline.sinks import versions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_player_stats_are_shuffled_once(spark):
    rows = [("p", "t", "2024-01-01", "goals", 1.0), ("p", "t", "2024-01-01", "goals", 3.0), ("p", "t", "2024-01-01", "fouls", 9.0),
            ("q", None, "2024-01-01", None, 5.0), (None, None, None, "assists", 2.0), ("r", "t", "no date", "assists", None)]
    long = spark.createDataFrame(rows, "player_id string, team_id string, date_id string, stat_name string, stat_value double")
    out = warehouse.fact_player_stats(long, key=False)
    assert plan(out).count("Exchange hashpartitioning") == 1
    got = {(r.player_id, r.team_id, r.date_id): (r.goals, r.assists, r.shots) for r in out.collect()}
    day = dt.date(2024, 1, 1)
    assert got == {("p", "t", day): (3, None, None), ("q", None, day): (None, None, None),
                   (None, None, None): (None, 2, None), ("r", "t", None): (None, None, None)}


def test_sides_of_a_match(spark):
    side = "array<struct<homeAway:string,teamId:string,score:string>>"
    sides = [[("away", "a", "2"), None, ("home", "h", "x"), ("home", "z", "9")], [(None, "n", "1"), ("away", "b", "3")], [], None]
    rows = [(i, "2024-01-01", ("F",), [("v", 1, "g", s)]) for i, s in enumerate(sides)]
    events = spark.createDataFrame(rows, f"event_id int, event_date string, event_status struct<name:string>, "
                                         f"event_competitions array<struct<venue:string,attendance:int,groupId:string,competitors:{side}>>")
    out = warehouse.fact_match_results(events, key=False)
    assert "lambda" not in plan(out)
    got = {r.event_id: (r.home_team_id, r.home_score, r.away_team_id, r.away_score) for r in out.collect()}
    assert got == {"0": ("h", None, "a", 2), "1": (None, None, "b", 3), "2": (None, None, None, None), "3": (None, None, None, None)}


def test_rows_are_numbered_without_file_names(spark):
    df = spark.range(1000).withColumn("v", F.hash("id")).repartition(5)
    out = global_row_number(df, ["v", "id"], "n")
    assert "file_name" not in plan(out)
    assert [r.n for r in out.orderBy("v", "id").collect()] == list(range(1, 1001)) and out.columns == ["id", "v", "n"]
    empty = global_row_number(df.where("id < 0"), ["v", "id"], "n")
    assert empty.collect() == [] and dict(empty.dtypes)["n"] == "bigint"


def test_identities_are_reserved_without_numbering_to_count(spark, workdir, monkeypatch):
    seen, number = [], versions.numbered
    monkeypatch.setattr(versions, "numbered", lambda stored, name: seen.append(stored.count()) or number(stored, name))
    df = spark.createDataFrame([(i, str(i)) for i in range(20)], "k long, v string")
    versions.reload(spark, workdir, "t", df, ["k"], version="1", ts="2024-01-01T00:00:00", identity="sk")
    assert seen == [20]
    assert all(r.sk == r.k for r in versions.read_current(spark, workdir, "t").collect())
