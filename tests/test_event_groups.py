"""Silver events of the flow are grouped where their rows are joined, before
they are nested."""

import datetime as dt

from pitchline.catalog.queries import _one_event
from pitchline.plans import warehouse
from pitchline.sources import adapters as A
from pitchline.sources.tables import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def league(spark, root):
    """Three nations; orders 1, 2 (a key that repeats) and 3, whose lines
    differ in date, venue and in texts that sort unlike their numbers."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")

    day = [dt.datetime(2024, 1, d) for d in range(1, 4)]
    put("nation", [(0, "A", 0), (1, "B", 9), (2, "C", 10)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(1, 0), (2, 1)], "c_custkey long, c_nationkey int")
    put("supplier", [(1, 1), (2, 2), (3, 0), (None, 1)], "s_suppkey long, s_nationkey int")
    put("part", [(1, "x"), (2, None), (3, "y")], "p_partkey long, p_brand string")
    put("orders", [(1, 1, "F"), (2, 1, "O"), (2, 2, None), (3, 2, "P")], "o_orderkey long, o_custkey long, o_orderstatus string")
    lines = [(1, 1, 1, 1, 9.0, day[0]), (1, 3, 2, 10, 1.0, day[0]), (1, 2, 2, 2, 1.0, day[0]), (1, 1, 3, 1, 1.0, day[2]),
             (2, 1, 2, 11, 4.0, day[1]), (2, 1, 2, 4, 4.0, day[1]), (2, 1, 1, 4, 4.0, None), (3, 2, 2, 1, 3.0, None),
             (3, 2, 2, 1, 2.0, None), (4, 1, 1, 1, 1.0, day[0])]
    put("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz")
    return Tables(spark, root)


def test_the_greatest_row_is_that_of_the_nested_rows(spark, workdir):
    t = league(spark, workdir)
    got, want = _one_event(t), warehouse.one_row_per_key(A.events_silver(t), ["event_id"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.schema.simpleString() == want.schema.simpleString()
    first = {r.event_id: r.event_competitions[0] for r in got.collect()}
    assert set(first) == {1, 2, 3} and first[1].venue == "y" and [c.score for c in first[3].competitors] == ["0", "3"]


def test_events_are_grouped_where_they_are_joined(spark, workdir):
    t = league(spark, workdir)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    assert "hashpartitioning(event_id" not in plan(_one_event(t))
