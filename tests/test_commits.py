"""Table commits and key ranges under racing, failing and repeated loads."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from pitchline.plans import warehouse
from pitchline.sinks import commits, versions

TS = "2024-01-01 00:00:00"


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v string")


def at_once(jobs):
    out = [None] * len(jobs)

    def run(i):
        try:
            out[i] = jobs[i]()
        except Exception as e:  # noqa: BLE001 - the test looks at it
            out[i] = e

    threads = [threading.Thread(target=run, args=(i,)) for i in range(len(jobs))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


def test_one_of_many_entries_is_published(spark, workdir):
    done = at_once([lambda i=i: commits.put_if_absent(spark, f"{workdir}/log/000000000000.json", str(i)) for i in range(12)])
    assert sorted(done) == [False] * 11 + [True]
    assert commits.read_text(spark, f"{workdir}/log/000000000000.json") == str(done.index(True))
    assert not [n for n in os.listdir(f"{workdir}/log") if n.startswith(".draft")]


def test_racing_writers_one_is_refused(spark, workdir):
    versions.reload(spark, workdir, "t", rows(spark, [(1, "a")]), ["k"], version="1", ts=TS)
    base = versions.manifest(spark, workdir, "t")
    first = versions.read_current(spark, workdir, "t")
    done = at_once([lambda i=i: versions.write_version(first.withColumn("v", F.lit(f"w{i}")), workdir, "t", "2", base) for i in range(2)])
    refused = [i for i, x in enumerate(done) if isinstance(x, commits.Conflict)]
    assert len(refused) == 1
    assert [r.v for r in versions.read_current(spark, workdir, "t").collect()] == [f"w{1 - refused[0]}"]


def test_racing_reloads_lose_no_row(spark, workdir):
    done = at_once([lambda i=i: versions.reload(
        spark, workdir, "t", rows(spark, [(i, f"v{i}"), (100 + i, "x")]), ["k"], version=f"load{i}", ts=TS, identity="sk", retries=8)
        for i in range(4)])
    assert all(isinstance(x, str) for x in done), done
    table = versions.read_current(spark, workdir, "t").collect()
    assert sorted(r.k for r in table) == [0, 1, 2, 3, 100, 101, 102, 103]
    assert len({r.sk for r in table}) == 8


def test_unfinished_folders_are_not_read_and_can_be_dropped(spark, workdir):
    assert not versions.has_version(spark, workdir, "t")
    rows(spark, [(9, "lost")]).write.parquet(f"{workdir}/t/version=0")
    assert not versions.has_version(spark, workdir, "t")
    for i in (1, 2, 3):
        versions.reload(spark, workdir, "t", rows(spark, [(i, f"v{i}")]), ["k"], version=str(i), ts=TS)
    assert sorted(r.k for r in versions.read_current(spark, workdir, "t").collect()) == [1, 2, 3]
    assert sorted(r.k for r in versions.read_current(spark, workdir, "t", 0).collect()) == [1]
    assert versions.drop_old(spark, workdir, "t", keep=2) == ["version=0", "version=1"]
    assert sorted(r.k for r in versions.read_current(spark, workdir, "t").collect()) == [1, 2, 3]


def test_a_load_run_again_changes_nothing(spark, workdir):
    path = versions.reload(spark, workdir, "t", rows(spark, [(1, "a")]), ["k"], version="1", ts=TS)
    assert versions.reload(spark, workdir, "t", rows(spark, [(1, "b")]), ["k"], version="1", ts=TS) == path
    assert versions.manifest(spark, workdir, "t")["version"] == 0
    # one that died after its rows were written takes another folder
    commits.put_if_absent(spark, f"{workdir}/_commits/t/folders/version=2", "")
    rows(spark, [(7, "half")]).write.parquet(f"{workdir}/t/version=2")
    versions.reload(spark, workdir, "t", rows(spark, [(2, "b")]), ["k"], version="2", ts=TS)
    assert sorted(r.k for r in versions.read_current(spark, workdir, "t").collect()) == [1, 2]


def test_key_ranges_never_meet(spark, workdir):
    starts = at_once([lambda i=i: versions.reserve(spark, workdir, "t", f"load{i}", 10 + i, retries=50) for i in range(6)])
    spans = sorted((s, s + 10 + i) for i, s in enumerate(starts))
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert versions.reserve(spark, workdir, "t", "load3", 5) == starts[3]
    assert versions.reserve(spark, workdir, "t", "load3", 500) not in starts


def test_partitioned_table_reads_one_partition(spark, workdir):
    df = rows(spark, [(1, "2024-01-01"), (2, "2024-06-01"), (3, "2024-06-01")]).withColumn("v", F.col("v").cast("date"))
    base = versions.write_version(df, workdir, "t", "1", None, ["v"])
    assert base["partition_by"] == ["v"] and versions.newest_partition(spark, workdir, "t", "v") == "2024-06-01"
    now = versions.read_current(spark, workdir, "t")
    assert now.schema == df.schema
    plan = now.where(F.col("v") == F.lit("2024-06-01").cast("date"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(v" in plan
    assert sorted(r.k for r in now.where("v = date '2024-06-01'").collect()) == [2, 3]


@pytest.mark.parametrize("season,day,date", [
    ("2024-25", "2024-12-31", "2024-12-31"), ("2023-24", "2024-12-31", "2024-06-30"), ("2023", "2024-12-31", "2024-06-30"),
    ("2024", "2025-06-30", "2025-06-30"), ("2024", "2025-07-01", "2025-06-30"), (None, "2024-12-31", "2024-12-31"),
    ("next", "2024-12-31", "2024-12-31")])
def test_season_date(spark, season, day, date):
    df = spark.createDataFrame([(season,)], "s string").select(warehouse.season_date(F.col("s"), day).alias("d"))
    assert str(df.first().d) == date


def test_one_row_per_key(spark):
    df = spark.createDataFrame([(1, "2023", "z"), (1, "2024", "a"), (1, "2024", "b"), (None, "2024", "c")], "k int, season string, v string")
    got = sorted(((r.k or 0), r.v) for r in warehouse.one_row_per_key(df, ["k"], ["season"]).collect())
    assert got == [(0, "c"), (1, "b")]
