"""Compaction: files stay few, rows stay the same, also when it fails."""

import glob

import pytest
from pyspark.sql import functions as F

from pitchline.sinks import commits, compaction
from pitchline.sinks.files import write_batch


def batch(spark, root, i, n=40):
    write_batch(spark.range(n * i, n * i + n, numPartitions=2).withColumn("v", F.lit(f"b{i}")), root, "t", i)


def rows(spark, root):
    return sorted((r.id, r.v) for r in compaction.read_packed(spark, root, "t").collect())


def files(root):
    return len(glob.glob(f"{root}/t/batch_id=*/*.parquet") + glob.glob(f"{root}/_packed/t/part-*/*.parquet"))


def test_few_files_after_fifty_batches(spark, workdir):
    want = []
    for i in range(50):
        batch(spark, workdir, i)
        want += [(k, f"b{i}") for k in range(40 * i, 40 * i + 40)]
        if i % 10 == 9:
            # a target of a few batches, so that full parts are kept
            compaction.compact(spark, workdir, "t", target=3000)
            assert rows(spark, workdir) == want
            compaction.drop_packed(spark, workdir, "t")
    assert rows(spark, workdir) == want
    parts = commits.newest(spark, f"{workdir}/_packed/t")["parts"]
    size = sum(p["bytes"] for p in parts)
    assert files(workdir) == sum(p["files"] for p in parts) <= 2 * size // 3000 + 2 < 100
    assert compaction.compact(spark, workdir, "t") is None


def test_new_batches_are_read_beside_packed_parts(spark, workdir):
    for i in range(3):
        batch(spark, workdir, i)
    compaction.compact(spark, workdir, "t")
    batch(spark, workdir, 3)
    assert len(rows(spark, workdir)) == 160
    # a part that was written but not published is not read, and goes
    spark.range(5).withColumn("v", F.lit("x")).write.parquet(f"{workdir}/_packed/t/part-lost")
    assert len(rows(spark, workdir)) == 160
    assert any("part-lost" in p for p in compaction.drop_packed(spark, workdir, "t"))
    assert len(rows(spark, workdir)) == 160


def test_racing_compactions(spark, workdir, monkeypatch):
    batch(spark, workdir, 0)
    batch(spark, workdir, 1)
    size = compaction._bytes

    def other_first(df):
        monkeypatch.setattr(compaction, "_bytes", size)
        compaction.compact(spark, workdir, "t")
        return size(df)

    monkeypatch.setattr(compaction, "_bytes", other_first)
    with pytest.raises(commits.Conflict):
        compaction.compact(spark, workdir, "t")
    assert len(rows(spark, workdir)) == 80
