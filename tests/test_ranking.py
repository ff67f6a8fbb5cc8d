"""Distributed ranks equal the single-partition window, including a hot
key holding a third of the rows and ties broken by a unique id."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchline.operators.ranking import global_row_number, rank_within, surrogate_key


def frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = 0 if i % 3 == 0 else rnd.randint(1, 40)        # group 0 holds a third
        rows.append((i, g, rnd.randint(0, 20), None if i % 97 == 0 else rnd.random()))
    return spark.createDataFrame(rows, "id long, g int, pts int, x double").repartition(6)


def test_global_row_number_matches_window(spark):
    df = frame(spark)
    order = [F.col("pts").desc(), F.col("x").asc_nulls_first(), F.col("id")]
    a = {r.id: r.rn for r in global_row_number(df, order, "rn").collect()}
    b = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert a == b and sorted(a.values()) == list(range(1, 3001))


def test_rank_within_matches_window(spark):
    df = frame(spark)
    order = [F.col("pts").desc(), F.col("id")]
    a = {r.id: r.r for r in rank_within(df, ["g"], order, "r").collect()}
    w = Window.partitionBy("g").orderBy(*order)
    b = {r.id: r.r for r in df.withColumn("r", F.row_number().over(w)).collect()}
    assert a == b


def test_rank_within_null_group_key(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 7), (3, 1, 1)], "id int, g int, p int")
    r = {x.id: x.r for x in rank_within(df, ["g"], [F.col("p").desc(), "id"], "r").collect()}
    assert r == {2: 1, 1: 2, 3: 1}


def test_surrogate_keys(spark):
    df = frame(spark)
    ids = [r.sk for r in surrogate_key(df, name="sk").collect()]
    assert len(set(ids)) == len(ids) == 3000
    dense = sorted(r.sk for r in surrogate_key(df, ["id"], "sk", dense=True).collect())
    assert dense == list(range(1, 3001))


def test_untyped_null_column_survives_materialization(spark):
    df = spark.range(5).select("id", F.lit(None).alias("nothing"))
    out = global_row_number(df, [F.col("id").desc()], "rn").collect()
    assert sorted((r.id, r.rn) for r in out) == [(i, 5 - i) for i in range(5)]
    assert all(r.nothing is None for r in out)


def test_cluster_conf():
    from pitchline.session import cluster_conf
    c = cluster_conf(8000, shuffle_bytes=20 * 2**40, checkpoint_dir="hdfs:///ckpt")
    assert int(c["spark.sql.shuffle.partitions"]) >= 16000
    assert c["spark.checkpoint.dir"] == "hdfs:///ckpt"
    assert c["spark.sql.autoBroadcastJoinThreshold"] == "-1"
