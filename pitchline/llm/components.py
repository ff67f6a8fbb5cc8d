"""Connected components of a table of links, by alternating large and small
stars; each step is written to the checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.operators.ranking import materialize


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Connect, around each node u, its neighbours to the least of them and
    u: the larger ones (large star) or the smaller ones and u (small star)."""
    if small:  # from each node to its smaller neighbours
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # one row a node and task before the shuffle, however many neighbours
    least = materialize(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    joined = around.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (columns a, b of one type):
    comp is the smallest node of the component."""
    edges = materialize(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = None
    while True:
        edges = materialize(_stars(materialize(_stars(edges, small=False), "large"), small=True), "small")
        now = state(edges)
        if now == before:
            break
        before = now
    # every edge now leads from a node to the least of its component
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return pairs.unionByName(pairs.select(F.col("comp").alias("node"), "comp").distinct())
