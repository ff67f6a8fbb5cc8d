"""Lake inventory (A5): bytes and file counts per layer and dataset.

Uses the ``binaryFile`` source selecting only ``path`` and ``length``: the
file contents are never read, and the listing is done by Spark/Hadoop (all
files, no page limit). Layout: ``<root>/<layer>/<dataset>/...``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lake_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    root = root.rstrip("/")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", glob).load(root).select("path", "length"))
    rel = F.regexp_replace("path", r"^.*?" + root.replace(".", r"\.") + "/", "")
    return files.select(
        "path", "length",
        F.regexp_extract(rel, r"^([^/]+)/", 1).alias("layer"),
        F.regexp_extract(rel, r"^[^/]+/([^/]+)", 1).alias("dataset"))


def lake_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Per (layer, dataset): file count and total bytes; hidden/marker
    files (``_SUCCESS``, ``.crc``) excluded."""
    f = lake_files(spark, root).where(~F.regexp_extract("path", r"[^/]+$", 0).rlike(r"^[._]"))
    return f.groupBy("layer", "dataset").agg(F.count(F.lit(1)).alias("files"),
                                             F.sum("length").alias("bytes"))


def layer_datasets(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """Dataset names of one layer (what an export lists)."""
    return lake_inventory(spark, root).where(F.col("layer") == layer).select("dataset")
