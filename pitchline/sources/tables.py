"""Parquet sources (A2, A3): the driver's tables and any silver/gold layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, root: str, name: str, *,
               merge_schema: bool = False) -> DataFrame:
    """Read one Parquet dataset: a file (``x.parquet``) or a folder of part
    files; ``merge_schema`` unions differing part schemas by column name
    (what a pandas concat of the parts gives)."""
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(f"{root.rstrip('/')}/{name}")


class Tables:
    """Lazy handles on the driver's tables in one scale-factor folder.

    Every attribute is a plain ``spark.read.parquet`` DataFrame, so column
    pruning and filter pushdown reach the scan; a query that names a table
    twice reads its schema once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.sf_dir, f"{name}.parquet")
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.read(name)
        raise AttributeError(name)
