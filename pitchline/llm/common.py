"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six white-space characters that separate words.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside sends Python so many rows at once (no more than
    the session's own setting): a batch lies in an executor's memory several
    times, outside the heap and in the worker, and Spark's default of 10,000
    rows is for short ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    own = int(before or 0)
    spark.conf.set(key, str(min(rows, own) if own > 0 else rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def buckets(spark: SparkSession, per_partition: int = 4) -> int:
    """How many buckets a keyed exchange of packed arrays is dealt into:
    a few for each shuffle partition, so that both follow one setting."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
