"""Compaction of micro-batch files.

A stream writes each batch into a folder of its own (``batch_id=<n>``), which
leaves many small files. A compaction packs the rows of the finished batches,
together with packed parts that are still small, into files of about
``target`` bytes, and publishes which parts and which batch they reach to
(:mod:`pitchline.sinks.commits`). Readers take the parts and the batches
after them, so every row is read once, whether a compaction is running, has
died or was refused. Parts that are large already are never written again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.sinks import commits

TARGET = 128 * 1024 * 1024
BATCH = "batch_id"


def _log(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_packed/{name}"


def _batches(spark: SparkSession, root: str, name: str) -> list[int]:
    found = commits.names(spark, f"{root.rstrip('/')}/{name}")
    return sorted(int(n.split("=", 1)[1]) for n in found if n.startswith(f"{BATCH}="))


def _paths(root: str, name: str, batches: list[int]) -> list[str]:
    return [f"{root.rstrip('/')}/{name}/{BATCH}={b}" for b in batches]


def _parts(root: str, name: str, parts: list[dict]) -> list[str]:
    return [f"{root.rstrip('/')}/_packed/{name}/{p['folder']}" for p in parts]


def read_packed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All rows: the packed parts and the batches after them."""
    last = commits.newest(spark, _log(root, name))
    after = last["through"] if last else -1
    rest = [b for b in _batches(spark, root, name) if b > after]
    paths = _paths(root, name, rest)
    if not last:
        return spark.read.parquet(*paths)
    schema = T.StructType.fromJson(last["schema"])
    return spark.read.schema(schema).parquet(*_parts(root, name, last["parts"]), *paths)


def _bytes(df: DataFrame) -> int:
    """The size of the files that hold the rows; their content is not read."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.sum("file_size").alias("n")).first()["n"] or 0


def compact(spark: SparkSession, root: str, name: str, target: int = TARGET) -> dict | None:
    """Pack the batches that are finished by now; returns what was published
    (None if there is nothing to pack). Raises :class:`commits.Conflict` if
    another compaction was faster."""
    last = commits.newest(spark, _log(root, name))
    after = last["through"] if last else -1
    batches = [b for b in _batches(spark, root, name) if b > after]
    if not batches:
        return None
    parts = last["parts"] if last else []
    small = [p for p in parts if p["bytes"] < target * p["files"] // 2]
    kept = [p for p in parts if p not in small]
    source = spark.read.parquet(*_parts(root, name, small), *_paths(root, name, batches))
    size = _bytes(source)
    files = max(1, -(-size // target))
    folder = f"part-{uuid.uuid4().hex}"
    source.repartition(files).write.option("compression", "snappy").parquet(f"{_log(root, name)}/{folder}")
    written = _bytes(spark.read.parquet(f"{_log(root, name)}/{folder}"))
    content = {"parts": [*kept, {"folder": folder, "bytes": written, "files": files}], "through": batches[-1],
               "schema": source.schema.jsonValue()}
    commits.publish(spark, _log(root, name), last["version"] + 1 if last else 0, content)
    return content


def drop_packed(spark: SparkSession, root: str, name: str) -> list[str]:
    """Delete the batches that are packed and parts that no entry names any
    more. Run it when no reader uses an older entry and no compaction runs."""
    last = commits.newest(spark, _log(root, name))
    if not last:
        return []
    used = {p["folder"] for p in last["parts"]}
    gone = _paths(root, name, [b for b in _batches(spark, root, name) if b <= last["through"]])
    gone += [f"{_log(root, name)}/{n}" for n in commits.names(spark, _log(root, name)) if n.startswith("part-") and n not in used]
    for path in gone:
        commits.delete(spark, path)
    return gone
