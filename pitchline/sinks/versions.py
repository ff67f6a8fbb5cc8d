"""Versioned tables on plain Parquet (K9 reloads, K8 identities).

A load writes its rows into a folder of its own and then publishes a
manifest: the folder, its schema and the version it was built from
(:mod:`pitchline.sinks.commits`). Only what a manifest names is ever read,
so a load that dies, or is refused because another one was faster, leaves
the table as it was. Readers take the schema from the manifest: no footer is
read to find it, and old versions are not touched. Old folders stay until
:func:`drop_old`.

Layout: ``<root>/<name>/version=<load>/`` rows, ``<root>/_commits/<name>/``
manifests, ``<root>/_keys/<name>/`` the ledger of reserved key ranges.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.operators.ranking import materialize, numbered, sorted_rows
from pitchline.plans.warehouse import upsert
from pitchline.sinks import commits

VERSION_COL = "version"
#: So many loads back, a load that is run again is recognised.
REMEMBERED = 100


def _log(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_commits/{name}"


def _ledger(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_keys/{name}"


def manifest(spark: SparkSession, root: str, name: str, version: int | None = None) -> dict | None:
    """The manifest of a version, or of the current one (None: no load yet)."""
    log = _log(root, name)
    return commits.newest(spark, log) if version is None else commits.entry(spark, log, version)


def has_version(spark: SparkSession, root: str, name: str) -> bool:
    return manifest(spark, root, name) is not None


def write_version(df: DataFrame, root: str, name: str, load: str, base: dict | None,
                  partition_by: Sequence[str] = ()) -> dict:
    """Write the rows of ``load`` and publish them as the version after
    ``base``, the manifest they were built from (None: the first). Raises
    :class:`commits.Conflict` if there is another version by now."""
    spark = df.sparkSession
    root = root.rstrip("/")
    number = base["version"] + 1 if base else 0
    folder = f"{VERSION_COL}={load}"
    # the folder of an earlier attempt, finished or not, is never written again
    if not commits.put_if_absent(spark, f"{_log(root, name)}/folders/{folder}", ""):
        folder = f"{folder}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by).parquet(f"{root}/{name}/{folder}")
    loads = [*(base["loads"] if base else []), load][-REMEMBERED:]
    content = {"folder": folder, "schema": df.schema.jsonValue(), "loads": loads, "partition_by": list(partition_by),
               "parent": base["version"] if base else None}
    commits.publish(spark, _log(root, name), number, content)
    return content | {"version": number}


def read_manifest(spark: SparkSession, root: str, name: str, of: dict) -> DataFrame:
    path = f"{root.rstrip('/')}/{name}/{of['folder']}"
    schema = T.StructType.fromJson(of["schema"])
    # the folder is named like a partition; its own path as the base keeps it out
    return spark.read.schema(schema).option("basePath", path).parquet(path).select(*[f"`{c}`" for c in schema.names])


def read_current(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The rows of the current version, or of an older one."""
    found = manifest(spark, root, name, version)
    if found is None:
        raise FileNotFoundError(f"{root}/{name} has no finished load")
    return read_manifest(spark, root, name, found)


def newest_partition(spark: SparkSession, root: str, name: str, column: str) -> str | None:
    """The greatest value of a partition column (one whose text sorts as its
    values do, such as a date), from the folder names alone."""
    found = manifest(spark, root, name)
    inside = commits.names(spark, f"{root.rstrip('/')}/{name}/{found['folder']}") if found else []
    values = [n.split("=", 1)[1] for n in inside if n.startswith(f"{column}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")]
    return max(values, default=None)


def read_newest(spark: SparkSession, root: str, name: str, column: str) -> DataFrame:
    """The newest partition of the current version (D3): its value comes from
    the folder names, so nothing but that partition is read."""
    newest = newest_partition(spark, root, name, column)
    table = read_current(spark, root, name)
    return table.where(F.col(column) == F.lit(newest).cast(table.schema[column].dataType))


def reserve(spark: SparkSession, root: str, name: str, load: str, count: int, retries: int = 20) -> int:
    """Reserve ``count`` identity values for a load; returns the first. A
    load that asks again for no more gets the same range; ranges of
    different loads never meet, whether the loads succeed or not."""
    log = _ledger(root, name)
    for _ in range(retries):
        last = commits.newest(spark, log)
        held = last["held"] if last else []
        for who, start, size in held:
            if who == load and size >= count:
                return start
        start = last["next"] if last else 0
        content = {"next": start + count, "held": [*held, [load, start, count]][-REMEMBERED:]}
        try:
            commits.publish(spark, log, last["version"] + 1 if last else 0, content)
            return start
        except commits.Conflict:
            continue
    raise commits.Conflict(f"no key range for {name} after {retries} attempts")


def with_identity(incoming: DataFrame, existing: DataFrame | None, root: str, name: str, key: Sequence[str],
                  identity: str, load: str) -> DataFrame:
    """K8: rows whose key is in the table keep its identity value; the others
    are numbered in the order of the key from a range reserved for the load.
    If there are no others, the rows come back without the identity: an
    upsert keeps the columns that only the table has."""
    spark = incoming.sparkSession

    def in_order(fresh: DataFrame) -> DataFrame:
        stored = sorted_rows(fresh, list(key))
        count = stored.count()  # of what is written by now: no column is read
        start = reserve(spark, root, name, load, count) if count else 0
        return numbered(stored, identity).withColumn(identity, F.col(identity) + (start - 1))

    if existing is None:
        return in_order(incoming)
    if not incoming.join(existing.where(F.col(identity).isNotNull()).select(*key), list(key), "left_anti").limit(1).count():
        return incoming
    known = materialize(incoming.join(existing.select(*key, identity), list(key), "left"), "identity")
    return known.where(F.col(identity).isNotNull()).unionByName(in_order(known.where(F.col(identity).isNull()).drop(identity)))


def reload(spark: SparkSession, root: str, name: str, incoming: DataFrame,
           key: Sequence[str], *, version: str, ts: str, identity: str | None = None,
           created_col: str = "created_at", updated_col: str = "updated_at",
           partition_by: Sequence[str] = (), retries: int = 3) -> str:
    """Upsert ``incoming`` into the current version and publish the result as
    load ``version``; the first load stamps both audit columns with ``ts``.
    A load that is already in the table is left as it is. When another load
    is published meanwhile, this one is merged again with its result, up to
    ``retries`` times. Returns the folder of the rows."""
    if incoming.groupBy(*key).count().where("count > 1").limit(1).count():
        raise ValueError(f"keys repeat in the load of {name}")
    for left in range(retries, -1, -1):
        base = manifest(spark, root, name)
        if base and version in base["loads"]:
            return f"{root.rstrip('/')}/{name}/{base['folder']}"
        existing = read_manifest(spark, root, name, base) if base else None
        rows = with_identity(incoming, existing, root, name, key, identity, version) if identity else incoming
        if existing is None:
            stamp = F.lit(ts).cast("timestamp_ntz")
            merged = rows.withColumns({created_col: stamp, updated_col: stamp})
        else:
            merged = upsert(existing, rows, key, ts=ts, created_col=created_col, updated_col=updated_col)
        try:
            return f"{root.rstrip('/')}/{name}/{write_version(merged, root, name, version, base, partition_by)['folder']}"
        except commits.Conflict:
            if not left:
                raise
    raise AssertionError("not reached")


def drop_old(spark: SparkSession, root: str, name: str, keep: int = 2) -> list[str]:
    """Delete the folders that none of the newest ``keep`` manifests names:
    old versions and what unfinished loads left. Run it when no load runs."""
    log = _log(root, name)
    kept = {commits.entry(spark, log, n)["folder"] for n in commits.versions(spark, log)[-keep:]}
    gone = [n for n in commits.names(spark, f"{root.rstrip('/')}/{name}") if n.startswith(f"{VERSION_COL}=") and n not in kept]
    for folder in gone:
        commits.delete(spark, f"{root.rstrip('/')}/{name}/{folder}")
    return gone
