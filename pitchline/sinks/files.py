"""Sinks (B1, B3-B8): bronze landing, layer writes, exports, warehouse.

All writes are distributed DataFrame writes: no ``coalesce(1)`` (AQE sizes
the last stage), no rows through the driver. Re-running a write with the
same arguments gives the same files (overwrite of a dataset folder, or of
one batch partition for appends), so a retried job after a lost executor
does not duplicate data.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()


def envelope(payload: DataFrame, source: str, *, ts: str | None = None,
             version: str = "1.0", keep: Sequence[str] = ()) -> DataFrame:
    """B1: wrap each payload row as ``{metadata: {...}, data: {...}}``;
    ``keep`` columns (partition keys) stay beside the envelope."""
    data_cols = [c for c in payload.columns if c not in keep]
    meta = F.struct(F.lit(ts or _now()).alias("ingestion_timestamp"),
                    F.lit(source).alias("source"), F.lit(version).alias("version"))
    return payload.select(meta.alias("metadata"), F.struct(*data_cols).alias("data"), *keep)


def land_bronze(payload: DataFrame, root: str, entity: str, source: str, *,
                partition_by: Sequence[str] = (), ts: str | None = None,
                compression: str | None = None, mode: str = "append") -> str:
    """B1: land payloads as JSON Lines (one document per line, so the
    plain JSON reader splits files) under ``root/<entity>/k=v/…``."""
    path = f"{root.rstrip('/')}/{entity}"
    w = envelope(payload, source, ts=ts, keep=partition_by).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    w.json(path)
    return path


def write_layer(df: DataFrame, root: str, name: str, *, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """Parquet + snappy; file count is set by the plan, not forced to 1."""
    path = f"{root.rstrip('/')}/{name}"
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def to_flat_text(df: DataFrame) -> DataFrame:
    """Nested columns (struct/array/map) as JSON text, for CSV."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested)
                       else F.col(f.name) for f in df.schema.fields])


def export_metadata(df: DataFrame, name: str, *, ts: str | None = None,
                    records: DataFrame | None = None) -> DataFrame:
    """``{dataset_name, export_timestamp, record_count, columns}`` as a
    one-row DataFrame (the count is a distributed aggregate, over the
    written ``records`` if there are any)."""
    return (df if records is None else records).agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(name).alias("dataset_name"), F.lit(ts or _now()).alias("export_timestamp"),
        "record_count", F.array(*[F.lit(c) for c in df.columns]).alias("columns"))


# Export sub-folders per format.
EXPORT_DIRS = {"csv": "csv", "json": "json", "bi": "bi"}


def export(df: DataFrame, root: str, name: str, fmt: str, *, ts: str | None = None) -> str:
    """One dispatcher for CSV, JSON (+ metadata sidecar) and the
    BI extract (CSV under its own folder). Paths carry ``yyyyMMdd_HHmmss``."""
    stamp_iso = ts or _now()
    stamp = _dt.datetime.fromisoformat(stamp_iso).strftime("%Y%m%d_%H%M%S")
    if fmt not in EXPORT_DIRS:
        raise ValueError(f"unknown export format {fmt!r}")
    path = f"{root.rstrip('/')}/exports/{EXPORT_DIRS[fmt]}/{name}_{stamp}"
    if fmt in ("csv", "bi"):
        to_flat_text(df).write.mode("overwrite").option("header", "true").csv(path)
    else:
        # every key of a record is written; what was written is counted
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path + "/records")
        records = df.sparkSession.read.text(path + "/records")
        export_metadata(df, name, ts=stamp_iso, records=records).write.mode("overwrite").json(path + "/metadata")
    return path


EXPORT_STATUS = T.StructType([T.StructField("dataset", T.StringType()),
                              T.StructField("status", T.StringType()),
                              T.StructField("path", T.StringType()),
                              T.StructField("error", T.StringType())])


def export_all(spark: SparkSession, datasets: dict[str, Callable[[], DataFrame]], root: str,
               fmt: str, *, ts: str | None = None) -> DataFrame:
    """Export every dataset; one failure does not stop the others. The
    loop runs one distributed write per dataset; only the status rows (one
    per dataset) are built on the driver."""
    rows = []
    for name, build in datasets.items():
        try:
            rows.append((name, "success", export(build(), root, name, fmt, ts=ts), None))
        except Exception as e:  # noqa: BLE001 - isolation is the point
            rows.append((name, "failed", None, f"{type(e).__name__}: {e}"))
    return spark.createDataFrame(rows, EXPORT_STATUS)


def write_warehouse(df: DataFrame, table: str, *, mode: str = "overwrite",
                    path: str | None = None, jdbc: dict | None = None) -> None:
    """A catalog table (optionally external at ``path``) or a JDBC
    table (``jdbc`` = url/user/password/driver options)."""
    if jdbc is not None:
        opts = dict(jdbc)
        url = opts.pop("url")
        df.write.mode(mode).jdbc(url, table, properties=opts)
        return
    w = df.write.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def write_batch(df: DataFrame, root: str, name: str, batch_id: int,
                partition_col: str = "batch_id") -> None:
    """Idempotent append for micro-batches: the batch lands in its own
    partition and a replay overwrites exactly that partition."""
    (df.withColumn(partition_col, F.lit(batch_id).cast("bigint")).write
     .mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(f"{root.rstrip('/')}/{name}"))
