"""Structured Streaming jobs (L1, L4).

L1 replaces "re-read every bronze file every 6 hours" with an incremental
file stream: each new bronze document is processed exactly once (the file
source and its offsets live in the checkpoint), the silver transform runs
per micro-batch through ``foreachBatch``, and each batch lands in its own
partition, so a replayed batch after a failure overwrites itself instead of
appending twice. ``Trigger.AvailableNow`` processes everything new and
stops, which is what a scheduled run wants.

L4 is the windowed metric aggregate as a stream: event-time windows with a
watermark, emitted once per window in append mode; state for windows older
than the watermark is dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitchline.plans import silver
from pitchline.sinks.files import write_batch
from pitchline.sources.bronze import ENTITY_PARTITIONS, LAYOUTS, document_schema, folder_key

SILVER_BUILDERS: dict[str, Callable[..., DataFrame]] = {
    "standings": silver.silver_standings,
    "teams": silver.silver_teams,
    "athletes": silver.silver_athletes,
    "events": silver.silver_events,
    "player_stats": silver.silver_player_stats,
}


def bronze_stream(spark: SparkSession, root: str, entity: str, *, layout: str = "lines",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """New bronze documents of one entity as a stream (explicit schema;
    ``layout`` as for :func:`pitchline.sources.bronze.read_bronze`)."""
    r = (spark.readStream.schema(document_schema(entity))
         .option("multiLine", LAYOUTS[layout]).option("recursiveFileLookup", "true")
         .option("pathGlobFilter", "*.json*"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = r.json(f"{root.rstrip('/')}/{entity}")
    path = F.col("_metadata.file_path")
    return docs.withColumns({k: folder_key(path, entity, k) for k in ENTITY_PARTITIONS.get(entity, ())})


def stream_silver(spark: SparkSession, bronze_root: str, silver_root: str, entity: str,
                  checkpoint: str, *, ts: str | None = None, layout: str = "lines",
                  available_now: bool = True) -> StreamingQuery:
    """L1: incremental bronze → silver for one entity."""
    build = SILVER_BUILDERS[entity]

    def batch(df: DataFrame, batch_id: int) -> None:
        write_batch(build(df, ts=ts), silver_root, entity, batch_id)

    w = (bronze_stream(spark, bronze_root, entity, layout=layout).writeStream
         .foreachBatch(batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="6 hours")
    return w.start()


def stream_metrics(metrics: DataFrame, period: str = "300 seconds",
                   watermark: str = "10 minutes", ts_col: str = "ts",
                   name_col: str = "metric_name", value_col: str = "value") -> DataFrame:
    """L4: event-time window aggregate of a metric stream. In append mode a
    window appears once the watermark has passed it, in update mode with
    every batch that changes it. Values are summed in their own type."""
    v = F.col(value_col)
    ntz = isinstance(metrics.schema[ts_col].dataType, T.TimestampNTZType)
    if ntz:  # watermarks need TIMESTAMP; the session zone maps it back below
        metrics = metrics.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    agg = (metrics.withWatermark(ts_col, watermark)
           .groupBy(F.window(ts_col, period).alias("w"), F.col(name_col).alias("metric_name"))
           .agg(F.sum(v).cast("double").alias("sum_value"),
                F.count(v).alias("samples")))
    back = (lambda c: c.cast("timestamp_ntz")) if ntz else (lambda c: c)
    return agg.select(back(F.col("w.start")).alias("window_start"),
                      back(F.col("w.end")).alias("window_end"),
                      "metric_name", "sum_value", "samples",
                      (F.col("sum_value") / F.col("samples")).alias("avg_value"))


def run_metric_stream(spark: SparkSession, source: str, schema, out_dir: str,
                      checkpoint: str, *, period: str = "300 seconds",
                      watermark: str = "10 minutes", ts_col: str = "ts",
                      name_col: str = "metric_name", value_col: str = "value",
                      max_files_per_trigger: int | None = None,
                      select: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run L4 over every file now under ``source`` (``AvailableNow``) and
    return all windows, those still open at the end included.

    Each micro-batch writes the windows that it changed into its own
    partition (a replayed batch overwrites itself); the newest state of a
    window is that of its greatest batch. Files, offsets and state live in
    shared folders, so a restarted run resumes where it stopped."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    sdf = reader.parquet(source)
    if select is not None:
        sdf = select(sdf)
    windows = stream_metrics(sdf, period, watermark, ts_col, name_col, value_col)
    q = (windows.writeStream.foreachBatch(lambda df, i: write_batch(df, out_dir, "windows", i))
         .option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    rest = [c for c in windows.columns if c not in ("window_start", "metric_name")]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("w")
    out = spark.read.parquet(f"{out_dir}/windows").groupBy("window_start", "metric_name").agg(newest)
    return out.select(*[F.col(c) if c not in rest else F.col(f"w.{c}").alias(c) for c in windows.columns])
