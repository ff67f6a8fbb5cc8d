"""Log searches, metric windows and alarms.

Metric series are reduced to fixed windows first (a grouped aggregate with
map-side partial aggregation), so everything after works on at most one
row per (metric, period): a size set by the calendar, not by the volume of
samples. Alarms that treat a *missing* period as breaching need the
periods that have no samples, so a spine of periods is generated from a
stated time range and list of metrics (no cross join) and left-joined to
the windowed values.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.operators.filters import message_like

# The log search patterns and alarm settings of the monitors.
ERROR_PATTERNS = ("ERROR",)
PERF_PATTERNS = ("duration", "processing time")
RESOURCE_PERIOD_S = 300
RESOURCE_THRESHOLD = 80.0
RESOURCE_PERIODS = 2
PIPELINE_PERIOD_S = 21600
PIPELINE_THRESHOLD = 1.0


def newest_logs(logs: DataFrame, patterns: Sequence[str], n: int = 100,
                ts_col: str = "ts", tie: Sequence[str] = ("event_id",)) -> DataFrame:
    """Newest ``n`` log lines containing any pattern; a per-task
    top-k, not a global sort."""
    hits = message_like(logs, patterns)
    return hits.orderBy(F.col(ts_col).desc(), *[F.col(c).asc() for c in tie]).limit(n)


def error_logs(logs: DataFrame, n: int = 100) -> DataFrame:
    return newest_logs(logs, ERROR_PATTERNS, n)


def perf_logs(logs: DataFrame, n: int = 100) -> DataFrame:
    return newest_logs(logs, PERF_PATTERNS, n)


def metric_windows(metrics: DataFrame, period_s: int = RESOURCE_PERIOD_S,
                   ts_col: str = "ts", name_col: str = "metric_name",
                   value_col: str = "value") -> DataFrame:
    """L2: tumbling windows of ``period_s`` seconds per metric with sum,
    average and sample count. Values are summed in their own type, never
    rounded; decimal columns give sums that do not depend on their order."""
    v = F.col(value_col)
    total = F.sum(v)
    w = metrics.groupBy(F.window(ts_col, f"{period_s} seconds").alias("w"), F.col(name_col)).agg(
        total.alias("_sum"), F.count(v).alias("samples"))
    w = w.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                 F.col(name_col).alias("metric_name"),
                 F.col("_sum").cast("double").alias("sum_value"), "samples")
    return w.withColumn("avg_value", F.col("sum_value") / F.col("samples"))


def period_spine(spark: SparkSession, names: Sequence[str], lo: _dt.datetime, hi: _dt.datetime,
                 period_s: int) -> DataFrame:
    """Every period of every named metric that starts in ``[lo, hi)``,
    aligned to the epoch as ``window()`` aligns them. Its size follows the
    calendar and the list of metrics; it reads no data."""
    epoch = _dt.datetime(1970, 1, 1)
    first = int((lo - epoch).total_seconds()) // period_s
    last = -(-int((hi - epoch).total_seconds()) // period_s)
    start = F.timestamp_add("SECOND", F.col("id") * period_s, F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))
    return spark.range(first, max(first, last)).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("metric_name"), start.alias("window_start"))


def alarm_missing_window(metrics: DataFrame, names: Sequence[str], lo: _dt.datetime, hi: _dt.datetime,
                         period_s: int = PIPELINE_PERIOD_S, threshold: float = PIPELINE_THRESHOLD,
                         ts_col: str = "ts", name_col: str = "metric_name",
                         value_col: str = "value") -> DataFrame:
    """L3: ``Sum over the period < threshold`` with missing data treated as
    breaching: one row for every period of ``[lo, hi)`` and every alarmed
    metric, so a metric that stops, or never starts, is flagged as well.
    The samples are scanned once."""
    w = metric_windows(metrics.where(F.col(name_col).isin(list(names))), period_s, ts_col, name_col, value_col)
    spine = period_spine(metrics.sparkSession, names, lo, hi, period_s)
    j = spine.join(w.select("metric_name", "window_start", "sum_value", "samples"),
                   ["metric_name", "window_start"], "left")
    return j.select("metric_name", "window_start",
                    F.coalesce("sum_value", F.lit(0.0)).alias("sum_value"),
                    F.coalesce("samples", F.lit(0)).cast("bigint").alias("samples"),
                    F.col("samples").isNull().alias("missing"),
                    (F.col("samples").isNull() | (F.col("sum_value") < threshold)).alias("breaching"))


def alarm_consecutive(metrics: DataFrame, period_s: int = RESOURCE_PERIOD_S,
                      threshold: float = RESOURCE_THRESHOLD, periods: int = RESOURCE_PERIODS,
                      ts_col: str = "ts", name_col: str = "metric_name",
                      value_col: str = "value") -> DataFrame:
    """``Average over the period > threshold`` for ``periods``
    consecutive periods (missing periods break a run). One row per
    (metric, period with samples) with ``breaching`` and ``alarm``.

    The window runs over the per-period rows (already reduced, so that a
    metric has at most one row a period of the calendar), ordered by
    time within a metric; ``periods - 1`` lags check that the earlier
    periods are the adjacent ones and breached as well."""
    w = metric_windows(metrics, period_s, ts_col, name_col, value_col).select(
        "metric_name", "window_start", "avg_value")
    w = w.withColumn("breaching", F.col("avg_value") > threshold)
    order = Window.partitionBy("metric_name").orderBy("window_start")
    alarm = F.col("breaching")
    for k in range(1, periods):
        prev_start = F.lag("window_start", k).over(order)
        prev_breach = F.lag("breaching", k).over(order)
        adjacent = prev_start == F.col("window_start") - F.make_dt_interval(secs=F.lit(k * period_s))
        alarm = alarm & F.coalesce(adjacent & prev_breach, F.lit(False))
    return w.withColumn("alarm", alarm)


OK, ALARM, NO_DATA = "OK", "ALARM", "INSUFFICIENT_DATA"


def period_states(metrics: DataFrame, names: Sequence[str], lo: _dt.datetime, hi: _dt.datetime, *,
                  period_s: int = RESOURCE_PERIOD_S, threshold: float = RESOURCE_THRESHOLD, above: bool = True,
                  statistic: str = "avg_value", points: int = RESOURCE_PERIODS, out_of: int = RESOURCE_PERIODS,
                  missing: str = "missing", ts_col: str = "ts", name_col: str = "metric_name",
                  value_col: str = "value") -> DataFrame:
    """The alarm's state in every period of ``[lo, hi)`` for each metric:
    ALARM when at least ``points`` of the last ``out_of`` periods breach,
    INSUFFICIENT_DATA when none of them has data, OK otherwise. ``missing``
    says how periods without samples count: "missing" (not at all),
    "breaching" or "notBreaching".

    The window runs over one row per metric and period of the calendar."""
    if missing not in ("missing", "breaching", "notBreaching"):
        raise ValueError(f"unknown treatment of missing data {missing!r}")
    w = metric_windows(metrics.where(F.col(name_col).isin(list(names))), period_s, ts_col, name_col, value_col)
    spine = period_spine(metrics.sparkSession, names, lo, hi, period_s)
    beyond = F.col("value") > threshold if above else F.col("value") < threshold
    instead = {"missing": F.lit(None).cast("boolean"), "breaching": F.lit(True), "notBreaching": F.lit(False)}[missing]
    values = w.select("metric_name", "window_start", F.col(statistic).alias("value"))
    periods = spine.join(values, ["metric_name", "window_start"], "left").select(
        "metric_name", "window_start", "value", F.when(F.col("value").isNull(), instead).otherwise(beyond).alias("breaching"))
    last = Window.partitionBy("metric_name").orderBy("window_start").rowsBetween(1 - out_of, 0)
    breaches, known = F.count_if("breaching").over(last), F.count("breaching").over(last)
    return periods.select("*", F.when(breaches >= points, ALARM).when(known == 0, NO_DATA).otherwise(OK).alias("state"))


def alarm_episodes(states: DataFrame, period_s: int = RESOURCE_PERIOD_S, above: bool = True) -> DataFrame:
    """L3: consecutive periods of one state as one row: first and last period,
    their number, and the worst value (the highest, or the lowest of an alarm
    on low values). Gaps and islands: a period that changes the state starts
    an island, and the running number of starts names it."""
    order = Window.partitionBy("metric_name").orderBy("window_start")
    before = F.lag("state").over(order)
    begins = (before.isNull() | (before != F.col("state"))).cast("int")
    marked = states.withColumn("_begins", begins)
    island = F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0))
    worst = F.max("value") if above else F.min("value")
    found = marked.withColumn("_island", island).groupBy("metric_name", "_island", "state").agg(
        F.min("window_start").alias("started"), F.max("window_start").alias("_last"),
        F.count(F.lit(1)).alias("periods"), worst.alias("worst_value"))
    return found.select("metric_name", "state", "started",
                        (F.col("_last") + F.make_dt_interval(secs=F.lit(period_s))).alias("ended"), "periods", "worst_value")
