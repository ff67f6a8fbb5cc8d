"""Audit columns stamped on every layer write."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_audit(df: DataFrame, layer: str, dataset: str | None = None,
               ts: str | None = None) -> DataFrame:
    """Add ``transformation_timestamp`` (ISO-8601 string), ``data_layer`` and
    ``dataset_name``. ``ts`` is injectable so tests and re-runs are
    reproducible; by default one driver-side timestamp is taken for the
    whole write (a literal, so every task stamps the same value)."""
    stamp = ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()
    cols = {"transformation_timestamp": F.lit(stamp), "data_layer": F.lit(layer)}
    if dataset is not None:
        cols["dataset_name"] = F.lit(dataset)
    return df.withColumns(cols)
