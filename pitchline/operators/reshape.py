"""Pivot / unpivot of (name, value) stat lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_stats(df: DataFrame, names: Sequence[str], *, keys: Sequence[str] | None = None,
                name_col: str = "stat_name", value_col: str = "stat_value",
                others: str | None = None) -> DataFrame:
    """Long ``(keys…, name, value)`` → one column per stat name.

    The value list is explicit, so Spark runs no extra job to discover it
    and the output schema is fixed; ``max`` keeps duplicates deterministic
    (the payload has one value per name). Stats missing for a key are NULL.
    One hash aggregate with map-side partial aggregation. ``others`` names a
    map column for the values of all other names, so that none is lost."""
    keys = list(keys) if keys is not None else [c for c in df.columns
                                                 if c not in (name_col, value_col)]
    if others is None:
        return df.groupBy(*keys).pivot(name_col, list(names)).agg(F.max(value_col))
    name, value = F.col(name_col), F.col(value_col)
    unknown = F.when(name.isNotNull() & ~name.isin(list(names)), F.struct(name.alias("k"), value.alias("v")))
    wide = df.groupBy(*keys).agg(
        *[F.max(F.when(name == n, value)).alias(n) for n in names],
        F.sort_array(F.collect_set(unknown)).alias(others))
    # of several values of one name the greatest, which is the last one
    last = F.filter(others, lambda x, i: ~F.coalesce(F.get(F.col(others), i + 1)["k"] == x["k"], F.lit(False)))
    return wide.withColumn(others, F.map_from_entries(last))


def unpivot_stats(df: DataFrame, names: Sequence[str], *, keys: Sequence[str] | None = None,
                  name_col: str = "stat_name", value_col: str = "stat_value") -> DataFrame:
    """Inverse of :func:`pivot_stats`; NULL stats are dropped (like an
    exploded payload that does not carry them)."""
    keys = list(keys) if keys is not None else [c for c in df.columns if c not in names]
    long = df.unpivot(keys, list(names), name_col, value_col)
    return long.where(F.col(value_col).isNotNull())
