"""Join helpers.

Broadcast policy: a hint only for relations whose size is fixed by
definition (a handful of rows at any scale), passed through
:func:`broadcast_fixed` with that bound stated by the caller. All other
joins are left to Catalyst + AQE, which convert a sort-merge join into a
broadcast join only when the *measured* shuffle size is below
``spark.sql.autoBroadcastJoinThreshold`` and split skewed partitions of
sort-merge joins (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_fixed(df: DataFrame) -> DataFrame:
    """Broadcast a relation whose row count is fixed regardless of scale
    (TPC-H ``nation``/``region``, calendar spines of a stated range, per-
    partition offset tables). Never use it for data that grows."""
    return F.broadcast(df)


def _cond(left: DataFrame, right: DataFrame, keys: Sequence[str] | dict[str, str]):
    if isinstance(keys, dict):
        return [left[lk] == right[rk] for lk, rk in keys.items()]
    return [left[k] == right[k] for k in keys]


def fk_violations(fact: DataFrame, dim: DataFrame,
                  keys: Sequence[str] | dict[str, str]) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (G5): left anti join.
    NULL keys are not violations (SQL FK semantics), so they are kept out."""
    lk = list(keys.keys()) if isinstance(keys, dict) else list(keys)
    rk = list(keys.values()) if isinstance(keys, dict) else list(keys)
    present = fact.where(" AND ".join(f"`{c}` IS NOT NULL" for c in lk))
    d = dim.select(*rk)
    return present.join(d, _cond(present, d, keys), "left_anti")


def conform(fact: DataFrame, dim: DataFrame,
            keys: Sequence[str] | dict[str, str]) -> DataFrame:
    """Keep fact rows whose key exists in the dimension (G6): left semi join."""
    rk = list(keys.values()) if isinstance(keys, dict) else list(keys)
    d = dim.select(*rk)
    return fact.join(d, _cond(fact, d, keys), "left_semi")
