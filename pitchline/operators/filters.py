"""Filters and predicates."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Conjunctive NOT NULL filter (D1); pushed to the Parquet scan as
    ``IsNotNull`` when the columns come straight from it."""
    cond = None
    for c in cols:
        p = F.col(c).isNotNull()
        cond = p if cond is None else cond & p
    return df if cond is None else df.where(cond)


def latest_snapshot(df: DataFrame, date_col: str, by: Sequence[str] | None = None, *,
                    newest: Column | None = None) -> DataFrame:
    """Rows of the newest snapshot (D3).

    ``by=None``: ``WHERE d = (SELECT max(d) FROM df)`` as an uncorrelated
    scalar subquery, planned once; where the newest date is known more cheaply
    (from partition names, or from the column alone before ``df`` was joined
    and summed), ``newest`` takes its place. With ``by``: the newest snapshot per key,
    as a grouped max (map-side partial aggregate, one row per key) joined
    back null-safely; no window, so a hot key is not one task."""
    if not by:
        return df.where(F.col(date_col) == (df.select(F.max(date_col)).scalar() if newest is None else newest))
    newest = df.groupBy(*by).agg(F.max(date_col).alias("_pl_max"))
    newest = newest.select(*(F.col(c).alias(f"_pl_k_{i}") for i, c in enumerate(by)), "_pl_max")
    cond = [df[c].eqNullSafe(newest[f"_pl_k_{i}"]) for i, c in enumerate(by)]
    cond.append(df[date_col] == newest["_pl_max"])
    return df.join(newest, cond, "left_semi")


def param_filters(df: DataFrame, *, season: str | None = None, season_col: str = "season",
                  groups: Iterable | None = None, group_col: str = "group_id",
                  teams: Iterable | None = None, team_col: str = "team_id",
                  extra: dict[str, Iterable] | None = None) -> DataFrame:
    """Dashboard parameters (D6, D7, D9): equality on season, multi-select
    on group/team/any column; ``None`` means "all" (no predicate)."""
    out = df
    if season is not None:
        out = out.where(F.col(season_col) == F.lit(season))
    if groups is not None:
        out = out.where(F.col(group_col).isin(list(groups)))
    if teams is not None:
        out = out.where(F.col(team_col).isin(list(teams)))
    for col, values in (extra or {}).items():
        out = out.where(F.col(col).isin(list(values)))
    return out


def last_n_days(df: DataFrame, ts_col: str, days: int = 30,
                as_of: _dt.datetime | _dt.date | str | Column | None = None) -> DataFrame:
    """Date-range filter: ``as_of - days <= ts <= as_of``.

    ``as_of`` defaults to the newest ``ts`` in the data (a scalar
    subquery), so results are reproducible; pass a literal for wall-clock
    behaviour."""
    ts = F.col(ts_col)
    if as_of is None:
        end = df.select(F.max(ts_col)).scalar()
    elif isinstance(as_of, Column):
        end = as_of
    else:
        end = F.lit(as_of)
    return df.where((ts >= end - F.make_interval(days=F.lit(days))) & (ts <= end))


def message_like(df: DataFrame, patterns: Sequence[str], col: str = "message") -> DataFrame:
    """Rows whose message contains any of the substrings (D4, D5); a plain
    ``contains`` OR-chain, which Parquet can push down as ``StringContains``."""
    cond = None
    for p in patterns:
        c = F.col(col).contains(p)
        cond = c if cond is None else cond | c
    return df.where(cond)
