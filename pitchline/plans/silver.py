"""Bronze → silver.

Nested payloads are unnested with ``explode``/``inline`` (a per-row
generator: no shuffle), fields are renamed by rule (``prefix`` +
snake_case of the payload name), and the standings stat list is pivoted
with an explicit name list.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.operators.audit import with_audit
from pitchline.operators.reshape import pivot_stats
from pitchline.sources.adapters import STAT_NAMES

STANDINGS_KEYS = ("ingestion_timestamp", "source", "group_id", "group_name",
                  "group_abbreviation", "team_id", "team_name", "team_abbreviation")


def snake(name: str) -> str:
    """camelCase → snake_case (``shortDisplayName`` → ``short_display_name``)."""
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def _explode(col: Column | str, outer: bool) -> Column:
    return F.explode_outer(col) if outer else F.explode(col)


def envelope_columns(bronze: DataFrame) -> list[Column]:
    """Snapshot time and source, and the season of the folder if it is known."""
    season = [F.col("season")] if "season" in bronze.columns else []
    return [F.col("metadata.ingestion_timestamp").alias("ingestion_timestamp"),
            F.col("metadata.source").alias("source"), *season]


def explode_standings(bronze: DataFrame, *, outer: bool = False) -> DataFrame:
    """Groups → entries → stats, one row per (group, team, stat).

    ``outer=False`` drops a group without entries and a team without stats
    (``explode`` of an empty or NULL array emits nothing); ``outer=True``
    keeps them with NULL stats."""
    g = bronze.select(*envelope_columns(bronze), _explode("data.children", outer).alias("g"))
    first = [c for c in g.columns if c != "g"]
    e = g.select(*first,
                 F.col("g.id").alias("group_id"), F.col("g.name").alias("group_name"),
                 F.col("g.abbreviation").alias("group_abbreviation"),
                 _explode("g.standings.entries", outer).alias("e"))
    s = e.select(*first, "group_id", "group_name", "group_abbreviation",
                 F.col("e.team.id").alias("team_id"), F.col("e.team.name").alias("team_name"),
                 F.col("e.team.abbreviation").alias("team_abbreviation"),
                 _explode("e.stats", outer).alias("s"))
    return s.select(*first, *STANDINGS_KEYS[2:], F.col("s.name").alias("stat_name"),
                    F.col("s.value").alias("stat_value"))


def silver_standings(bronze: DataFrame, *, ts: str | None = None) -> DataFrame:
    """Exploded stats pivoted to one column per stat name + audit; stats
    of other names go to the map ``other_stats``."""
    long = explode_standings(bronze)
    keys = [c for c in long.columns if c not in ("stat_name", "stat_value")]
    wide = pivot_stats(long, STAT_NAMES, keys=keys, others="other_stats")
    return with_audit(wide, "silver", None, ts)


def explode_items(bronze: DataFrame, path: str = "data.items", *, outer: bool = False,
                  alias: str = "item") -> DataFrame:
    """Envelope columns + one row per element of an item list."""
    return bronze.select(*envelope_columns(bronze), _explode(path, outer).alias(alias))


def renamed_fields(struct_type: T.StructType, prefix: str, *, source: str = "item",
                   skip: tuple[str, ...] = ()) -> list[Column]:
    """``item.someField`` → ``<prefix>_some_field`` for every field."""
    return [F.col(f"{source}.{f.name}").alias(f"{prefix}_{snake(f.name)}")
            for f in struct_type.fields if f.name not in skip]


def _items_type(bronze: DataFrame, path: str) -> T.StructType:
    t: T.DataType = bronze.schema
    for part in path.split("."):
        t = t[part].dataType  # type: ignore[index]
    assert isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType)
    return t.elementType


def silver_items(bronze: DataFrame, prefix: str, path: str = "data.items",
                 *, ts: str | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """Flatten an item list, renaming every payload field by rule."""
    fields = renamed_fields(_items_type(bronze, path), prefix, skip=skip)
    items = explode_items(bronze, path)
    flat = items.select(*[c for c in items.columns if c != "item"], *fields)
    return with_audit(flat, "silver", None, ts)


def silver_teams(bronze: DataFrame, *, ts: str | None = None) -> DataFrame:
    """C4: teams (13 payload fields; logos/links stay nested)."""
    return silver_items(bronze, "team", ts=ts)


def silver_athletes(bronze: DataFrame, *, ts: str | None = None) -> DataFrame:
    """Athletes (17 payload fields; ``athlete_team`` stays a struct)."""
    return silver_items(bronze, "athlete", ts=ts)


def silver_events(bronze: DataFrame, *, ts: str | None = None) -> DataFrame:
    """Events (10 payload fields; status/competitions/season nested)."""
    return silver_items(bronze, "event", path="data.events", ts=ts)


def silver_player_stats(bronze: DataFrame, *, ts: str | None = None) -> DataFrame:
    """Player statistics, one row per (player, team, date, stat); a player
    without any keeps one row of NULL stats."""
    items = explode_items(bronze)
    first = [c for c in items.columns if c != "item"]
    long = items.select(
        *first, F.col("item.playerId").alias("player_id"), F.col("item.teamId").alias("team_id"),
        F.col("item.date").alias("date_id"), _explode("item.stats", True).alias("s"))
    flat = long.select(*[c for c in long.columns if c != "s"], F.col("s.name").alias("stat_name"),
                       F.col("s.value").alias("stat_value"))
    return with_audit(flat, "silver", None, ts)


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every nested struct field becomes a top-level column named by
    its path (``a.b.c``); arrays and maps stay as they are. Pure schema
    walk → one projection; no job."""
    cols: list[Column] = []

    def walk(t: T.StructType, path: list[str]) -> None:
        for f in t.fields:
            p = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, p)
            else:
                ref = F.col(p[0])
                for name in p[1:]:
                    ref = ref.getField(name)
                cols.append(ref.alias(sep.join(p)))

    walk(df.schema, [])
    return df.select(*cols)
