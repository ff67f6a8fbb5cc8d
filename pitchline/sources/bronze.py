"""Bronze JSON documents (A1, A4, B1 envelope, data model §1).

Each bronze document is one JSON object ``{metadata: {...}, data: <payload>}``,
either one per line (JSON Lines, what ``land_bronze`` writes) or one
pretty-printed document per file (legacy landing). Schemas are explicit, so reading runs no inference job and the layout of
a field never depends on which files happen to be present. Malformed
documents are kept in ``_corrupt_record`` instead of failing the read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, I, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def _arr(t: T.DataType) -> T.ArrayType:
    return T.ArrayType(t)


# Fields whose shape the payload leaves open (logos, links, status, season,
# position, birth place) are strings: the reader then keeps their whole JSON
# text, so that no nested field is lost.
METADATA = _struct(ingestion_timestamp=S, source=S, version=S)
TEAM_REF = _struct(id=S, name=S, abbreviation=S)
STAT = _struct(name=S, value=D)
ENTRY = _struct(team=TEAM_REF, stats=_arr(STAT))
GROUP = _struct(id=S, name=S, abbreviation=S, standings=_struct(entries=_arr(ENTRY)))

TEAM = _struct(id=S, uid=S, slug=S, location=S, name=S, abbreviation=S, displayName=S,
               shortDisplayName=S, color=S, alternateColor=S, isActive=B, logos=S, links=S)
ATHLETE = _struct(id=S, uid=S, guid=S, firstName=S, lastName=S, fullName=S, displayName=S,
                  shortName=S, weight=S, height=S, age=S, dateOfBirth=S, birthPlace=S,
                  nationality=S, position=S, team=TEAM_REF, jersey=S)
# our schema for a competition and its sides (the payload never pins it)
COMPETITOR = _struct(homeAway=S, teamId=S, score=S)
COMPETITION = _struct(venue=S, attendance=I, groupId=S, competitors=_arr(COMPETITOR))
EVENT = _struct(id=S, uid=S, date=S, name=S, shortName=S, status=S,
                competitions=_arr(COMPETITION), season=S, timeValid=B, links=S)
# our schema for per-player statistics
PLAYER_STATS = _struct(playerId=S, teamId=S, date=S, stats=_arr(STAT))

PAYLOADS: dict[str, T.StructType] = {
    "standings": _struct(children=_arr(GROUP)),
    "teams": _struct(items=_arr(TEAM)),
    "athletes": _struct(items=_arr(ATHLETE)),
    "events": _struct(events=_arr(EVENT)),
    "player_stats": _struct(items=_arr(PLAYER_STATS)),
}


def document_schema(entity: str, corrupt: bool = True) -> T.StructType:
    """The document of an entity; the payload of one without a schema of its
    own is kept as its JSON text."""
    fields = [T.StructField("metadata", METADATA), T.StructField("data", PAYLOADS.get(entity, S))]
    if corrupt:
        fields.append(T.StructField("_corrupt_record", S))
    return T.StructType(fields)


# The landed entities and the keys of their folders.
ENTITY_PARTITIONS: dict[str, tuple[str, ...]] = {
    "standings": ("season",),
    "team_info": ("team_id",),
    "team_performance": ("team_id",),
    "team_results": ("team_id", "season"),
    "athlete_statistics": ("player_id",),
    "athlete_bio": ("player_id",),
    "athlete_season_stats": ("player_id",),
    "athlete_overview": ("player_id",),
}
# Entities of the silver layer that are landed by season as well.
ENTITY_PARTITIONS |= {e: ("season",) for e in ("teams", "athletes", "events", "player_stats")}


def folder_key(path: Column, entity: str, name: str) -> Column:
    """The value of a folder key in a file's path, whether its folder is
    named ``key=value`` or just ``value``; NULL if there is no such folder."""
    at = ENTITY_PARTITIONS.get(entity, ()).index(name)
    folders = F.split(F.regexp_extract(path, f"/{entity}/(.*)/[^/]+$", 1), "/")
    value = F.regexp_replace(F.get(folders, F.lit(at)), f"^{name}=", "")
    return F.when(value != "", value)


# Bronze file layouts: "lines" = one document per line (JSON Lines, what
# land_bronze writes; splittable), "document" = one pretty-printed document
# per file (legacy landing). Parsing a JSON Lines file as one document keeps
# only its first line, so the layout is always stated, never guessed.
LAYOUTS = {"lines": "false", "document": "true"}


def _multiline(layout: str) -> str:
    if layout not in LAYOUTS:
        raise ValueError(f"unknown bronze layout {layout!r}; use one of {sorted(LAYOUTS)}")
    return LAYOUTS[layout]


def _folders(path: str, seasons: Sequence[str] | None) -> str | list[str]:
    if seasons is None:
        return path
    return f"{path}/{{{','.join(f'{s},season={s}' for s in seasons)}}}"


def corrupt_count() -> Column:
    """How many documents are no valid JSON."""
    # the reader wants the parsed columns beside the corrupt one
    return F.count(F.when(F.col("_corrupt_record").isNotNull(), F.struct("metadata", "data")))


def corrupt_documents(bronze: DataFrame) -> DataFrame:
    """One row: documents read, and those that are no valid JSON (kept with
    their text in ``_corrupt_record``)."""
    return bronze.agg(F.count(F.lit(1)).alias("documents"), corrupt_count().alias("corrupt"))


def read_bronze(spark: SparkSession, root: str, entity: str, *, layout: str = "lines",
                schema_entity: str | None = None, seasons: Sequence[str] | None = None) -> DataFrame:
    """A1/A4: all snapshots of one entity under ``root/<entity>/``, with the
    keys of its folders as columns.

    ``recursiveFileLookup`` descends into any folder layout (``season=``
    partition folders or plain ones); ``seasons`` reads those folders only
    (of an entity whose first key is the season); ``layout`` says how documents sit in
    a file (see ``LAYOUTS``). ``asset_name`` is the file name without
    ``.json`` and ``source_file`` the full path, both from the file
    metadata column."""
    schema = document_schema(schema_entity or entity)
    df = (spark.read.schema(schema)
          .option("multiLine", _multiline(layout))
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", "*.json*")
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record")
          .json(_folders(f"{root.rstrip('/')}/{entity}", seasons)))
    path = F.col("_metadata.file_path")
    keys = {k: folder_key(path, entity, k) for k in ENTITY_PARTITIONS.get(entity, ())}
    return df.withColumns(keys | {
        "source_file": path,
        "asset_name": F.regexp_extract(path, r"([^/]+)\.json[^/]*$", 1),
    })
