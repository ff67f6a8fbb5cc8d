"""Open payloads (C4-C6): documents as VARIANT, and what lies outside the
contract.

The silver builders read the fields they know, with explicit schemas. Here a
document is read whole into one VARIANT column, so no field is lost and none
has to be known; fields are taken out by path, and a report lists every
field that the items really have against the contract: how often, with which
types, and whether the contract names it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.sources.bronze import LAYOUTS, PAYLOADS

#: Where the items of an entity's documents lie.
ITEMS = {"teams": "items", "athletes": "items", "events": "events", "player_stats": "items", "standings": "children"}


def read_documents(spark: SparkSession, root: str, entity: str, *, layout: str = "lines") -> DataFrame:
    """All documents of an entity, each as one VARIANT column ``document``."""
    return (spark.read.option("singleVariantColumn", "document").option("multiLine", LAYOUTS[layout])
            .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*").json(f"{root.rstrip('/')}/{entity}"))


def items(documents: DataFrame, entity: str) -> DataFrame:
    """One row per item, as VARIANT column ``item``; documents of another
    shape have none."""
    path = f"$.data.{ITEMS[entity]}"
    found = documents.select(F.try_variant_get("document", path, "array<variant>").alias("items"))
    return found.select(F.explode("items").alias("item"))


def field(path: str, kind: str, item: str = "item") -> Column:
    """A field of an item by path (``a.b[0].c``); NULL where it is missing or
    not of that type."""
    return F.try_variant_get(item, f"$.{path}", kind)


def contract(entity: str) -> list[str]:
    """The fields of an item that the silver builders know."""
    found = PAYLOADS[entity][ITEMS[entity]].dataType
    assert isinstance(found, T.ArrayType) and isinstance(found.elementType, T.StructType)
    return found.elementType.fieldNames()


def drift_report(documents: DataFrame, entity: str) -> DataFrame:
    """One row per field of the items or of the contract: occurrences, those
    that are JSON null, the type that holds all of its values, and whether
    the contract has it. A field of the contract that never occurs has 0.

    One pass: items are exploded in their own rows, and grouped by the name
    of a field, which partial aggregates reduce to a row a field and task."""
    spark = documents.sparkSession
    each = items(documents, entity)
    fields = each.lateralJoin(spark.tvf.variant_explode(F.col("item").outer())).select("key", "value").where(F.col("key").isNotNull())
    seen = fields.groupBy(F.col("key").alias("field")).agg(
        F.count(F.lit(1)).alias("occurrences"), F.count_if(F.is_variant_null("value")).alias("nulls"),
        F.schema_of_variant_agg("value").alias("type"))
    known = spark.createDataFrame([(f,) for f in contract(entity)], "field string").withColumn("in_contract", F.lit(True))
    none = F.lit(0).cast("bigint")
    return seen.join(known, "field", "full_outer").select(
        F.lit(entity).alias("entity"), "field", F.coalesce("in_contract", F.lit(False)).alias("in_contract"),
        F.coalesce("occurrences", none).alias("occurrences"), F.coalesce("nulls", none).alias("nulls"), "type")
