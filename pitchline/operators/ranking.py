"""Ranks and surrogate keys that scale past one partition.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into ONE
task, and ``partitionBy(group)`` puts a whole group into one task, so a hot
group (a third of all rows) or a low group count (25 nations on a 1000-node
cluster) serialises the work. The functions here instead:

1. sort globally (a range shuffle; Spark samples the full composite key, so
   a hot leading key is split over many partitions because the order always
   ends in a unique tie-break),
2. write the sorted rows as a Parquet table into the shared checkpoint
   folder (``spark.checkpoint.dir``), each with its partition and its place
   in it (``monotonically_increasing_id``): lineage is cut, and every later
   pass sees exactly the same rows and places, even after an executor is lost,
3. number each row as (rows in earlier partitions) + its place in its own.
   The order of the partitions is the sort order; their counts are one small
   aggregate with one row per partition (a proven bound, so its broadcast is
   safe), and places and counts meet by a number, not by a file name.

There is one path for every input size. What is ranked is written when the
DataFrame is built, so build ranks only where they are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchline.session import ensure_checkpoint_dir

# monotonically_increasing_id: the partition above 33 bits of place in it.
_PLACE, _PLACE_BITS = "_pl_place", 33


def _as_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def materialize(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back:
    the lineage-cutting step shared by the operators here."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # one folder per application, so a retention job can drop a finished run
    app = spark.sparkContext.applicationId
    path = f"{base}/pitchline/{app}/{tag}-{uuid.uuid4().hex}"
    # Parquet has no void type: an untyped NULL column is stored as string
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    stored = df.withColumns({c: F.col(c).cast("string") for c in void}) if void else df
    stored.write.mode("error").parquet(path)
    # the schema is known: reading it back needs no footer-inference job
    back = spark.read.schema(stored.schema).parquet(path)
    return back.withColumns({c: F.lit(None) for c in void}) if void else back


def sorted_rows(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` in the given total order, written once, with the place of each
    row for :func:`numbered`. To be counted without numbering it."""
    return materialize(df.orderBy(*_as_cols(order)).withColumn(_PLACE, F.monotonically_increasing_id()), "sorted")


def numbered(stored: DataFrame, name: str) -> DataFrame:
    """Add ``name`` = 1..n to :func:`sorted_rows`."""
    cols = [c for c in stored.columns if c != _PLACE]
    rows = stored.withColumn("_pl_part", F.shiftright(_PLACE, _PLACE_BITS))
    # one row per partition: the bound that makes the window and broadcast safe
    sizes = rows.groupBy("_pl_part").agg(F.count(F.lit(1)).alias("_pl_n"))
    before = Window.orderBy("_pl_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pl_part", F.coalesce(F.sum("_pl_n").over(before), F.lit(0)).alias("_pl_off"))
    place = F.col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (rows.join(F.broadcast(offsets), "_pl_part")
            .withColumn(name, (F.col("_pl_off") + place + 1).cast("bigint"))
            .select(*cols, name))


def global_row_number(df: DataFrame, order: Sequence[Column | str],
                      name: str = "row_number") -> DataFrame:
    """Add ``name`` = 1..n in the given total order (include a unique
    tie-break in ``order`` for a deterministic result). Type: bigint."""
    return numbered(sorted_rows(df, order), name)


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[Column | str],
                name: str = "rank") -> DataFrame:
    """``row_number() over (partition by <by> order by <order>)`` (bigint).

    Ranks globally by ``(by, order)`` and subtracts the first global rank of
    each group, so a hot group is spread over many tasks instead of landing
    in one window partition."""
    ranked = global_row_number(df, [*(F.col(c).asc() for c in by), *_as_cols(order)], "_pl_g")
    # first global rank per group: map-side partial min, one row per group
    firsts = ranked.groupBy(*by).agg(F.min("_pl_g").alias("_pl_first"))
    firsts = firsts.select(*(F.col(c).alias(f"_pl_k_{i}") for i, c in enumerate(by)),
                           "_pl_first")
    cond = [ranked[c].eqNullSafe(firsts[f"_pl_k_{i}"]) for i, c in enumerate(by)]
    out = ranked.join(firsts, cond, "inner")
    return (out.withColumn(name, (F.col("_pl_g") - F.col("_pl_first") + 1).cast("bigint"))
            .drop("_pl_g", "_pl_first", *(f"_pl_k_{i}" for i in range(len(by)))))


def surrogate_key(df: DataFrame, order: Sequence[Column | str] | None = None,
                  name: str = "sk", *, dense: bool = False,
                  hash_cols: Sequence[str] | None = None, start: int | Column = 0) -> DataFrame:
    """IDENTITY(1,1)-style key (K8). A warehouse identity column promises
    unique values, not consecutive ones, so the default needs no shuffle:

    * default: ``monotonically_increasing_id`` from ``start`` on - unique
      64-bit ids (partition index in the high bits); a re-run task re-issues
      ids from its own range only, so ids stay unique after a lost executor.
      The ids of one call are unique; a further load of the same table
      starts behind its greatest key (``start``);
    * ``dense=True``: exactly 1..n in ``order`` (a total order), via
      :func:`global_row_number` (a global sort);
    * ``hash_cols``: ``xxhash64`` of the natural key, stable across reloads
      (64-bit: collisions become likely only near 2^32 keys).
    """
    if dense:
        if order is None:
            raise ValueError("a dense surrogate key needs a total order")
        return global_row_number(df, order, name)
    if hash_cols:
        return df.withColumn(name, F.xxhash64(*hash_cols))
    return df.withColumn(name, F.monotonically_increasing_id() + start)
