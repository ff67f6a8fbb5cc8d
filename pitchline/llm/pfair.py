"""Operator 10, mixing sources to target weights by Pfair scheduling.

The rows of each source, in a seeded random order, are cut into blocks.
Block i of a source with the share w of the weights is released at slot
floor(i/w) and due by slot ceil((i+1)/w). One block is given out a slot, by
earliest deadline among the released ones; since the shares add up to one,
every block meets its window, so at each slot every source has had its
share of the slots to within less than one block.

The weights are taken exactly, as fractions, and one task deals the blocks
slot by slot (:func:`dealt`): it holds one entry a source and writes one row
a block. When a source runs out, a new phase starts with the shares of those
that remain. No row is dropped or repeated. With ``resolution`` given, shares
are rounded to whole numbers of so many slots (each source at least one) and
one period of the schedule, worked out on the driver, is repeated.

Defined results: null and empty sources are one source; sources without a
weight get the least one given; weights must be positive; rows that share
doc_id are told apart by their other columns, and equal rows may stand for
one another; an empty table gives an empty result; very long texts do not
matter, as blocks are counted in rows.

At scale: ranks within the sources come from a range sort of (source, key),
so a hot source is spread over many tasks; rows find their slot by a join on
(source, block). The schedule is sequential: one task takes a step a block.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.common import read_documents
from pitchline.operators.ranking import materialize, rank_within

BLOCK, RESOLUTION, TEMPERATURE, SEED = 8, 1000, 0.5, 17


def whole_shares(weights: dict[str, float], resolution: int) -> dict[str, int]:
    """Whole numbers, 1 at least, that add up to the period and follow the
    weights by largest remainder."""
    period = max(resolution, 4 * len(weights))
    total = math.fsum(weights.values())
    exact = {s: w / total * (period - len(weights)) for s, w in weights.items()}
    out = {s: 1 + math.floor(x) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], s))
    for s in order[:period - sum(out.values())]:
        out[s] += 1
    return out


def edf(shares: dict[str, int]) -> list[str]:
    """The source of every slot of one period."""
    period = sum(shares.values())
    waiting = [(0, s, 0) for s in shares]  # release, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []  # deadline, source, block
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // shares[s]), s, i))
        _, s, i = heapq.heappop(ready)
        out.append(s)
        if i + 1 < shares[s]:
            heapq.heappush(waiting, ((i + 1) * period // shares[s], s, i + 1))
    return out


def schedule(blocks: dict[str, int], weights: dict[str, float], resolution: int = RESOLUTION) -> dict[str, list[dict]]:
    """Per source its phases: first block, number of blocks, first slot of
    the phase, length of the period, slots of the source in the period."""
    out: dict[str, list[dict]] = {s: [] for s in blocks}
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(blocks, 0)
    start = 0
    while left:
        shares = whole_shares({s: weights[s] for s in left}, resolution)
        period = sum(shares.values())
        slots: dict[str, list[int]] = {s: [] for s in left}
        for slot, s in enumerate(edf(shares)):
            slots[s].append(slot)
        end = 1 + min((n - 1) // shares[s] * period + slots[s][(n - 1) % shares[s]] for s, n in left.items())
        for s in list(left):
            n = end // period * shares[s] + bisect_left(slots[s], end % period)
            if n:
                out[s].append({"first": done[s], "n": n, "start": start, "period": period, "slots": slots[s]})
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        start += end
    return out


def slot_of(phases: list[dict], block: int) -> int:
    p = next(p for p in phases if p["first"] <= block < p["first"] + p["n"])
    i = block - p["first"]
    return p["start"] + i // len(p["slots"]) * p["period"] + p["slots"][i % len(p["slots"])]


def dealt(counts: dict[str, int], weights: dict[str, float], block: int = BLOCK) -> Iterator[tuple[str, int, int, int]]:
    """Source, block, slot and first position of every block, in order; the
    sources have ``counts`` rows."""
    exact = {s: Fraction(weights[s]) for s in counts}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    share = {s: int(w * scale) for s, w in exact.items()}
    left, done = dict(counts), dict.fromkeys(counts, 0)
    live = sorted(s for s, n in counts.items() if n)
    slot = position = 0
    while live:
        total, begin = sum(share[s] for s in live), slot
        waiting = [(0, s, 0) for s in live]  # release, source, block of the phase
        ready: list[tuple[int, str, int]] = []  # deadline, source, block of the phase
        while True:
            while waiting and waiting[0][0] <= slot - begin:
                _, s, i = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(i + 1) * total // share[s]), s, i))
            _, s, i = heapq.heappop(ready)
            yield s, done[s], slot, position
            size = min(block, left[s])
            left[s], done[s], slot, position = left[s] - size, done[s] + 1, slot + 1, position + size
            if not left[s]:
                live.remove(s)
                break
            heapq.heappush(waiting, ((i + 1) * total // share[s], s, i + 1))


def slots(spark: SparkSession, counts: dict[str, int], weights: dict[str, float], block: int) -> DataFrame:
    """What :func:`dealt` gives, as a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = dealt(counts, weights, block) if batch.num_rows else iter(())
            while part := list(islice(rows, 50_000)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (
                    pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["_name", "_at", "slot", "_start"])

    return spark.range(0, 1, 1, 1).mapInArrow(run, "_name string, _at long, slot long, _start long")


def positions(rows: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK,
              resolution: int | None = None, seed: int = SEED) -> DataFrame:
    """``rows`` (doc_id, source, ...) with the row's ``slot`` and dense
    ``position`` from 0. Without weights a source of n rows weighs
    n^``TEMPERATURE``."""
    spark = rows.sparkSession
    rows = rows.withColumn("_source", F.coalesce("source", F.lit(""))).withColumn("_mixed", F.xxhash64("doc_id", F.lit(seed)))
    # one row a source
    counts = {r["_source"]: r["n"] for r in rows.groupBy("_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    if weights is None:
        weights = {s: n ** TEMPERATURE for s, n in counts.items()}
    elif min(weights.values(), default=1) <= 0:
        raise ValueError("weights must be positive")
    least = min(weights.values(), default=1.0)
    order = [c for c in ("_mixed", "doc_id", "_copy") if c in rows.columns]
    if resolution is None:
        table = materialize(slots(spark, counts, {s: weights.get(s, least) for s in counts}, block), "slots")
        ranked = rank_within(rows, ["_source"], order, "_rank").withColumn("_block", F.expr(f"(_rank - 1) div {block}"))
        placed = ranked.join(table, (ranked["_source"] == table["_name"]) & (ranked["_block"] == table["_at"]))
        return placed.withColumn("position", F.col("_start") + F.expr(f"(_rank - 1) % {block}")).drop(
            "_source", "_mixed", "_rank", "_block", "_name", "_at", "_start")
    blocks = {s: -(-n // block) for s, n in counts.items()}
    plan = schedule(blocks, {s: weights.get(s, least) for s in counts}, resolution)
    # the last block of a source may be short: rows behind it move up
    short = [(slot_of(plan[s], blocks[s] - 1), blocks[s] * block - n) for s, n in counts.items() if n % block]
    table = spark.createDataFrame(
        [(s, [(p["first"], p["n"], p["start"], p["period"], p["slots"]) for p in phases]) for s, phases in plan.items()],
        "_source string, _phases array<struct<first: long, n: long, start: long, period: long, slots: array<int>>>")
    ranked = rank_within(rows, ["_source"], order, "_rank").withColumn(
        "_block", F.expr(f"(_rank - 1) div {block}"))
    placed = ranked.join(F.broadcast(table), "_source").withColumn("_phase", F.filter(
        "_phases", lambda p: (F.col("_block") >= p["first"]) & (F.col("_block") < p["first"] + p["n"]))[0])
    placed = placed.withColumn("_i", F.col("_block") - F.col("_phase.first")).withColumn(
        "slot", F.expr("_phase.start + (_i div size(_phase.slots)) * _phase.period"
                       " + get(_phase.slots, cast(_i % size(_phase.slots) as int))"))
    missing = F.lit(0).cast("long")
    if short:
        gaps = F.array(*(F.struct(F.lit(s).cast("long").alias("slot"), F.lit(n).cast("long").alias("n")) for s, n in short))
        missing = F.aggregate(gaps, missing, lambda a, g: a + F.when(g["slot"] < F.col("slot"), g["n"]).otherwise(0))
    return placed.withColumn("position", F.col("slot") * block + F.expr(f"(_rank - 1) % {block}") - missing).drop(
        "_source", "_mixed", "_rank", "_block", "_phases", "_phase", "_i")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK,
        resolution: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` in the mixed order (sorted by position), all rows and columns."""
    kept = docs.select("doc_id", "source", F.struct("*").alias("_row"))
    # rows with one doc_id are numbered by content; equal rows may swap
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("_row")))
    kept = kept.withColumn("_copy", copy)
    found = positions(kept.select("doc_id", "source", "_copy"), weights, block, resolution, seed)
    found = found.select(F.col("doc_id").alias("_id"), F.col("_copy").alias("_n"), "position")
    both = kept.join(found, kept["doc_id"].eqNullSafe(found["_id"]) & (kept["_copy"] == found["_n"]))
    return both.orderBy("position").select("_row.*")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(read_documents(spark, sf_dir).select("doc_id", "source"))
