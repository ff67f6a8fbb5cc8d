"""Operator 12, hard-negative mining by disjoint slots of the score.

Each component x of a vector becomes floor(256 x); the score of two rows is
their integer inner product; higher scores come first, ties by the smaller
vec_id. An anchor's positives are its first ``POSITIVES`` other rows of the
same label. A positive p allows the negatives (rows of another label) with
LOW * p <= 100 * score <= HIGH * p, and gets the first ``NEGATIVES`` of them.

The windows of an anchor's positives overlap. Their upper limits cut the
scores into disjoint slots, so a score belongs to one slot: each task keeps
the best few of each slot, and the tasks' results are combined slot by slot.
The slots from a positive's own downwards, merged in descending order, begin
with the best scores under its limit; its lower limit cuts that list.

Defined results: rows with a null vec_id, label or vector, or with null or
non-finite components (also after the factor 256) take no part; rows equal in
vec_id, label and vector count once, other rows of one vec_id each for
themselves, but never for an anchor of the same vec_id; vectors of different
lengths have no score and do not meet; scores beyond a long end at its
bounds; anchors without positives and positives without negatives give no
rows; an empty table gives an empty result; other columns are not read.

At scale: anchors (a stated share of the rows) meet all rows in the cells of
a grid: groups of about ``ANCHORS`` anchors by groups of about ``ROWS`` rows,
so that a table is copied once for each group of the other side. A task
holds the anchors of one cell, streams its rows through matrix products and
returns a bounded few for each anchor. Groups go by the hash of vec_id, so a
hot label or a common vector is spread evenly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.operators.ranking import materialize

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
ANCHORS, ROWS = 2048, 1 << 20
AT_ONCE = 512  # rows of a matrix product
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, v as whole numbers."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 256)
    sound = F.forall("scaled", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), scaled.alias("scaled"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("scaled").isNotNull() & sound)
    # from 2^52 on, doubles are whole numbers
    whole = F.transform("scaled", lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x))
    return rows.select("vec_id", "label", whole.alias("v")).distinct()


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), size)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact whole inner products of all rows of a and b, within a long."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(whole(a) @ whole(b).T, _LEAST, _MOST).astype(np.int64)


class Best:
    """The first ``k`` (by score, then by id) of each of ``n`` groups."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(n, _LEAST)  # what a newcomer must reach

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        near = score >= self.least[group]
        if not near.any():
            return
        group = np.concatenate([self.group, group[near]])
        score = np.concatenate([self.score, score[near]])
        ids = np.concatenate([self.id, ids[near]])
        order = np.lexsort((ids, ~score, group))  # ~x falls as x rises, without overflow
        group = group[order]
        start = np.concatenate([[True], group[1:] != group[:-1]])
        rank = np.arange(len(group)) - np.maximum.accumulate(np.where(start, np.arange(len(group)), 0))
        keep = rank < self.k
        self.group, self.score, self.id = group[keep], score[order][keep], ids[order][keep]
        full = rank[keep] == self.k - 1
        self.least[self.group[full]] = self.score[full]


class Positives:
    """Best rows of the anchors' own labels; group: the anchor."""

    def __init__(self, anchors: pa.Table, k: int):
        self.best = Best(anchors.num_rows, k)

    def add(self, scores: np.ndarray, same: np.ndarray, other: np.ndarray, ids: np.ndarray) -> None:
        anchor, row = np.nonzero(same & other & (scores >= self.best.least[:, None]))
        self.best.add(anchor, scores[anchor, row], ids[row])

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        return self.best.group, np.zeros(len(self.best.group), np.int64)


class Slots:
    """Best rows of other labels in each slot; group: anchor and slot, slot 0
    being the highest."""

    def __init__(self, anchors: pa.Table, k: int):
        n = anchors.num_rows
        positives = anchors.column("positives").to_pylist()
        self.count = max([len(p) for p in positives] + [1])
        # limits from the highest down; the unused ones repeat the lowest
        self.upper, self.lower = np.full((n, self.count), _LEAST), np.full(n, _MOST)
        for i, found in enumerate(positives):
            limits = sorted({HIGH * p // 100 for p in found}, reverse=True)
            self.upper[i] = limits + [limits[-1]] * (self.count - len(limits))
            self.lower[i] = min(-(-LOW * p // 100) for p in found)
        self.best = Best(n * self.count, k)

    def add(self, scores: np.ndarray, same: np.ndarray, other: np.ndarray, ids: np.ndarray) -> None:
        anchor, row = np.nonzero(~same & other & (scores <= self.upper[:, :1]) & (scores >= self.lower[:, None]))
        score = scores[anchor, row]
        slot = (score[:, None] <= self.upper[anchor]).sum(axis=1) - 1
        # equal limits are one slot, the first of them
        slot = (self.upper[anchor] > self.upper[anchor, slot][:, None]).sum(axis=1)
        self.best.add(anchor * self.count + slot, score, ids[row])

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        return self.best.group // self.count, self.best.group % self.count


def meet(rows: DataFrame, anchors: DataFrame, make: Callable, k: int, wanted: tuple[int, int]) -> DataFrame:
    """(anchor, slot, vec_id, score): what the collectors of ``make`` keep in
    each cell. ``anchors``: node, vec_id, label, v and what ``make`` reads."""
    spark = rows.sparkSession
    n_rows, n_anchors = rows.count(), anchors.count()
    high = max(1, -(-n_anchors // wanted[0]))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wide = max(1, -(-n_rows // wanted[1]), -(-partitions // high))
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    extra = [c for c in anchors.columns if c not in ("node", "vec_id", "label", "v")]
    left = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("j"), (place(high) * wide).alias("i"), "node", "vec_id", "label", "v", *extra)
    right = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("i"), place(wide).alias("j"), "vec_id", "label", "v")
    both = left.select((F.col("i") + F.col("j")).alias("cell"), "node", "vec_id", "label", "v", *extra).unionByName(
        right.select((F.col("i") * wide + F.col("j")).alias("cell"), "vec_id", "label", "v"), allowMissingColumns=True)
    both = both.withColumn("size", F.size("v"))
    # one partition a cell; in it the anchors of each length, then the rows
    dealt = both.repartitionById(high * wide, "cell").sortWithinPartitions("cell", "size", F.col("node").isNull(), "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = anchors = collector = None

        def result() -> Iterator[pa.RecordBatch]:
            if collector is not None and len(collector.best.group):
                anchor, slot = collector.found()
                node = anchors.column("node").to_numpy()
                yield pa.RecordBatch.from_pydict({"anchor": node[anchor], "slot": slot.astype(np.int32),
                                                  "vec_id": collector.best.id, "score": collector.best.score})

        for batch in batches:
            keys = np.array([batch.column("cell").to_numpy(), batch.column("size").to_numpy(),
                             batch.column("node").is_null().to_numpy(zero_copy_only=False)], np.int64)
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if b <= a:
                    continue
                cell, size, is_row = keys[:, a].tolist()
                if (cell, size) != now:
                    yield from result()
                    now, held, anchors, collector = (cell, size), [], None, None
                part = batch.slice(a, b - a)
                if not is_row:
                    held.append(part)
                elif held:
                    if collector is None:
                        anchors = pa.Table.from_batches(held)
                        collector = make(anchors, k)
                        matrix = _matrix(anchors.column("v").combine_chunks(), size)
                        label, own = (anchors.column(c).to_numpy()[:, None] for c in ("label", "vec_id"))
                    for at in range(0, part.num_rows, AT_ONCE):
                        some = part.slice(at, AT_ONCE)
                        scores = products(matrix, _matrix(some.column("v"), size))
                        ids = some.column("vec_id").to_numpy()
                        collector.add(scores, label == some.column("label").to_numpy(), own != ids, ids)
        yield from result()

    return dealt.mapInArrow(run, "anchor long, slot int, vec_id long, score long")


def first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor and slot, of what the cells kept."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def mine(vectors: DataFrame, label: Column, every: int, positives: int = POSITIVES, negatives: int = NEGATIVES,
         anchors_at_once: int = ANCHORS, rows_at_once: int = ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores; anchors are
    the rows whose vec_id is divisible by ``every``."""
    grid = (anchors_at_once, rows_at_once)
    rows = materialize(usable(vectors, label), "vectors")
    anchors = materialize(rows.where(F.col("vec_id") % every == 0).withColumn("node", F.monotonically_increasing_id()), "anchors")
    best = materialize(first(meet(rows, anchors, Positives, positives, grid), positives), "positives")
    limits = best.groupBy("anchor").agg(F.collect_list("score").alias("positives"))  # a few scores an anchor
    asking = materialize(anchors.join(limits, F.col("node") == F.col("anchor")).drop("anchor"), "asking")
    kept = first(meet(rows, asking, Slots, negatives, grid), negatives)
    # slot after slot in descending order: positives x negatives entries at most
    merged = kept.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        F.bitwise_not("score").alias("less"), "vec_id", "score"))).alias("merged"))
    times = lambda c, n: c.cast("decimal(20,0)") * n
    under = F.filter("merged", lambda e: times(e["score"], 100) <= times(F.col("positive_score"), HIGH))
    each = best.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(merged, "anchor")
    each = each.select("anchor", "positive_id", "positive_score", F.posexplode(F.slice(under, 1, negatives)).alias("at", "n"))
    each = each.where(times(F.col("n.score"), 100) >= times(F.col("positive_score"), LOW))
    names = anchors.select(F.col("node").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return each.join(names, "anchor").select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"),
        "positive_score", F.col("n.score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label, every=50)
