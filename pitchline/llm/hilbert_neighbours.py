"""Operator 9, approximate nearest neighbours by shifted space-filling curves.

Nearness is the largest inner product. Vectors get one more component that
brings all to the same length, so that it becomes an angle; queries, scaled
to that length, get a zero there. For each of ``CURVES`` curves the vectors
are projected by other random directions to ``AXES`` axes, shifted, cut
into cells, and ordered by the cells' places on a Hilbert curve. The order
of all curves is one range sort in Spark; it is cut into runs of ``RUN``
rows, and a query meets its run and the two beside it. The nearest of all
curves are merged and ranked by the exact inner product.

The directions' scales are fitted on ``SAMPLE`` vectors at most; every
vector is indexed. The length of the runs is measured, not assumed: from
``RUN`` rows on it doubles until ``MEASURED`` queries at most, compared with
all vectors, find ``RECALL`` of their nearest (README has figures).

Defined results: vectors that are null, zero, of another length than most,
or hold nulls or non-finite components take no part, nor do rows without
id; equal vectors are one point that carries its smallest ids, so repeated
rows cost nothing; a query never finds its own id; ties go to the smaller
vec_id; an empty table gives an empty result; other columns are not read.

At scale: equal vectors are merged by partial aggregates (a hot vector
sends at most ``TOP`` + 1 ids a task), then keys (not vectors) are sorted,
then each vector moves once a curve to its run; tasks hold one run at a
time and return ``TOP`` + 1 points for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.operators.ranking import global_row_number, materialize

CURVES, AXES, BITS, RUN, TOP, EVERY = 24, 6, 5, 1024, 20, 20
SAMPLE, SEED = 10_000, 41
MEASURED, RECALL = 100, 0.95
EDGE = 3.2  # cells cover so many standard deviations on either side


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n x axes).

    From the highest bit down, the bits of the axes name a corner; the curve
    inside it is a mirrored or exchanged copy of the whole. Undoing these
    copies, then the Gray code, leaves the digits of the place."""
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    for level in range(bits - 1, 0, -1):
        lower = (1 << level) - 1
        for a in range(axes):
            upper = (x[:, a] >> level & 1).astype(bool)
            change = np.where(upper, 0, (x[:, 0] ^ x[:, a]) & lower)
            x[:, 0] ^= np.where(upper, lower, change)
            x[:, a] ^= change
    for a in range(1, axes):
        x[:, a] ^= x[:, a - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] >> level & 1, (1 << level) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for a in range(axes):
            key = key << 1 | (x[:, a] >> level & 1)
    return key


class Curves:
    """Directions, scales and shifts of all curves, from a sample."""

    def __init__(self, sample: np.ndarray, longest: float, curves: int, axes: int, bits: int, seed: int):
        random = np.random.default_rng(seed)
        self.longest, self.bits = longest, bits
        points = self.lifted(sample)
        size = points.shape[1]
        self.axes = min(axes, size)
        self.maps = []
        for _ in range(curves):
            directions = np.linalg.qr(random.standard_normal((size, self.axes)))[0]
            seen = points @ directions
            spread = seen.std(axis=0)
            spread[spread == 0] = 1
            self.maps.append((directions / spread, random.uniform(-0.5, 0.5, self.axes) - (seen / spread).mean(axis=0)))

    def lifted(self, x: np.ndarray, queries: bool = False) -> np.ndarray:
        length = np.sqrt((x * x).sum(axis=1))
        if queries:
            return np.concatenate([x * (self.longest / length)[:, None], np.zeros((len(x), 1))], axis=1)
        return np.concatenate([x, np.sqrt(np.maximum(self.longest ** 2 - length ** 2, 0))[:, None]], axis=1)

    def keys(self, x: np.ndarray, queries: bool) -> np.ndarray:
        """(curves x n) keys."""
        points = self.lifted(x, queries)
        cells = 1 << self.bits
        out = []
        for directions, shift in self.maps:
            y = (points @ directions + shift + EDGE) / (2 * EDGE) * cells
            out.append(hilbert_key(np.clip(y, 0, cells - 1).astype(np.int64), self.bits))
        return np.array(out)


def matrix(column: pa.Array) -> np.ndarray:
    """Doubles (n x size) of a list column without nulls."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    good = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def first_of(x: np.ndarray, node: np.ndarray, low: np.ndarray, q: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the nodes and scores of its ``most`` nearest in x, ties
    by the least id of a node."""
    for a in range(0, len(q), 256):
        rough = q[a:a + 256] @ x.T
        keep = min(2 * most, len(x))
        best = np.argpartition(-rough, keep - 1, axis=1)[:, :keep]
        for i, pick in enumerate(best):
            score = (x[pick] * q[a + i]).sum(axis=1)
            order = np.lexsort((low[pick], -score))[:most]
            yield node[pick][order], score[order]


def worst_scores(points: DataFrame, queries: list, top: int) -> DataFrame:
    """asked, worst, n: the score of the last of the ``top`` nearest of a few
    queries (rows of query_id, node, q) among all points, and their number."""
    ids, q = [r["node"] for r in queries], np.array([r["q"] for r in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = first_of(matrix(batch.column("v")), batch.column("node").to_numpy(), batch.column("low").to_numpy(), q, top + 1)
                for asked, (node, score) in zip(ids, found):
                    yield pa.RecordBatch.from_pydict({"asked": pa.array([asked] * len(node), pa.int64()), "node": pa.array(node), "score": pa.array(score)})

    spark = points.sparkSession
    near = points.select("node", "v", F.col("ids")[0].alias("low")).mapInArrow(run, "asked long, node long, score double")
    own = spark.createDataFrame([(r["node"], r["query_id"]) for r in queries], "asked long, query_id long")
    by_score = Window.partitionBy("asked").orderBy(F.desc("score"))
    near = near.withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= 4 * (top + 1)).drop("r")
    each = near.join(points.select("node", "ids"), "node").join(own, "asked").select("asked", "query_id", "score", F.explode("ids").alias("vec_id"))
    each = each.where("vec_id <> query_id").withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= top)
    return each.groupBy("asked").agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("n"))


def neighbours(vectors: DataFrame, top: int = TOP, every: int = EVERY, curves: int = CURVES, axes: int = AXES,
               bits: int = BITS, run_rows: int = RUN, seed: int = SEED, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score of the ``top`` nearest found of each
    row whose id is divisible by ``every``; ``recall`` 0 leaves the runs as
    long as given."""
    rows = usable(vectors)
    # equal vectors become one point with its smallest ids
    few = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    points = rows.distinct().withColumn("r", few).where(F.col("r") <= top + 1).groupBy("v").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = materialize(points.withColumn("node", F.monotonically_increasing_id()), "points")
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    asked = materialize(asked.join(points.select("v", "node"), "v").select(F.col("vec_id").alias("query_id"), "node"), "asked")

    # bounded: SAMPLE vectors and one number
    sample = points.orderBy(F.xxhash64("v"), F.col("ids")[0]).limit(SAMPLE).select("v").toArrow()
    if not sample.num_rows:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    longest = points.agg(F.sqrt(F.max(square)).alias("m")).first()["m"]
    index = Curves(matrix(sample.column("v").combine_chunks()), longest * (1 + 1e-12), curves, axes, bits, seed)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, node = matrix(batch.column("v")), batch.column("node").to_numpy()
            ask = batch.column("ask").to_numpy(zero_copy_only=False).astype(bool)
            for kind, pick in ((0, np.arange(len(x))), (1, np.flatnonzero(ask))):
                for curve, keys in enumerate(index.keys(x[pick], bool(kind)) if len(pick) else ()):
                    yield pa.RecordBatch.from_pydict({
                        "curve": pa.array(np.full(len(pick), curve, np.int32)), "key": pa.array(keys),
                        "kind": pa.array(np.full(len(pick), kind, np.int32)), "node": pa.array(node[pick])})

    wanted = asked.select("node").distinct().withColumn("ask", F.lit(True))
    flagged = points.join(wanted, "node", "left").select("node", "v", F.coalesce("ask", F.lit(False)).alias("ask"))
    placed = flagged.mapInArrow(keyed, "curve int, key long, kind int, node long")
    placed = global_row_number(placed, ["curve", "key", "kind", "node"], "place").select("kind", "node", "place")
    n_points = points.count()
    queries = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(MEASURED).join(points.select("node", F.col("v").alias("q")), "node").collect()
    length = run_rows
    if recall and queries and 3 * length < n_points:
        worst = materialize(worst_scores(points, queries, top), "worst")
        sample = rows.sparkSession.createDataFrame([(r["query_id"], r["node"]) for r in queries], asked.schema)
        while 3 * length < n_points:
            hits = search(placed, points, sample, length, top, only=True).join(sample.withColumnRenamed("node", "asked"), "query_id")
            good = hits.join(worst, "asked").agg(F.count_if(F.col("score") >= F.col("worst")).alias("n")).first()["n"]
            if good >= recall * worst.agg(F.sum("n").alias("n")).first()["n"]:
                break
            length *= 2
    return search(placed, points, asked, length, top)


def search(placed: DataFrame, points: DataFrame, asked: DataFrame, run_rows: int, top: int, only: bool = False) -> DataFrame:
    """The nearest that the queries (query_id, node) meet in runs of
    ``run_rows`` places; ``only``: of a few queries, so that no other run than
    theirs has to move."""
    placed = placed.select("kind", "node", F.expr(f"(place - 1) div {run_rows}").alias("run"))
    vector = points.select("node", "v", F.col("ids")[0].alias("low"))
    asking = placed.where("kind = 1").join(points.select(F.col("node").alias("asked"), F.col("v").alias("q")),
                                           F.col("node") == F.col("asked"))
    if only:
        asking = asking.join(asked.select("node"), "node", "left_semi")
    asking = asking.select(F.explode(F.array(F.col("run") - 1, F.col("run"), F.col("run") + 1)).alias("beside"), "asked", "q")
    members = placed.where("kind = 0")
    if only:
        asking = materialize(asking, "asking")
        members = members.join(asking.select(F.col("beside").alias("run")).distinct(), "run", "left_semi")
    members = members.join(vector, "node").select("run", "node", "low", "v")

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {"node": [], "found": []}
        if left.num_rows and right.num_rows:
            # a run may hold the end of one curve and the start of the next
            left = left.take(np.unique(left.column("node").to_numpy(), return_index=True)[1])
            x, q = matrix(left.column("v").combine_chunks()), matrix(right.column("q").combine_chunks())
            found = first_of(x, left.column("node").to_numpy(), left.column("low").to_numpy(), q, top + 1)
            for who, (node, score) in zip(right.column("asked").to_pylist(), found):
                out["node"].append(who)
                out["found"].append([{"score": s, "node": n} for s, n in zip(score.tolist(), node.tolist())])
        return pa.table({"node": pa.array(out["node"], pa.int64()), "found": pa.array(
            out["found"], pa.list_(pa.struct([("score", pa.float64()), ("node", pa.int64())])))})

    met = members.groupBy("run").cogroup(asking.groupBy("beside")).applyInArrow(
        nearest, "node long, found array<struct<score: double, node: long>>")
    # at most curves x 3 x (top + 1) points a query
    merged = met.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
    flat = merged.select(F.col("node").alias("asked"), F.explode("found").alias("f")).select("asked", "f.*")
    listed = flat.join(points.select("node", "ids"), "node").groupBy("asked").agg(F.slice(F.sort_array(F.flatten(
        F.collect_list(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("less"), i.alias("vec_id")))))),
        1, top + 1).alias("near"))
    listed = materialize(listed, "near")
    hits = asked.join(listed, asked["node"] == listed["asked"]).select("query_id", F.posexplode(F.slice(F.filter(
        "near", lambda n: n["vec_id"] != F.col("query_id")), 1, top)).alias("at", "n"))
    return hits.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("vec_id"),
                       (-F.col("n.less")).alias("score"))


def op9_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
