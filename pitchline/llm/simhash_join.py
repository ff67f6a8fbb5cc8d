"""Operator 11, SimHash near duplicates by the generalised pigeonhole principle.

A document's fingerprint has the majority bit of the XXH64 hashes (seed 42)
of its 3-word shingles, repeats included. Documents link when their
fingerprints differ in at most ``TAU`` bits; a component is what links reach.

Search, over distinct fingerprints:

1. Bits that go together in the corpus are grouped into four cells of 16
   bits (correlations and the cells' full histograms come from all
   fingerprints).
2. Cells are joined to the partitions of a layout. If the thresholds t_i of
   m partitions add up to TAU - m + 1 (-1: partition not used), two
   fingerprints within TAU bits are within t_i bits in some partition i. Each
   fingerprint gets its own thresholds: dynamic programming over the
   partitions finds those of least cost, counting probes and the candidates
   that the histograms let expect. The layout of least total cost is taken.
3. Each fingerprint probes, in partition i, all values within t_i bits; what
   it meets is verified by the bits that differ.
4. Where even the best thresholds cost more than ``POINTS`` probes, the
   fingerprint stands in a crowd. Two such fingerprints are met in another
   exact way: within two bits of each other they share a point within one
   bit of both, and no point has more than 65 fingerprints around it. So
   crowds give no pairs and no hot bucket.

Defined results: null text is empty; without words the fingerprint is zero,
linked like any other; below three words the whole sequence is the shingle;
repeated rows and repeated doc_ids are rows of their own; a null doc_id is
never the smallest, and a component without any doc_id has a null
component_id; very long texts are hashed in pieces; an empty table gives an
empty result; columns other than ``doc_id`` and ``text`` are not read.

At scale: the text is read once, 16 bytes a document go on. Copies become
one fingerprint by partial aggregates. The driver holds 64 x 64 sums and
4 x 65,536 counts whatever the input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.chunks import slices
from pitchline.llm.common import read_documents, text_of
from pitchline.llm.components import components
from pitchline.operators.ranking import materialize

TAU = 2
SHINGLE, SEED = 3, 42
CELLS, WIDTH = 4, 16
#: Ways to join the four cells to partitions; the cheapest for the corpus is taken.
LAYOUTS = (((0,), (1,), (2,), (3,)), ((0, 1), (2, 3)))
#: Cost of a candidate in probes, and of the points around a fingerprint.
CANDIDATE, POINTS = 0.2, 65
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _runs(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, by pieces of about ``size`` bytes."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text, as an unsigned integer."""
    from xxhash import xxh64_intdigest as digest

    ones, n, left = np.zeros(64, np.int64), 0, []
    for found in _runs(text.lower()):
        words = left + found
        left = words[1 - SHINGLE:]
        if len(words) < SHINGLE:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[SHINGLE - 1:].tolist())], "<u8")
        ones += bits_of(hashes).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    if not n and left:
        return digest(b" ".join(left), SEED)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def bits_of(values: np.ndarray) -> np.ndarray:
    """(n x 64) bits, lowest first."""
    return np.unpackbits(np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            found = np.array([fingerprint(t.as_py()) for t in batch.column("text").cast(pa.binary())], "<u8")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view("<i8"))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


# --------------------------------------------------- statistics of the corpus


def _fps(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy().view("<u8")


def bit_groups(classes: DataFrame) -> list[list[int]]:
    """Four groups of 16 bits each: from the most correlated pair on, the bit
    that goes best with those that are there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64)), 0
        for batch in batches:
            x = bits_of(_fps(batch)).astype(np.float64)
            both += x.T @ x
            n += len(x)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([np.append(both.ravel(), n).astype(np.int64)], pa.list_(pa.int64()))})

    parts = classes.select("fp").mapInArrow(run, "sums array<long>").select(F.posexplode("sums").alias("at", "n"))
    rows = parts.groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").collect()  # 64 x 64 + 1
    sums = np.array([r["n"] for r in rows] or [0] * 4097, np.float64)
    both, n = sums[:-1].reshape(64, 64), max(sums[-1], 1)
    mean = np.diag(both) / n
    spread = np.sqrt(np.maximum(mean - mean * mean, 0))
    scale = np.outer(spread, spread)
    related = np.where(scale > 0, np.abs(both / n - np.outer(mean, mean)) / np.where(scale > 0, scale, 1), 0)
    np.fill_diagonal(related, 0)
    left, groups = list(range(64)), []
    for _ in range(CELLS):
        inside = related[np.ix_(left, left)]
        a, b = np.unravel_index(np.argmax(inside), inside.shape)
        group = [left[a]] if a == b else [left[a], left[b]]
        while len(group) < WIDTH:
            rest = [x for x in left if x not in group]
            group.append(rest[int(np.argmax(related[np.ix_(rest, group)].sum(axis=1)))])
        groups.append(sorted(group))
        left = [x for x in left if x not in group]
    return groups


def cell_values(fps: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """(cells x n) values of the cells, as unsigned integers."""
    bits = bits_of(fps)
    packed = [np.packbits(bits[:, g], axis=1, bitorder="little") for g in groups]
    return np.array([np.ascontiguousarray(x).view("<u2").ravel() for x in packed], np.uint64)


def histograms(classes: DataFrame, groups: list[list[int]]) -> np.ndarray:
    """(cells x 65,536) counts over all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((CELLS, 1 << WIDTH), np.int64)
        for batch in batches:
            for c, values in enumerate(cell_values(_fps(batch), groups)):
                seen[c] += np.bincount(values.astype(np.int64), minlength=1 << WIDTH)
        cell, value = np.nonzero(seen)
        yield pa.RecordBatch.from_pydict({"cell": cell.astype(np.int32), "value": value.astype(np.int32), "n": seen[cell, value]})

    counted = classes.select("fp").mapInArrow(run, "cell int, value int, n long").groupBy("cell", "value").agg(
        F.sum("n").alias("n")).toArrow()  # CELLS x 65,536 rows at most
    out = np.zeros((CELLS, 1 << WIDTH))
    out[counted.column("cell").to_numpy(), counted.column("value").to_numpy()] = counted.column("n").to_numpy()
    return out


# ---------------------------------------------------------------- allocation


class Allocation:
    """Thresholds of least cost for each fingerprint."""

    def __init__(self, groups: list[list[int]], counts: np.ndarray, layout: tuple, points: float = POINTS):
        self.groups, self.layout, self.points = groups, layout, points
        self.total = max(counts[0].sum(), 1)
        # how many are at exactly 0, 1, 2 bits from a value of the cell
        self.counts, self.shells = counts, None

    def _shells(self) -> np.ndarray:
        if self.shells is None:
            values = np.arange(1 << WIDTH)
            one = sum(self.counts[:, values ^ (1 << b)] for b in range(WIDTH))
            two = (sum(one[:, values ^ (1 << b)] for b in range(WIDTH)) - WIDTH * self.counts) / 2
            self.shells = np.array([self.counts, one, two])
        return self.shells

    def costs(self, cells: np.ndarray) -> np.ndarray:
        """(partitions x TAU + 2 x n) cost of the thresholds -1 to TAU; cells
        of a partition count as independent."""
        shells, n = self._shells(), cells.shape[1]
        out = np.zeros((len(self.layout), TAU + 2, n))
        for p, part in enumerate(self.layout):
            near = np.zeros((TAU + 1, n))
            near[0] = self.total
            for c in part:
                mine = shells[:, c, cells[c].astype(np.int64)] / self.total
                near = np.array([sum(near[d - e] * mine[e] for e in range(d + 1)) for d in range(TAU + 1)])
            probes = np.cumsum([comb(WIDTH * len(part), d) for d in range(TAU + 1)])
            out[p, 1:] = probes[:, None] + CANDIDATE * np.cumsum(near, axis=0)
        return out

    def best(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(partitions x n) thresholds and their cost."""
        costs = self.costs(cells)
        n, units = cells.shape[1], TAU + 1  # thresholds plus one add up to this
        least = np.full((units + 1, n), np.inf)
        least[0] = 0
        choices = []
        for cost in costs:
            options = np.full((units + 1, units + 1, n), np.inf)  # used so far, taken here
            for used in range(units + 1):
                for taken in range(used + 1):
                    options[used, taken] = least[used - taken] + cost[taken]
            choices.append(options.argmin(axis=1))
            least = options.min(axis=1)
        thresholds, left = np.zeros((len(self.layout), n), np.int64), np.full(n, units)
        for p in range(len(self.layout) - 1, -1, -1):
            taken = choices[p][left, np.arange(n)]
            thresholds[p] = taken - 1
            left -= taken
        return thresholds, least[units]

    def keys(self, cells: np.ndarray, p: int) -> np.ndarray:
        """The value of partition p, its cells one after the other."""
        key = np.zeros(cells.shape[1], np.uint64)
        for k, c in enumerate(self.layout[p]):
            key |= cells[c] << np.uint64(WIDTH * k)
        return key


def flips(width: int, most: int) -> np.ndarray:
    """All masks of at most ``most`` of ``width`` bits."""
    one = [1 << b for b in range(width)]
    masks = [0] + (one if most >= 1 else [])
    if most >= 2:
        masks += [a | b for i, a in enumerate(one) for b in one[:i]]
    return np.array(masks, np.uint64)


# -------------------------------------------------------------------- search


def _rows(part: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": part.astype(np.int32), "key": key.view("<i8"), "fp": fp.view("<i8")})


def links(classes: DataFrame, layouts: tuple = LAYOUTS, points: float = POINTS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp``: every pair within
    TAU bits is linked, directly or by others."""
    groups = bit_groups(classes)
    counts = histograms(classes, groups)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = [Allocation(groups, counts, x, points) for x in layouts]
        sums = np.zeros(len(ways))
        for batch in batches:
            cells = cell_values(_fps(batch), groups)
            sums += [np.minimum(w.best(cells)[1] + len(w.layout), points).sum() for w in ways]
        yield pa.RecordBatch.from_pydict({"layout": np.arange(len(ways), dtype=np.int32), "cost": sums})

    if len(layouts) > 1:
        cost = classes.select("fp").mapInArrow(total, "layout int, cost double").groupBy("layout").agg(
            F.sum("cost").alias("cost")).orderBy("cost", "layout").first()
        layout = layouts[cost["layout"] if cost else 0]
    else:
        layout = layouts[0]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        way = Allocation(groups, counts, layout, points)
        for batch in batches:
            fps = _fps(batch)
            cells = cell_values(fps, groups)
            for p in range(len(layout)):
                yield _rows(np.full(len(fps), p), way.keys(cells, p), fps)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        way = Allocation(groups, counts, layout, points)
        around = flips(64, 1)
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                fps = _fps(batch.slice(a, 4096))
                cells = cell_values(fps, groups)
                thresholds, cost = way.best(cells)
                crowd = cost > points
                near = (fps[crowd][:, None] ^ around).ravel()
                yield _rows(np.full(len(near), -1), near, np.repeat(fps[crowd], len(around)))
                for p in range(len(layout)):
                    key = way.keys(cells, p)
                    for t in range(TAU + 1):
                        pick = ~crowd & (thresholds[p] == t)
                        masks = flips(WIDTH * len(layout[p]), t)
                        yield _rows(np.full(pick.sum() * len(masks), p), (key[pick][:, None] ^ masks).ravel(),
                                    np.repeat(fps[pick], len(masks)))

    kinds = "part int, key long, fp long"
    asked = materialize(classes.select("fp").mapInArrow(probes, kinds), "probes")
    there = classes.select("fp").mapInArrow(index, kinds).select("part", "key", F.col("fp").alias("other"))
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    met = asked.where("part >= 0").join(there, ["part", "key"]).where((differ > 0) & (differ <= TAU)).select(
        F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b"))
    # 65 fingerprints at most have a point in common, and all of them link
    shared = asked.where("part < 0").groupBy("key").agg(F.sort_array(F.collect_set("fp")).alias("fps")).where(F.size("fps") > 1)
    crowded = shared.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b"))
    return met.unionByName(crowded)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id (the smallest doc_id reachable) of
    every row."""
    marked = materialize(fingerprints(docs), "fingerprints")
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    named = components(links(classes)).select(F.col("node").alias("fp"), "comp")
    least = classes.join(named, "fp").groupBy("comp").agg(F.min("low").alias("component_id"))
    linked = named.join(least, "comp").select("fp", F.lit(True).alias("linked"), "component_id")
    ids = materialize(classes.join(linked, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("low")).alias("component_id")), "ids")
    return marked.join(ids, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_simhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_documents(spark, sf_dir))
