"""Operator 7, exact substring deduplication over maximal repeats.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a
document with a smaller doc_id; strings are judged on the input and never
cross documents.

Suffixes are taken at anchors only: positions whose ``GRAM``-byte string
has the smallest hash within some string of ``LENGTH`` bytes. Equal strings
hold the same anchors, so every repeat of that length shows at one. The
suffixes of one anchor string, with the bytes around them, meet in one
bucket, which sorts them (an enhanced suffix array: order and common
prefixes), scans the common prefixes with a stack into the tree of
intervals, and tests each interval's left extensions: members with equal
extensions to the left form a repeat group with all its occurrences,
wherever they stand, and of each group all but the smallest document lose
the strings.

Defined results: null text is empty; null ids come before all others; rows
with one id are one document here, so they take nothing from each other;
very long texts are judged whole; an empty table gives an empty result;
other columns are not read. Anchors are chosen by 64-bit hashes, which
cannot change the result; contexts are compared byte by byte; strings at hot
anchors by 128-bit hashes (two distinct ones of n meet with probability
n^2/2^129).

At scale: texts are packed into blocks once. Each block sends the distinct
anchor hashes it holds, 5 bytes each, and gets back which are shared; for
those it sends the distinct contexts with their smallest document, and gets
back which of a context's strings an earlier document has. An anchor
context of every document is one entry a block. Anchors of more than
``HOT`` documents, where the contexts at the edges of a passage may all
differ, are not gathered: each of their strings is a key of its own, with
its smallest document in the block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.blocks import Block, each, to_blocks
from pitchline.llm.bytehash import PrefixHash, anchors
from pitchline.llm.common import buckets, read_documents
from pitchline.operators.ranking import materialize

LENGTH, GRAM = 50, 24
LEFT = LENGTH - GRAM  # an anchor stands at most so far behind the start of its string
WIDTH = LEFT + LENGTH + 2  # left bytes, right bytes, how many of either lie in the document
HOT = 1000
PIECE = 1 << 18
CONTEXTS, STRINGS = 0, 1


def split_by(bucket: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its entries in their order); ``order`` sorts by bucket."""
    if len(order):
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for part in np.split(order, cuts):
            yield int(bucket[part[0]]), part


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


class Sites:
    """The anchors of a block: position, hash, document (row of the block)."""

    def __init__(self, block: Block):
        self.block = block
        self.bytes = np.frombuffer(block.data, np.uint8)
        # null ids come first
        self.ids = np.array([np.iinfo(np.int64).min if i is None else i for i in block.ids], np.int64)
        found, hashes = [], []
        for a, b, ends in self._pieces():
            grams = PrefixHash(self.bytes[a:b]).grams(GRAM)
            at = anchors(grams, ends, LENGTH, GRAM)
            found.append(at + a)
            hashes.append(grams[at])
        self.at = np.concatenate(found) if found else np.zeros(0, np.int64)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.row = np.searchsorted(block.ends, self.at, side="right")
        self.distinct, self.key = np.unique(self.hash, return_inverse=True)

    def _pieces(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Runs of whole documents: start, end, ends of the documents in it."""
        ends = self.block.ends
        i = 0
        while i < len(ends):
            start = int(self.block.starts[i])
            j = max(i + 1, int(np.searchsorted(ends, start + PIECE, side="right")))
            yield start, int(ends[j - 1]), ends[i:j] - start
            i = j

    def documents(self) -> np.ndarray:
        """In how many documents of the block each distinct hash stands, up to 255."""
        _, rank = np.unique(self.ids, return_inverse=True)
        pairs = np.unique((self.key.astype(np.int64) << 32) | rank[self.row])
        return np.minimum(np.bincount(pairs >> 32, minlength=len(self.distinct)), 255).astype(np.uint8)

    def dealt(self, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
        bucket = bucket_of(self.distinct, n_buckets)
        return bucket, np.lexsort((self.distinct, bucket))

    def room(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the document before and from the picked anchors on."""
        at, row = self.at[pick], self.row[pick]
        return (np.minimum(at - self.block.starts[row], LEFT), np.minimum(self.block.ends[row] - at, LENGTH))


class Contexts:
    """The distinct contexts of the picked anchors of a block."""

    def __init__(self, sites: Sites, pick: np.ndarray, n_buckets: int):
        left, right = sites.room(pick)
        padded = np.concatenate([np.zeros(LEFT, np.uint8), sites.bytes, np.zeros(LENGTH, np.uint8)])
        rows = np.empty((len(pick), WIDTH), np.uint8)
        rows[:, :-2] = np.lib.stride_tricks.sliding_window_view(padded, WIDTH - 2)[sites.at[pick]]
        column = np.arange(WIDTH - 2) - LEFT
        rows[:, :-2][(column < -left[:, None]) | (column >= right[:, None])] = 0
        rows[:, -2], rows[:, -1] = left, right
        kinds, first, self.of = np.unique(rows.view(f"V{WIDTH}").ravel(), return_index=True, return_inverse=True)
        self.rows = rows[first]
        self.ids = sites.ids[sites.row[pick]]
        self.least = np.full(len(kinds), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.of, self.ids)
        self.bucket = bucket_of(sites.hash[pick][first], n_buckets)
        self.order = np.argsort(self.bucket, kind="stable")


class Strings:
    """The distinct strings of ``LENGTH`` bytes at the picked (hot) anchors."""

    def __init__(self, sites: Sites, pick: np.ndarray, n_buckets: int):
        left, right = sites.room(pick)
        starts, owner = [], []
        for o in range(LEFT + 1):
            ok = (o <= left) & (LENGTH - o <= right)
            starts.append(sites.at[pick[ok]] - o)
            owner.append(sites.row[pick[ok]])
        # a string may hold several anchors, but counts once
        self.starts, first = np.unique(np.concatenate(starts), return_index=True)
        row = np.concatenate(owner)[first]
        halves = np.zeros((len(self.starts), 2), np.uint64)
        for a, b, _ in sites._pieces() if len(self.starts) else ():
            lo, hi = np.searchsorted(self.starts, (a, b))
            if lo < hi:
                hashes, s = PrefixHash(sites.bytes[a:b]), self.starts[lo:hi] - a
                for k in range(2):
                    halves[lo:hi, k] = hashes.of(s + k * LENGTH // 2, s + (k + 1) * LENGTH // 2)
        self.ids = sites.ids[row]
        order = np.lexsort((halves[:, 1], halves[:, 0]))
        same = np.zeros(len(order), bool)
        same[1:] = (halves[order[1:]] == halves[order[:-1]]).all(axis=1)
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(~same) - 1
        self.rows = halves[order[~same]]
        self.least = np.full(len(self.rows), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.of, self.ids)
        self.bucket = bucket_of(self.rows[:, 0], n_buckets) if len(self.rows) else np.zeros(0, np.int64)
        self.order = np.argsort(self.bucket, kind="stable")


def _squeeze(a: np.ndarray) -> bytes:
    return pa.compress(a.tobytes(), "zstd", asbytes=True) if a.size else b""


def _spread(data: bytes, dtype, count: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize * count
    return np.frombuffer(pa.decompress(data, size, "zstd", asbytes=True) if size else b"", dtype)


# ------------------------------------------------------------ which are shared


def send_anchors(blocks: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each(batches):
            sites = Sites(block)
            n = sites.documents()
            five = sites.distinct.view(np.uint8).reshape(-1, 8)[:, :5]
            rows = [(b, five[part].tobytes(), n[part].tobytes()) for b, part in split_by(*sites.dealt(n_buckets))]
            for i in range(0, len(rows), 4096):
                place, keys, counts = zip(*rows[i:i + 4096])
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(place, pa.int32()), "block": pa.array([block.block] * len(place), pa.int64()),
                    "keys": pa.array(keys, pa.binary()), "counts": pa.array(counts, pa.binary())})

    return blocks.mapInArrow(run, "bucket int, block long, keys binary, counts binary")


def shared(sent: DataFrame, hot: int) -> DataFrame:
    """Per block and bucket, for each hash sent: 0 one document, 1 more, 2 hot."""

    def run(table: pa.Table) -> pa.Table:
        counts = [np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()]
        wide = np.zeros((sum(map(len, counts)), 8), np.uint8)
        wide[:, :5] = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint8).reshape(-1, 5)
        distinct, place = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
        n = np.bincount(place, np.concatenate(counts), len(distinct))
        flag = ((n >= 2).astype(np.uint8) + (n >= hot))[place]
        cuts = np.cumsum([len(c) for c in counts])[:-1]
        return pa.table({"bucket": table.column("bucket"), "block": table.column("block"),
                         "kind": pa.array([-1] * len(counts), pa.int32()),
                         "data": pa.array([_squeeze(f) for f in np.split(flag, cuts)], pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, "bucket int, block long, kind int, data binary")


def _flags(sites: Sites, n_buckets: int, parts: list[tuple[int, bytes]]) -> np.ndarray:
    """The flag of every anchor of the block."""
    found = dict(parts)
    out = np.zeros(len(sites.distinct), np.uint8)
    for b, part in split_by(*sites.dealt(n_buckets)):
        out[part] = _spread(found[b], np.uint8, len(part))
    return out[sites.key]


# ---------------------------------------------------------- the repeat groups


def interval_tree(lcp: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
    """Stack scan over the common prefixes of neighbours in a suffix array
    (``lcp[i]`` between i-1 and i): the intervals [from, to) of at least two
    suffixes with a common prefix of at least ``least``, children before
    parents, with the length and that of the parent interval."""
    stack: list[tuple[int, int]] = []  # start, length
    for i in range(1, len(lcp) + 1):
        here = lcp[i] if i < len(lcp) else 0
        start = i - 1
        while stack and stack[-1][1] > here:
            start, length = stack.pop()
            parent = max(here, stack[-1][1] if stack else 0)
            yield start, i, length, parent
        if here >= least and (not stack or stack[-1][1] < here):
            stack.append((start, here))


def repeat_groups(rows: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """From distinct contexts: (offset, members) for every string that
    starts ``offset`` bytes before the anchor of at least two contexts,
    all its occurrences together."""
    left, right = rows[:, :LEFT], rows[:, LEFT:-2]
    # the enhanced suffix array: order, and common prefixes of neighbours
    order = np.argsort(np.ascontiguousarray(np.concatenate([right, rows[:, -1:]], axis=1)).view(f"V{LENGTH + 1}").ravel())
    differ = right[order[1:]] != right[order[:-1]]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), LENGTH)
    lcp = np.minimum(lcp, np.minimum(rows[order[1:], -1], rows[order[:-1], -1]))
    # left parts read backwards, only as far as they lie in the document
    lefts = [rows[i, LEFT - rows[i, -2]:LEFT].tobytes()[::-1] for i in order] if (lcp >= GRAM).any() else []
    names = order.tolist()
    for a, b, length, parent in interval_tree([0, *lcp.tolist()], GRAM):
        first, last = max(LENGTH - length, 0), min(LEFT, LENGTH - max(parent, GRAM - 1) - 1)
        common = _common(lefts[a:b])
        for o in range(first, last + 1):
            if o <= common:  # no left extension tells the members apart
                yield o, names[a:b]
                continue
            groups: dict[bytes, list[int]] = {}
            for i in range(a, b):
                if len(lefts[i]) >= o:
                    groups.setdefault(lefts[i][:o], []).append(names[i])
            for members in groups.values():
                if len(members) > 1:
                    yield o, members


def _common(texts: list[bytes]) -> int:
    low, high = min(texts), max(texts)
    n = min(len(low), len(high))
    return next((i for i in range(n) if low[i] != high[i]), n)


def earlier(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For contexts with their documents: bit o tells that the string which
    starts o bytes before the anchor also stands in an earlier document."""
    out = np.zeros(len(rows), np.uint32)
    kinds, first, of = np.unique(np.ascontiguousarray(rows).view(f"V{WIDTH}").ravel(), return_index=True, return_inverse=True)
    least = np.full(len(kinds), np.iinfo(np.int64).max)
    np.minimum.at(least, of, ids)
    distinct = rows[first]
    mask = np.zeros(len(kinds), np.uint32)
    known = least.tolist()
    marks = [0] * len(kinds)
    for o, members in repeat_groups(distinct):
        low = min(known[i] for i in members)
        for i in members:
            if known[i] > low:
                marks[i] |= 1 << o
    mask[:] = marks
    out = mask[of]
    later = ids > least[of]
    out[later] = all_strings(rows[later])
    return out


def all_strings(rows: np.ndarray) -> np.ndarray:
    """Bits of the strings that lie in the document: not more than the left
    bytes before the anchor, and not beyond the right ones."""
    first = LENGTH - rows[:, -1].astype(np.int64)
    last = rows[:, -2].astype(np.int64)
    bits = (np.left_shift(1, np.maximum(last + 1, 0)) - 1) & ~(np.left_shift(1, np.maximum(first, 0)) - 1)
    return np.where(first <= last, bits, 0).astype(np.uint32)


def _dealt(block: Block, flags: list[tuple[int, bytes]], n_buckets: int) -> tuple[Sites, tuple, tuple]:
    sites = Sites(block)
    flag = _flags(sites, n_buckets, flags)
    picks = np.flatnonzero(flag == 1), np.flatnonzero(flag == 2)
    return sites, picks, (Contexts(sites, picks[0], n_buckets), Strings(sites, picks[1], n_buckets))


def send_contexts(blocks: DataFrame, flags: DataFrame, n_buckets: int) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            block = Block(left.to_pylist()[0])
            parts = list(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist()))
            _, _, held = _dealt(block, parts, n_buckets)
            out = [(kind, b, block.block, len(part), _squeeze(x.rows[part]), _squeeze(x.least[part]))
                   for kind, x in enumerate(held) for b, part in split_by(x.bucket, x.order)]
        kinds, places, names, n, rows, least = zip(*out) if out else ([],) * 6
        return pa.table({"kind": pa.array(kinds, pa.int32()), "bucket": pa.array(places, pa.int32()),
                         "block": pa.array(names, pa.int64()), "n": pa.array(n, pa.int64()),
                         "rows": pa.array(rows, pa.binary()), "least": pa.array(least, pa.binary())})

    return blocks.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(
        run, "kind int, bucket int, block long, n long, rows binary, least binary")


def answer_contexts(sent: DataFrame) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        kind, n = table.column("kind")[0].as_py(), table.column("n").to_pylist()
        ids = np.concatenate([_spread(x, np.int64, k) for x, k in zip(table.column("least").to_pylist(), n)])
        data = zip(table.column("rows").to_pylist(), n)
        if kind == CONTEXTS:
            rows = np.concatenate([_spread(x, np.uint8, k * WIDTH).reshape(-1, WIDTH) for x, k in data])
            found = earlier(rows, ids)
        else:
            rows = np.concatenate([_spread(x, np.uint64, k * 2).reshape(-1, 2) for x, k in data])
            order = np.lexsort((ids, rows[:, 1], rows[:, 0]))
            new = np.ones(len(order), bool)
            new[1:] = (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
            least = ids[order[new]][np.cumsum(new) - 1]
            found = np.empty(len(order), np.uint32)
            found[order] = least < ids[order]
        cuts = np.cumsum(n)[:-1]
        return pa.table({"bucket": table.column("bucket"), "block": table.column("block"), "kind": table.column("kind"),
                         "data": pa.array([_squeeze(x) for x in np.split(found, cuts)], pa.binary())})

    return sent.groupBy("kind", "bucket").applyInArrow(run, "bucket int, block long, kind int, data binary")


def _placed(x: Contexts | Strings, parts: dict[int, bytes]) -> np.ndarray:
    out = np.zeros(len(x.rows), np.uint32)
    for b, part in split_by(x.bucket, x.order):
        out[part] = _spread(parts[b], np.uint32, len(part))
    return out


def cut(blocks: DataFrame, answers: DataFrame, n_buckets: int) -> DataFrame:
    """Per document: doc_id, n_bytes, the removed spans and the bytes left."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block(left.to_pylist()[0])
        parts: dict[int, dict[int, bytes]] = {-1: {}, CONTEXTS: {}, STRINGS: {}}
        for kind, b, data in zip(*(right.column(c).to_pylist() for c in ("kind", "bucket", "data"))):
            parts[kind][b] = data
        sites, (pick, _), (contexts, strings) = _dealt(block, list(parts[-1].items()), n_buckets)
        start = np.zeros(len(block.data) + LENGTH, bool)  # where a removed string starts
        mask = _placed(contexts, parts[CONTEXTS])[contexts.of]
        later = contexts.ids > contexts.least[contexts.of]
        mask[later] = all_strings(contexts.rows[contexts.of[later]])
        at = sites.at[pick]
        for o in range(LEFT + 1):
            start[at[(mask >> np.uint32(o)) & 1 == 1] - o] = True
        gone = (_placed(strings, parts[STRINGS])[strings.of] > 0) | (strings.ids > strings.least[strings.of])
        start[strings.starts[gone]] = True
        total = np.cumsum(start, dtype=np.int32)
        total[LENGTH:] -= total[:-LENGTH].copy()
        removed = total[:len(block.data)] > 0
        data, spans, kept = sites.bytes, [], []
        for a, b in zip(block.starts.tolist(), block.ends.tolist()):
            mine = removed[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]])))
            spans.append([{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()])
            kept.append(data[a:b][~mine].tobytes())
        return pa.table({
            "doc_id": pa.array(block.ids, pa.int64()), "n_bytes": pa.array(block.lengths),
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.binary())})

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    n = buckets(docs.sparkSession)
    blocks = to_blocks(docs)
    flags = materialize(shared(send_anchors(blocks, n), hot), "shared")
    found = materialize(answer_contexts(send_contexts(blocks, flags, n)), "repeats")
    return cut(blocks, flags.unionByName(found), n)


def op7_maximal_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut_docs = remove_repeats(read_documents(spark, sf_dir))
    return cut_docs.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
