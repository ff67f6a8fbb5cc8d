"""Operator 2, language-model scoring by prediction by partial matching.

The model is a trie of byte contexts up to ``ORDER`` bytes (ASCII capitals
lowered, with a start mark before and an end mark after each text), counted
over the training documents. A symbol's probability is its share in the
longest known context; if it is not there, an escape (method C: as likely
as the context has distinct symbols) leads to the next shorter context,
from which the symbols of the longer one are excluded; below the empty
context all symbols left are equally likely. A document's score is the sum
of the logarithms. Beside it stands a smoothed unigram score over words.

Documents whose crc32(doc_id) is not divisible by 10 train both models; all
are scored. :class:`Adaptive` is the same model as a plain trie that learns
while it codes, for single texts.

Defined results: null text is empty (one end token); a null id counts as
the empty string; repeated rows are scored one by one; very long texts
whole; an empty table gives an empty result; other columns are not read.
Words are told apart by 64-bit hashes: v distinct words meet by chance with
probability v^2/2^65.

At scale: texts are packed into blocks once. Each block sends the distinct
words and (ORDER+1)-grams it holds, with its training counts, as packed
arrays to buckets by hash (grams by their last two context bytes); a bucket
adds up the counts of all blocks, works out the probabilities of its grams
and sends each block the values of its own entries, in the order in which
they came. A word or gram of every document is one entry a block, so hot
ones do not gather rows. A bucket holds 12 bytes for each entry that blocks
sent it; that of a frequent pair of bytes grows with the number of blocks
(see README). Only the counts of single contexts (256 x 256 at most) go
through the driver.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchline.llm.blocks import Block, each, to_blocks
from pitchline.llm.bytehash import mix
from pitchline.llm.common import arrow_batches, buckets, read_documents
from pitchline.operators.ranking import materialize

ORDER = 4
# 0xFE and 0xFF stand in no UTF-8 text; the start mark is never predicted
END, START, SYMBOLS = 0xFE, 0xFF, 255
BITS = 8
END_TOKEN = b"\n"  # no word holds white space
WORDS, GRAMS = 0, 1
DENSE = 1 << 25
BLOCK = 4 << 20  # bytes of text that a task works on at a time
ROWS = 16  # blocks or packed entries that go to Python at once


def is_training(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 != 0


def low(n: int) -> int:
    """A mask of the last n symbols of a packed gram."""
    return (1 << BITS * n) - 1


# ------------------------------------------------------------ inside a block


def _dense(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes (all below ``size``), sorted, and where each
    code stands among them (32 bits)."""
    if size > DENSE:
        found, place = np.unique(codes, return_inverse=True)
        return found, place.astype(np.int32)
    seen = np.zeros(size, bool)
    seen[codes] = True
    place = np.cumsum(seen, dtype=np.int32)
    place -= 1
    return np.flatnonzero(seen), place[codes]


def symbols_of(block: Block, order: int) -> np.ndarray:
    """Each document as ``order`` start marks, its bytes, the end mark."""
    before, after = bytes([START]) * order, bytes([END])
    return np.frombuffer(b"".join(x for t in block.texts(block.data.lower()) for x in (before, t, after)), np.uint8)


class Grams:
    """The (order+1)-grams of a block's documents: ``codes`` (distinct,
    packed) and ``at`` (for every symbol but the first ``order``, its gram).
    A gram that ends in a start mark is predicted by nobody: ``real`` tells
    the others."""

    def __init__(self, block: Block, order: int = ORDER):
        symbols = symbols_of(block, order)
        self.lengths = block.lengths + order + 1
        seen = np.flatnonzero(np.bincount(symbols, minlength=256))
        a = len(seen)
        letter = np.zeros(256, np.int32)
        letter[seen] = np.arange(a)
        letters = letter[symbols]
        # contexts of two symbols at once, then one more symbol each time
        first = min(order, 2)
        codes, at = np.zeros(1, np.int64), np.zeros(len(symbols) - order, np.int32)
        for k in range(first + 1):
            at = at * a + letters[k:k + len(at)]
        found, at = _dense(at, a ** (first + 1))
        for _ in range(first + 1):
            codes = ((codes[:, None] << BITS) | seen).ravel()
        codes = codes[found]
        for k in range(first + 1, order + 1):
            wide = at.astype(np.int64) if len(codes) * a > 1 << 31 else at
            found, at = _dense(wide * a + letters[k:k + len(at)], len(codes) * a)
            codes = (codes[found // a] << BITS) | seen[found % a]
        self.all, self.at = codes, at
        self.real = np.flatnonzero((codes & low(1)) != START)
        self.codes = codes[self.real]

    def counts(self, training: np.ndarray) -> np.ndarray:
        """How often each code stands in the documents marked so."""
        use = np.repeat(training, self.lengths)[-len(self.at):] if len(self.at) else np.zeros(0, bool)
        return np.bincount(self.at[use], minlength=len(self.all))[self.real]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Per document the sum of its symbols' values (one a code)."""
        full = np.zeros(len(self.all))
        full[self.real] = values
        order = int(self.lengths.sum()) - len(self.at)
        each = np.concatenate([np.zeros(order), full[self.at]])
        return np.add.reduceat(each, np.cumsum(self.lengths) - self.lengths)


def words_of(block: Block) -> list[list[bytes]]:
    return [[*t.split(), END_TOKEN] for t in block.texts(block.data.lower())]


class Entries:
    """The distinct words and grams of a block, dealt into buckets: the
    order in which they travel, the same each time it is worked out."""

    def __init__(self, words: list[bytes], grams: np.ndarray, n_buckets: int):
        keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        grams = grams.astype(np.uint64)
        context = (grams >> np.uint64(BITS)) & np.uint64(low(2))
        self.keys = (keys, grams)
        self.bucket = tuple((x % np.uint64(n_buckets)).astype(np.int64) for x in (keys, mix(context + np.uint64(1))))
        self.order = tuple(np.lexsort((k, b)) for k, b in zip(self.keys, self.bucket))

    def parts(self, kind: int) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, entries in their order)."""
        order = self.order[kind]
        b = self.bucket[kind][order]
        cuts = np.flatnonzero(np.diff(b)) + 1
        for part in np.split(order, cuts) if len(order) else []:
            yield int(self.bucket[kind][part[0]]), part

    def placed(self, kind: int, parts: list[tuple[int, bytes]], dtype) -> np.ndarray:
        """Values that came back by bucket, one for each entry."""
        out = np.zeros(len(self.keys[kind]), dtype)
        out[self.order[kind]] = np.frombuffer(b"".join(data for _, data in sorted(parts)), dtype)
        return out


def _entries(block: Block, n_buckets: int, order: int) -> tuple[Entries, list[list[bytes]], dict[bytes, int], Grams]:
    words = words_of(block)
    index = {w: i for i, w in enumerate(dict.fromkeys(w for doc in words for w in doc))}
    grams = Grams(block, order)
    return Entries(list(index), grams.codes, n_buckets), words, index, grams


def send(blocks: DataFrame, n_buckets: int, order: int) -> DataFrame:
    """One row for each block, kind and bucket: packed keys and training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each(batches):
            entries, words, index, grams = _entries(block, n_buckets, order)
            training = np.array([is_training(d) for d in block.ids])
            counted = Counter()
            for doc, use in zip(words, training):
                if use:
                    counted.update(doc)
            n_words = np.zeros(len(index), np.uint32)
            n_words[[index[w] for w in counted]] = list(counted.values())
            n_grams = grams.counts(training).astype(np.uint32)
            rows = [(kind, bucket, entries.keys[kind][part].tobytes(), n[part].tobytes())
                    for kind, n in ((WORDS, n_words), (GRAMS, n_grams)) for bucket, part in entries.parts(kind)]
            kinds, places, keys, counts = zip(*rows)
            yield pa.RecordBatch.from_pydict({
                "kind": pa.array(kinds, pa.int32()), "bucket": pa.array(places, pa.int32()),
                "block": pa.array([block.block] * len(rows), pa.int64()),
                "keys": pa.array(keys, pa.binary()), "counts": pa.array(counts, pa.binary())})

    return blocks.mapInArrow(run, "kind int, bucket int, block long, keys binary, counts binary")


# ----------------------------------------------------------- inside a bucket


class Short:
    """Counts of the contexts of one and no byte, as dense arrays."""

    def __init__(self, pairs: dict[int, int]):
        self.n1 = np.zeros((START + 1) << BITS)
        for code, n in pairs.items():
            self.n1[code] = n
        table = self.n1.reshape(START + 1, 1 << BITS)
        self.t1, self.q1 = table.sum(1), (table > 0).sum(1)
        self.n0 = table.sum(0)
        self.t0, self.q0 = self.n0.sum(), (self.n0 > 0).sum()
        self.x0 = ((table > 0) * self.n0).sum(1)  # what each byte's symbols weigh in the empty context


def log_probabilities(grams: np.ndarray, counts: np.ndarray, short: Short, order: int = ORDER) -> np.ndarray:
    """log10 P(last symbol | the ones before) for distinct packed grams
    that hold, for each last two context bytes, all grams there are."""
    index = np.arange(len(grams))
    levels = []
    g, n, at = grams.astype(np.int64), counts.astype(np.float64), index
    for k in range(order, 1, -1):
        _, context = np.unique(g >> BITS, return_inverse=True)
        shorter, up = np.unique(g & low(k), return_inverse=True)
        n_shorter = np.bincount(up, n, len(shorter)) if k > 2 else short.n1[shorter]
        seen = n > 0
        total, distinct = np.bincount(context, n), np.bincount(context, seen)
        excluded = np.bincount(context, np.where(seen, n_shorter[up], 0))
        levels.append((n[at], total[context][at], distinct[context][at], excluded[context][at]))
        g, n, at = shorter, n_shorter, up[at]
    pair = g[at]
    byte = pair >> BITS
    levels.append((short.n1[pair], short.t1[byte], short.q1[byte], short.x0[byte]))
    levels.append((short.n0[pair & low(1)], short.t0, short.q0, 0.0))
    out, alive = np.zeros(len(grams)), np.ones(len(grams), bool)
    gone_n = gone_q = np.zeros(len(grams))
    with np.errstate(divide="ignore", invalid="ignore"):
        for n, total, distinct, excluded in levels:
            t, q = total - gone_n, distinct - gone_q
            hit = alive & (n > 0)
            escape = alive & ~hit & (t > 0)
            out = np.where(hit, out + np.log10(n / (t + q)), np.where(escape, out + np.log10(q / (t + q)), out))
            alive &= ~hit
            gone_n, gone_q = np.broadcast_to(excluded, len(grams)), np.broadcast_to(distinct, len(grams))
    return np.where(alive, out - math.log10(max(SYMBOLS - short.q0, 1)), out)


def combined(parts: list[tuple[np.ndarray, np.ndarray]], at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of all parts, sorted, and their summed counts. Parts
    are merged a few at a time, so that memory follows the distinct keys."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held, size = [], 0

    def merge() -> tuple[np.ndarray, np.ndarray]:
        both = np.concatenate([keys, *(k for k, _ in held)])
        n = np.concatenate([counts, *(c.astype(np.int64) for _, c in held)])
        order = np.argsort(both, kind="stable")
        both, n = both[order], n[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(len(both), 1), bool), both[1:] != both[:-1]]))
        return both[first], np.add.reduceat(n, first) if len(first) else n

    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= max(at_once, len(keys)):
            keys, counts = merge()
            held, size = [], 0
    return merge() if held else (keys, counts)


def answer(sent: DataFrame, short: Short, order: int) -> DataFrame:
    """The values of every block's entries: counts of words, log10
    probabilities of grams; and each bucket's totals of words (block null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # what is held of a bucket: its packed keys and counts, 12 bytes an entry
        rows = [(block, keys, counts, kind, bucket) for batch in batches for kind, bucket, block, keys, counts in zip(
            *(batch.column(c).to_pylist() for c in ("kind", "bucket", "block", "keys", "counts")))]
        if not rows:
            return
        kind, bucket = rows[0][3:]
        distinct, n = combined([(np.frombuffer(k, np.uint64), np.frombuffer(c, np.uint32)) for _, k, c, _, _ in rows])

        def row(block: int | None, data: bytes, total: int = 0, known: int = 0) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "kind": pa.array([kind], pa.int32()), "bucket": pa.array([bucket], pa.int32()), "block": pa.array([block], pa.int64()),
                "data": pa.array([data], pa.binary()), "n": pa.array([total], pa.int64()), "v": pa.array([known], pa.int64())})

        if kind == WORDS:
            values = n.astype("<u8")
            yield row(None, b"", int(n.sum()), int((n > 0).sum()))
        else:
            values = log_probabilities(distinct, n.astype(np.float64), short, order).astype("<f8")
        for block, keys, _, _, _ in rows:
            yield row(block, values[np.searchsorted(distinct, np.frombuffer(keys, np.uint64))].tobytes())

    return sent.groupBy("kind", "bucket").applyInArrow(
        run, "kind int, bucket int, block long, data binary, n long, v long")


# ------------------------------------------------------------------ scoring


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score and score (log10 probabilities)."""
    spark = docs.sparkSession
    blocks = to_blocks(docs, BLOCK)
    n_buckets = buckets(spark)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in each(batches):
            grams = Grams(block, 1)
            n = grams.counts(np.array([is_training(d) for d in block.ids]))
            yield pa.RecordBatch.from_pydict({"pair": pa.array(grams.codes[n > 0]), "n": pa.array(n[n > 0])})

    counted = blocks.mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    with arrow_batches(spark, ROWS):
        short = Short({r["pair"]: r["n"] for r in counted.collect()})  # 256 x 256 rows at most
        answers = materialize(answer(send(blocks, n_buckets, order), short, order), "answers")
    row = answers.where(F.col("block").isNull()).agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_all, v_all = row["n"] or 0, row["v"] or 0
    floor = n_all + 0.1 * (v_all + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts: tuple[list, list] = ([], [])
        for kind, bucket, data in zip(*(right.column(c).to_pylist() for c in ("kind", "bucket", "data"))):
            parts[kind].append((bucket, data))
        block = Block(left.to_pylist()[0])
        entries, words, index, grams = _entries(block, n_buckets, order)
        c = entries.placed(WORDS, parts[WORDS], "<u8").astype(np.float64)
        logs = np.log10((c + 0.1) / floor)
        base, known = [], []
        for doc in words:
            at = np.fromiter(map(index.__getitem__, doc), np.int64, len(doc))
            base.append(float(logs[at].sum()))
            known.append(int((c[at] > 0).sum()))
        total = grams.sums(entries.placed(GRAMS, parts[GRAMS], "<f8"))
        return pa.table({
            "doc_id": pa.array(block.ids, pa.int64()), "held_out": pa.array([not is_training(d) for d in block.ids]),
            "n_tokens": pa.array([len(w) for w in words], pa.int64()), "n_known": pa.array(known, pa.int64()),
            "train_tokens": pa.array([n_all] * len(words), pa.int64()), "base_score": pa.array(base, pa.float64()),
            "score": pa.array(total)})

    found = answers.where(F.col("block").isNotNull()).select("block", "kind", "bucket", "data")
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


class Adaptive:
    """The model as a trie of counts for one text after another: scores
    with what it has learnt so far, and learns as told."""

    def __init__(self, order: int = ORDER):
        self.order, self.contexts = order, {}

    def cost(self, text: bytes, learn: bool = True) -> float:
        """Code length in bits, learning symbol by symbol."""
        symbols = [START] * self.order + list(text.lower()) + [END]
        bits = 0.0
        for i in range(self.order, len(symbols)):
            history, s = tuple(symbols[i - self.order:i]), symbols[i]
            bits -= math.log2(self.probability(history, s))
            if learn:
                self.learn(history, s)
        return bits

    def learn(self, history: tuple[int, ...], symbol: int) -> None:
        for k in range(len(history) + 1):
            self.contexts.setdefault(history[k:], Counter())[symbol] += 1

    def probability(self, history: tuple[int, ...], symbol: int) -> float:
        p, excluded = 1.0, set()
        for k in range(len(history) + 1):
            seen = {s: n for s, n in self.contexts.get(history[k:], {}).items() if s not in excluded}
            if seen:
                whole = sum(seen.values()) + len(seen)
                if symbol in seen:
                    return p * seen[symbol] / whole
                p *= len(seen) / whole
                excluded |= seen.keys()
        return p / (SYMBOLS - len(excluded))


def op2_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_documents(spark, sf_dir))
