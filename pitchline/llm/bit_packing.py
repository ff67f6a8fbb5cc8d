"""Operator 4, token ids in fixed-width bit-packed files.

Every id takes the minimum bits of the vocabulary. A file is a sequence of
blocks of ``BLOCK`` ids, each packed to whole bytes, and a footer with the
blocks' offsets, the documents' ids and lengths; a reader unpacks any range
with numpy after seeking to its first block.

    file    := MAGIC block* footer footer_size(u64) MAGIC
    footer  := width(u32) block(u32) n_docs(u64) n_ids(u64) n_blocks(u64)
               block offsets(u64 each) lengths(u64 each) doc ids(i64 each) nulls(u8 each)

All integers are little-endian.

Defined results: null text is empty (the end id alone); null document ids
come first; rows with the same id stand in the order of their texts; very
long texts are packed block by block; an empty table gives no rows; columns
other than ``doc_id`` and ``text`` are not read.

At scale: one range shuffle of the text by ``doc_id``; each partition is
encoded, packed and written as one file. Document starts come from the
prefix sums of the files' totals (one row a file). Each attempt of a task
writes a file of its own; only files named by the finished task count, so
lost executors and repeated attempts do no harm.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchline.llm.chunks import ChunkCache, encode, groups, kept, slices, words
from pitchline.llm.common import read_documents, text_of
from pitchline.operators.ranking import materialize
from pitchline.session import ensure_checkpoint_dir

MAGIC = b"BITPACK1"
BLOCK = 65_536
END_ID = 2
HEAD = "<IIQQQ"


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` at ``width`` bits each, lowest bit first."""
    if width in (8, 16, 32):  # whole little-endian integers are the same bits
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, count: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little")
    weights = np.uint32(1) << np.arange(width, dtype=np.uint32)
    return (bits.reshape(count, width) * weights).sum(axis=1, dtype=np.uint32).astype("<u4")


class Writer:
    """Packs ids into an open binary file as they come."""

    def __init__(self, out, vocabulary: int, block: int = BLOCK):
        self.out, self.block = out, block
        self.width = max(1, (vocabulary - 1).bit_length())
        self.offsets, self.lengths, self.docs, self.nulls = [], [], [], []
        self.left, self.n_ids = np.zeros(0, "<u4"), 0
        self.at = out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(len(ids))
        self.n_ids += len(ids)
        ids = np.concatenate([self.left, ids])
        full = len(ids) // self.block * self.block
        for i in range(0, full, self.block):
            self._put(ids[i:i + self.block])
        self.left = ids[full:]

    def _put(self, ids: np.ndarray) -> None:
        self.offsets.append(self.at)
        self.at += self.out.write(pack(ids, self.width))

    def close(self) -> None:
        if len(self.left):
            self._put(self.left)
        footer = struct.pack(HEAD, self.width, self.block, len(self.docs), self.n_ids, len(self.offsets))
        footer += b"".join(np.array(x, t).tobytes() for x, t in (
            (self.offsets, "<u8"), (self.lengths, "<u8"), (self.docs, "<i8"), (self.nulls, "<u1")))
        self.out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)


class Reader:
    """Random access to a packed file (an open seekable binary file)."""

    def __init__(self, file):
        self.file = file
        size = file.seek(0, 2)
        file.seek(size - 16)
        tail = file.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a packed file, or cut short")
        (length,) = struct.unpack("<Q", tail[:8])
        file.seek(size - 16 - length)
        footer = file.read(length)
        self.width, self.block, n, self.n_ids, blocks = struct.unpack_from(HEAD, footer)
        at = struct.calcsize(HEAD)
        parts = []
        for count, kind in ((blocks, "<u8"), (n, "<u8"), (n, "<i8"), (n, "<u1")):
            parts.append(np.frombuffer(footer, kind, count, at))
            at += parts[-1].nbytes
        self.offsets, self.lengths, docs, nulls = parts
        self.doc_ids = [None if null else d for d, null in zip(docs.tolist(), nulls.tolist())]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from position ``start`` of the file on."""
        if count <= 0:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (start + count - 1) // self.block
        out = []
        for b in range(first, last + 1):
            n = min(self.block, self.n_ids - b * self.block)
            self.file.seek(int(self.offsets[b]))
            out.append(unpack(self.file.read((n * self.width + 7) // 8), self.width, n))
        return np.concatenate(out)[start - first * self.block:][:count]

    def parts(self, i: int) -> Iterator[np.ndarray]:
        """The ids of the i-th document, in pieces of bounded size."""
        start, end = int(self.starts[i]), int(self.starts[i + 1])
        while start < end:
            step = min(end - start, 16 * self.block)
            yield self.ids(start, step)
            start += step


# Printable ASCII without apostrophes and the letters of Latin-1 are split by
# the tokenizer into runs of letters, single digits and runs of other
# characters; neither case nor composition moves these borders.
GAP, LETTER, OTHER, DIGIT = range(4)
_GAPS = np.where(np.isin(np.arange(256), list(b" \t\n\r")), GAP, OTHER).astype(np.uint8)
_KINDS = _GAPS.copy()
_KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
_KINDS[48:58] = DIGIT
# bytes of any other character: control, apostrophe, not of the form C3 xx
_STRANGE = np.ones(256, bool)
_STRANGE[[*b" \t\n\r", *range(33, 127), *range(128, 192), 0xC3]] = False
_STRANGE[39] = True
_SIGNS = "\u00d7".encode(), "\u00f7".encode()  # the Latin-1 signs among the letters
_JOINED = 1000


class WordEncoder:
    """The tokenizer's ids of whole texts; no token crosses white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # a token that was added to the vocabulary is matched in the text itself
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.last = np.zeros(self.vocabulary, bool)  # ids that end a word
        for token, i in self.tokenizer.get_vocab().items():
            self.last[i] = token.endswith("</w>")
        self.pieces = ChunkCache(self._joined, 300_000)
        self.chunks = ChunkCache(lambda chunks: [x.tobytes() for x in self._library(chunks)], 50_000)

    def _library(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _joined(self, pieces: list[bytes]) -> list[bytes]:
        """Pieces are whole words: many are encoded as one text, whose ids
        are cut after each id that ends a word."""
        out = []
        joined = [pieces[i:i + _JOINED] for i in range(0, len(pieces), _JOINED)]
        for group, ids in zip(joined, self._library([b" ".join(g) for g in joined])):
            cuts = np.flatnonzero(self.last[ids]) + 1
            if len(cuts) != len(group):
                out += [x.tobytes() for x in self._library(group)]
                continue
            data, at = ids.tobytes(), 0
            for cut in (cuts * 4).tolist():
                out.append(data[at:cut])
                at = cut
        return out

    def texts(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for group in groups(texts):
            kinds = [self._kind(t) for t in group]
            plain = encode(self.pieces, *words([t.lower() for t, k in zip(group, kinds) if k == 0], _KINDS, DIGIT))
            other = encode(self.chunks, *words([t for t, k in zip(group, kinds) if k == 1], _GAPS))
            whole = (self._library([t])[0] for t, k in zip(group, kinds) if k == 2)
            ways = iter(plain), iter(other), whole
            for k in kinds:
                yield next(ways[k])

    def _kind(self, text: bytes) -> int:
        """0: cut into pieces; 1: cut at white space; 2: left whole, as an
        added token stands in it."""
        folded = text.lower() if text.isascii() else text.decode().lower().encode()
        if any(t in folded for t in self.added):
            return 2
        return int(bool(_STRANGE[np.frombuffer(text, np.uint8)].any()) or any(s in text for s in _SIGNS))


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Encode and write ``docs`` under ``folder`` in the order of doc_id;
    one row a file: its number, path and totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("words", tokenizer), lambda: WordEncoder(tokenizer))
        end = np.array([end_id], "<u4")
        writer = out = None
        shard = TaskContext.get().partitionId()
        store, place = fs.FileSystem.from_uri(folder)
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.bits"
        for batch in (part for whole in batches for part in slices(whole, "text")):
            ids = batch.column("doc_id").to_pylist()
            texts = [t.as_py() for t in batch.column("text").cast(pa.binary())]
            for doc, found in zip(ids, encoder.texts(texts)):
                if writer is None:
                    out = store.open_output_stream(f"{place}/{name}")
                    writer = Writer(out, max(encoder.vocabulary, end_id + 1))
                writer.add(doc, np.append(found, end))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int64()), "path": [f"{folder}/{name}"],
                "n_docs": pa.array([len(writer.docs)], pa.int64()), "n_ids": pa.array([writer.n_ids], pa.int64())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "shard long, path string, n_docs long, n_ids long")


def read_files(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and the crc32 of
    its ids, all from the files themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as file:
                    reader = Reader(file)
                    crc = []
                    for i in range(len(reader.doc_ids)):
                        value = 0
                        for part in reader.parts(i):
                            value = zlib.crc32(part.tobytes(), value)
                        crc.append(value)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(reader.doc_ids, pa.int64()), "start": pa.array(reader.starts[:-1] + before),
                        "n_tokens": pa.array(reader.lengths.astype(np.int64)), "ids_crc32": pa.array(crc, pa.int64())})

    n = max(1, files.count())
    # a row a file: the window's one task is bounded by the number of files
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.withColumn("before", F.coalesce(before, F.lit(0))).select("shard", "path", "before")
    return placed.repartitionByRange(n, "shard").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def packed(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pitchline/{spark.sparkContext.applicationId}/ids-{uuid.uuid4().hex}"
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)
    return read_files(materialize(write_files(docs, folder, tokenizer, end_id), "files"))


def op4_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(read_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
