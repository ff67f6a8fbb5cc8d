"""Documents packed into blocks: rows of a few MB of text that tasks work
on with numpy, and that a keyed exchange moves compressed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.llm.common import arrow_batches, text_of
from pitchline.operators.ranking import materialize

SIZE = 8 << 20
TEXTS = 256  # rows that go to Python at once


def to_blocks(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """A written table of ``block``, ``ids``, ``lengths`` (bytes) and
    ``data`` (the texts, one after the other, compressed). A block ends with
    the document that fills it, so a text is never cut. Block numbers are
    those of the finished tasks; later passes read the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0

        def full() -> pa.RecordBatch:
            data = b"".join(texts)
            return pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())),
                "lengths": pa.array([[len(t) for t in texts]], pa.list_(pa.int32())), "size": pa.array([held], pa.int64()),
                "data": pa.array([pa.compress(data, "zstd", asbytes=True)], pa.binary())})

        for batch in batches:
            binary = batch.column("text").cast(pa.binary())
            for doc, text in zip(batch.column("doc_id").to_pylist(), binary):
                text = text.as_py()
                ids.append(doc)
                texts.append(text)
                held += len(text)
                if held >= size:
                    yield full()
                    block, ids, texts, held = block + 1, [], [], 0
        if ids:
            yield full()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    packed = rows.mapInArrow(run, "block long, ids array<long>, lengths array<int>, size long, data binary")
    with arrow_batches(docs.sparkSession, TEXTS):
        return materialize(packed, "blocks")


class Block:
    """One row of the table, unpacked."""

    def __init__(self, row: dict):
        self.block, self.ids = row["block"], row["ids"]
        self.lengths = np.array(row["lengths"], np.int64)
        size = row["size"]
        self.data = pa.decompress(row["data"], size, "zstd", asbytes=True) if size else b""
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths

    def texts(self, data: bytes | None = None) -> list[bytes]:
        data = self.data if data is None else data
        return [data[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The blocks of Arrow batches, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch.slice(i, 1).to_pylist()[0])
