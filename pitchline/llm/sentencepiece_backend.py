"""Operator 5, SentencePiece models on the tokenizers library.

The model's protobuf is parsed and rebuilt as a tokenizers pipeline: the
normaliser (compiled character map, white-space rules, dummy prefix and the
white-space marker), the pieces with their scores, and byte fallback. A
unigram model becomes a unigram model; a BPE model becomes merges ranked by
the score of the merged piece, because unigram scores would not give the
same ids for it (the public model here is of that kind).

Texts are encoded in batches by the library's own threads. When no piece of
the model has the marker after another character, a text's ids are those of
its chunks (a run of markers with what follows), so each distinct chunk is
encoded once and looked up afterwards. The ids are always those of this
pipeline. Every distinct chunk is also checked: its ids should be those of
the sentencepiece library and decode to the chunk; documents with a chunk
that fails say ``parity`` false.

Defined results: null and empty texts have no ids; repeated rows are encoded
one by one; very long texts whole; a white-space marker that stands in the
text itself counts as a space, as in the original; an empty table gives no
rows; other columns are not read.

At scale: one pass in the scan's own tasks, no shuffle; the chunk cache is
bounded.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pitchline.llm.chunks import ChunkCache, groups, kept, runs, slices
from pitchline.llm.chunks import encode as encode_chunks
from pitchline.llm.common import read_documents, text_of

MARK = "▁"
_MARK = MARK.encode()
#: Kinds of pieces and of models in the protobuf.
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
THREADS = 2


def load_model(path: str):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    if model.trainer_spec.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    if any(p.type == USER for p in model.pieces):
        raise ValueError("models with user-defined pieces are not supported")
    return model


def merges_of(pieces) -> list[tuple[str, str]]:
    """All ways to make a piece of two others, best score first."""
    score = {p.piece: p.score for p in pieces if p.type == NORMAL}
    ways = [(-s, piece, i) for piece, s in score.items() for i in range(1, len(piece))
            if piece[:i] in score and piece[i:] in score]
    return [(piece[:i], piece[i:]) for _, piece, i in sorted(ways)]


def build(model):
    """The tokenizers pipeline of a model, without its normaliser, and the
    normaliser (None where it only marks spaces)."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    pieces, spec = model.pieces, model.normalizer_spec
    if model.trainer_spec.model_type == UNIGRAM:
        unknown = next(i for i, p in enumerate(pieces) if p.type == UNKNOWN)
        # control pieces never match a text
        core = models.Unigram([(p.piece, p.score if p.type in (NORMAL, BYTE) else -1e9) for p in pieces],
                              unk_id=unknown, byte_fallback=model.trainer_spec.byte_fallback)
    else:
        unknown = next(p.piece for p in pieces if p.type == UNKNOWN)
        core = models.BPE(vocab={p.piece: i for i, p in enumerate(pieces)}, merges=merges_of(pieces),
                          unk_token=unknown, fuse_unk=True, byte_fallback=model.trainer_spec.byte_fallback)
    tokenizer = Tokenizer(core)
    tokenizer.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])
    steps = []
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex(f"[ {MARK}]+"), " "), normalizers.Strip()]
    return tokenizer, normalizers.Sequence(steps) if steps else None


class Encoder:
    def __init__(self, path: str, threads: int = THREADS):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        import sentencepiece

        model = load_model(path)
        self.original = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokenizer, self.normaliser = build(model)
        self.prefix = MARK if model.normalizer_spec.add_dummy_prefix else ""
        self.whole = any(MARK in p.piece.lstrip(MARK) for p in model.pieces if p.type == NORMAL) or not self.prefix
        self.differ: set[bytes] = set()  # failed chunks that the cache may hold
        self.cache = ChunkCache(self._checked)

    def _checked(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks, whose spaces stand for markers."""
        plain = [c.decode() for c in chunks]
        marked = [c.replace(" ", MARK) for c in plain]
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(marked, add_special_tokens=False)]
        decoded = self.tokenizer.decode_batch(encoded, skip_special_tokens=False)
        wanted = self.original.encode([c[len(self.prefix):] for c in plain], num_threads=1)
        out = []
        for chunk, text, ids, back, right in zip(chunks, marked, encoded, decoded, wanted):
            # a marker of its own is no empty text
            if (ids != right and text != self.prefix) or back != text:
                self.differ.add(chunk)
            out.append(np.array(ids, "<u4").tobytes())
        return out

    def _agree(self, texts: list[bytes], first: bytes) -> list[bool]:
        """Whether no chunk of each text failed."""
        if not self.differ:
            return [True] * len(texts)
        if self.whole:
            same = [not t or first + t not in self.differ for t in texts]
        else:
            data, starts, ends, counts = runs(texts, first)
            fine = [data[a:b] not in self.differ for a, b in zip(starts.tolist(), ends.tolist())]
            cuts = np.concatenate([[0], np.cumsum(counts)]).tolist()
            same = [all(fine[a:b]) for a, b in zip(cuts, cuts[1:])]
        # chunks that have left the cache are checked again when they come back
        self.differ = {c for c in self.differ if c in self.cache.known or c in self.cache.older}
        return same

    def _plain(self, text: bytes) -> bytes:
        if self.normaliser is not None:
            text = self.normaliser.normalize_str(text.decode()).encode()
        return text.replace(_MARK, b" ")

    def texts(self, texts: list[bytes]) -> tuple[list[np.ndarray], list[bool]]:
        """Ids of each text, and whether both libraries agree on all its
        chunks and the ids decode to it."""
        out, same = [], []
        for group in groups(texts):
            first = b" " if self.prefix else b""
            group = [self._plain(t) for t in group]
            if self.whole:
                out += [np.frombuffer(x, "<u4") for x in self.cache.ids([first + t if t else t for t in group])]
            else:
                out += encode_chunks(self.cache, *runs(group, first))
            same += self._agree(group, first)
        return out, same

    def decode(self, ids: list[int]) -> str:
        """The normalised text of the ids, without the dummy prefix."""
        text = self.tokenizer.decode(ids, skip_special_tokens=False)
        return text.removeprefix(self.prefix).replace(MARK, " ")


def encode(docs: DataFrame, path: str, threads: int = THREADS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ids, their number and crc32, and parity of each row, and the
    columns to ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("pieces", path, threads), lambda: Encoder(path, threads))
        for batch in (part for whole in batches for part in slices(whole, "text")):
            found, same = encoder.texts([t.as_py() for t in batch.column("text").cast(pa.binary())])
            n = np.array([len(x) for x in found], np.int64)
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            values = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(batch.column(c) for c in keep), pa.array(n), pa.array([zlib.crc32(x.tobytes()) for x in found], pa.int64()),
                 pa.array(same, pa.bool_()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                ["doc_id", *keep, "n_ids", "ids_crc32", "parity", "ids"])

    rows = docs.select("doc_id", *keep, text_of().alias("text"))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ("doc_id", *keep))
    return rows.mapInArrow(run, f"{kinds}, n_ids long, ids_crc32 long, parity boolean, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of the ids of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("pieces", path, THREADS), lambda: Encoder(path, THREADS))
        for batch in batches:
            texts = [encoder.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(read_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
