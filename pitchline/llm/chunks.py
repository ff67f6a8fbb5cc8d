"""Encoding of texts piece by piece through a bounded cache.

Both tokenizers here never join characters across certain boundaries, so a
text's ids are those of its chunks, one after the other. The chunks of a
group of texts are found with numpy and sorted by 64-bit hashes; each chunk
is compared byte by byte with the one that stands for its hash, and goes for
itself if it differs. Each distinct one is looked up once, and encoded by
the library when it is new. The cache is emptied by halves, so memory stays
bounded on any vocabulary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pitchline.llm.bytehash import PrefixHash

LIMIT = 150_000
GROUP = 1 << 19
AT_ONCE = 4096  # chunks given to a library at a time


class ChunkCache:
    """Chunk -> its ids as little-endian 32-bit integers. Two generations of
    ``limit`` entries each: what is used again outlives the older one."""

    def __init__(self, encode: Callable[[list], Iterable[bytes]], limit: int = LIMIT):
        self.encode, self.limit, self.known, self.older = encode, limit, {}, {}

    def ids(self, chunks: list) -> list[bytes]:
        known, older = self.known, self.older
        found = list(map(known.get, chunks))
        gaps = [i for i, v in enumerate(found) if v is None]
        if gaps:
            fresh = {c: older.get(c) for c in (chunks[i] for i in gaps)}
            order = [c for c, v in fresh.items() if v is None]
            for a in range(0, len(order), AT_ONCE):
                part = order[a:a + AT_ONCE]
                fresh.update(zip(part, self.encode(part)))
            for i in gaps:
                found[i] = fresh[chunks[i]]
            known.update(fresh)
            if len(known) > self.limit:
                self.known, self.older = {}, known
        return found


def groups(texts: list[bytes], size: int = GROUP) -> Iterator[list[bytes]]:
    """Runs of texts of about ``size`` bytes; one text is never cut."""
    out, held = [], 0
    for t in texts:
        out.append(t)
        held += len(t)
        if held >= size:
            yield out
            out, held = [], 0
    if out:
        yield out


def slices(batch: pa.RecordBatch, column: str, size: int = 2 * GROUP) -> Iterator[pa.RecordBatch]:
    """The rows of an Arrow batch by about ``size`` bytes of a text column."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    block = np.cumsum(lengths, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(lengths)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def words(texts: list[bytes], kinds: np.ndarray, single: int = -1) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of bytes of one kind (a table of 256; 0 is a gap, as must be
    the line end; bytes of the kind ``single`` stand alone): data, starts,
    ends, and how many each text has."""
    data = b"\n".join([*texts, b""])
    kind = kinds[np.frombuffer(data, np.uint8)]
    edge = np.ones(len(kind) + 1, bool)
    edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == single)
    starts, ends = np.flatnonzero(edge[:-1] & (kind != 0)), np.flatnonzero(edge[1:] & (kind != 0)) + 1
    borders = np.cumsum([len(t) + 1 for t in texts])
    return data, starts, ends, np.diff(np.searchsorted(starts, borders), prepend=0)


def runs(texts: list[bytes], first: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Each text, with ``first`` (a space or nothing) before it, cut before
    every run of spaces: as for :func:`words`."""
    texts = [first + t if t else t for t in texts]
    data = b"".join(texts)
    space = np.frombuffer(data, np.uint8) == 32
    start = space.copy()
    start[1:] &= ~space[:-1]
    borders = np.cumsum([len(t) for t in texts])
    start[[b - len(t) for b, t in zip(borders.tolist(), texts) if t]] = True
    starts = np.flatnonzero(start)
    return data, starts, np.append(starts[1:], len(data)), np.diff(np.searchsorted(starts, borders), prepend=0)


def alike(data: np.ndarray, starts: np.ndarray, others: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the ``lengths`` bytes from ``starts`` are those from ``others``."""
    out = np.ones(len(starts), bool)
    check = np.flatnonzero((starts != others) & (lengths > 0))
    n = lengths[check]
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    differ = data[np.repeat(starts[check], n) + inside] != data[np.repeat(others[check], n) + inside]
    out[np.repeat(check, n)[differ]] = False
    return out


def encode(cache: ChunkCache, data: bytes, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The ids of every text (``counts`` chunks each)."""
    if not len(starts):
        return [np.zeros(0, "<u4") for _ in counts]
    letters = np.frombuffer(data, np.uint8)
    hashes = PrefixHash(letters).of(starts, ends)
    _, first, chunk = np.unique(hashes, return_index=True, return_inverse=True)
    lengths, other = ends - starts, first[chunk]
    same = lengths == lengths[other]
    same[same] = alike(letters, starts[same], starts[other[same]], lengths[same])
    if not same.all():  # chunks of one hash that are not the same
        odd = np.flatnonzero(~same)
        chunk[odd] = len(first) + np.arange(len(odd))
        first = np.concatenate([first, odd])
    found = cache.ids([data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
    flat = np.frombuffer(b"".join(found), "<u4")
    sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
    offsets = np.cumsum(sizes) - sizes
    n = sizes[chunk]
    ids_before = np.cumsum(n) - n
    ids = flat[np.repeat(offsets[chunk] - ids_before, n) + np.arange(int(n.sum()))]
    last = np.cumsum(counts)
    total = np.concatenate([ids_before, [len(ids)]])
    return np.split(ids, total[last[:-1]])


#: One per Python worker and key, kept between tasks.
_KEPT: dict = {}


def kept(key, make: Callable):
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]
