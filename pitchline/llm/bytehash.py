"""Vectorised hashing of every k-byte string of a buffer, and the
window-minimum choice of anchor positions (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

# An odd multiplier, its inverse modulo 2^64, mixing constants.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX_A = np.uint64(0xFF51AFD7ED558CCD)
MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 values."""
    x = x ^ (x >> np.uint64(32))
    x = x * MIX_A
    x ^= x >> np.uint64(29)
    x *= MIX_B
    x ^= x >> np.uint64(32)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; the longest made so far is kept."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


_POWERS: dict = {}
# bytes go through a mixing table, so that no byte weighs zero
_WEIGHTS = mix(np.arange(1, 257, dtype=np.uint64))


class PrefixHash:
    """Hash of any substring of ``data`` (uint8) from prefix sums: equal
    strings have equal hashes wherever they stand in the buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_WEIGHTS[data] * powers(BASE, n), out=self.sums[1:])
        self.inverse = powers(BASE_INV, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k bytes from each position on."""
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n + 1 - k]) * self.inverse[:n + 1 - k])


def sliding(op, x: np.ndarray, w: int) -> np.ndarray:
    """op (np.minimum or np.maximum) over each w consecutive values."""
    have, out = 1, x
    while 2 * have <= w:
        out = op(out[:-have], out[have:])
        have *= 2
    return op(out[:len(out) - (w - have)], out[w - have:]) if have < w else out


def anchors(grams: np.ndarray, ends: np.ndarray, length: int, k: int) -> np.ndarray:
    """Positions whose k-gram has the smallest hash in some ``length``-byte
    string inside one document (``ends``: where the documents end). Two
    equal strings of ``length`` bytes have the same anchors within them."""
    w = length - k + 1
    if len(grams) < w:
        return np.zeros(0, np.int64)
    low = sliding(np.minimum, grams, w)
    # strings that would cross the end of a document choose nothing
    for d in range(1, length):
        at = ends - d
        low[at[(at >= 0) & (at < len(low))]] = 0
    wide = np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)])
    return np.flatnonzero((sliding(np.maximum, wide, w) == grams) & (grams != 0))
