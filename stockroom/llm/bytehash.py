"""64-bit hashes of words and word windows, for a whole text at once.

The bytes of a text are summed as a polynomial modulo 2**64; the hash of any
span is a difference of two running sums divided by the power at its start.
The base is odd, so that division is a product with its inverse. A final
mix spreads the bits. Equal spans have equal hashes in every process.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class ByteHasher:
    """Keeps the tables of powers; one instance serves a whole task."""

    def __init__(self) -> None:
        self.powers = np.ones(1, dtype=np.uint64)
        self.inverse = np.ones(1, dtype=np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            one = np.ones(1, dtype=np.uint64)
            up = np.full(n, BASE, dtype=np.uint64)
            down = np.full(n, pow(BASE, -1, 2**64), dtype=np.uint64)
            self.powers = np.concatenate([one, np.cumprod(up)])
            self.inverse = np.concatenate([one, np.cumprod(down)])

    def spans(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of codes[start:end] (codes: any unsigned integers)."""
        self.grow(len(codes))
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.powers[: len(codes)], out=sums[1:])
        raw = (sums[ends] - sums[starts]) * self.inverse[starts]
        return mixed(raw + (ends - starts).astype(np.uint64))

    def words(self, data: bytes) -> np.ndarray:
        """Hashes of the words of ``data``, in order."""
        codes = np.frombuffer(data, dtype=np.uint8)
        starts, ends = word_spans(codes)
        return self.spans(codes, starts, ends)


def word_spans(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACE[codes]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` items; all items as one if fewer;
    none if there are none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, size)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = mixed(out * np.uint64(BASE) + hashes[k : n - width + 1 + k])
    return out
