"""Hashes of every substring of a fixed length, and content-defined anchors, over byte arrays in numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLES = [np.random.default_rng(s).integers(0, 2**63, 256, dtype=np.uint64) * U(2) + U(1) for s in (11, 29)]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            m = len(self.up)
            one, other = U(pow(_BASE, m, 2**64)), U(pow(pow(_BASE, -1, 2**64), m, 2**64))
            self.up, self.down = np.r_[self.up, self.up * one], np.r_[self.down, self.down * other]
        return self.up[:n], self.down[:n]


_POWERS = Powers()


class Hasher:
    """Hashes of substrings of ``data`` by two prefix sums; equal bytes give equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, both: bool = False):
        up, self.down = _POWERS.get(len(data) + 1)
        self.sums = []
        for table in _TABLES[: 1 + both]:
            s = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(table[data] * up[:-1], out=s[1:])
            self.sums.append(s)

    def at(self, start, end, which: int = 0) -> np.ndarray:
        s = self.sums[which]
        return mix((s[end] - s[start]) * self.down[start] + (end - start).astype(np.uint64))

    def all(self, length: int, which: int = 0) -> np.ndarray:
        """The hash at each start of a substring of ``length``."""
        s = self.sums[which]
        n = len(s) - length
        return mix((s[length:] - s[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


def leftmost_minima(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values of ``h``, the place of its leftmost minimum (by the upper 40 bits)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    below = U((1 << 24) - 1)
    if len(h) > int(below):
        raise ValueError("at most 2**24 values at once")
    # The place stands in the lower bits, so that one minimum finds both.
    low, span = (h & ~below) | np.arange(len(h), dtype=np.uint64), 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if width > span:
        low = np.minimum(low[: span - width], low[width - span :])
    return (low & below).astype(np.int64)
