"""Vectorised 64-bit hashes of substrings of bytes."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spreads the bits of 64-bit numbers: two rounds of multiplying and folding the upper half down."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((0xD6E8FEB86659FD93 * (seed + 1)) & (2**64 - 1))
        for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ (x >> np.uint64(32))) * np.uint64(factor)
        return x ^ (x >> np.uint64(29))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of BASE and of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, factor in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            row = np.full(size, factor, np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"], _POWERS["down"]


def byte_values(seed: int = 0) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64), 100 + seed)


class Prefixes:
    """Prefix polynomial hashes of a run of bytes: the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        self.up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte_values(seed)[data] * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end], alike for equal bytes wherever they stand."""
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))
