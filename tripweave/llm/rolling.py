"""Rolling hashes of byte strings in numpy: a hash of any stretch from one running sum."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

LIMIT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2**64
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    inverse = pow(_BASE, -1, 1 << 64)
    powers = [np.cumprod(np.r_[np.uint64(1), np.full(LIMIT, b, np.uint64)], dtype=np.uint64) for b in (_BASE, inverse)]
    return letters, *powers


class Rolling:
    """Hashes of stretches of one byte array of at most ``LIMIT`` bytes; equal stretches
    have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        letters, powers, self.inverse = _tables()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * powers[: len(data)], out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        """The hash of each stretch of one length, by start."""
        n = max(0, len(self.sums) - length)
        return mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n])

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by start, in three passes."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
