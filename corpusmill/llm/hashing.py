"""64-bit hashes of byte ranges, computed for whole buffers with numpy.

A range hash is the difference of two prefix sums of ``value(byte) * B**i``
(all modulo 2**64, ``B`` odd so that the offset divides out), followed by a
finalising mix with the range's length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=4)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.ones(1 << bits, dtype=np.uint64)
    have = 1
    while have < len(out):
        out[have:2 * have] = out[:have] * np.uint64(pow(base, have, 1 << 64))
        have *= 2
    return out


def _upto(base: int, n: int) -> np.ndarray:
    return _powers(base, max(16, int(n).bit_length()))[:n]


class Ranges:
    """Prefix sums over one buffer; ``hash(starts, ends)`` hashes ranges."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data] * _upto(_BASE, len(data)), out=self.sums[1:])
        self.inverse = _upto(_INVERSE, len(data) + 1)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes (order matters)."""
    out = np.full(len(parts[0]), len(parts), dtype=np.uint64)
    for p in parts:
        out = mix(out * np.uint64(0xE7037ED1A0B428DB) + p)
    return out
