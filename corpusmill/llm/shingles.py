"""Word shingles of whole texts as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from corpusmill.llm.hashing import Ranges, combine, mix

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, *range(9, 14)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of every word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = _LOWER[data]
    inside = ~_SEPARATOR[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    open_ = inside.copy()
    open_[1:] &= ~inside[:-1] | first[1:-1]
    close = inside.copy()
    close[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(open_), np.flatnonzero(close) + 1
    return Ranges(data).hash(starts, ends), np.searchsorted(offsets[1:], starts, side="right")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted by hash. A text of fewer words
    has its whole sequence as one shingle; one without words has none."""
    n = len(offsets) - 1
    word, owner = words(data, offsets)
    count = np.bincount(owner, minlength=n)
    start = np.cumsum(count) - count
    whole = max(0, len(word) - size + 1)
    long = combine([word[i:i + whole] for i in range(size)]) if whole else np.zeros(0, np.uint64)
    out = []
    for s, c in zip(start.tolist(), count.tolist()):
        if c >= size:
            out.append(np.unique(long[s:s + c - size + 1]))
        elif c:
            out.append(combine([word[s + i:s + i + 1] for i in range(c)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_hash(shingles: np.ndarray, salt: int) -> int:
    """64-bit hash of a set (order does not matter)."""
    total = mix(shingles + np.uint64(salt)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])
