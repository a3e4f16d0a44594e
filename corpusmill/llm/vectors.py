"""Vectors out of Arrow list columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def dense(col: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, matrix) of the vectors without null or non-finite components;
    shorter ones are filled up with zeros."""
    rows, out = [], []
    size = pc.list_value_length(col).fill_null(-1).to_numpy()
    for n in np.unique(size[size >= 0]).tolist():
        at = np.flatnonzero(size == n)
        flat = col.take(pa.array(at)).flatten()
        bad = flat.is_null().to_numpy(zero_copy_only=False)
        x = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(at), n)
        ok = np.isfinite(x).all(axis=1) & ~bad.reshape(len(at), n).any(axis=1)
        wide = np.zeros((int(ok.sum()), width))
        wide[:, :n] = x[ok]
        rows.append(at[ok])
        out.append(wide)
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, width))
    rows, out = np.concatenate(rows), np.concatenate(out)
    order = np.argsort(rows, kind="stable")
    return rows[order], out[order]


def blobs(matrix: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(matrix)], pa.binary())


def matrix(col, width: int, dtype) -> np.ndarray:
    """Rows of a binary column (or list of bytes) as one matrix."""
    parts = col.to_pylist() if hasattr(col, "to_pylist") else col
    return np.frombuffer(b"".join(parts), dtype).reshape(len(parts), width)
