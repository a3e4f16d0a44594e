"""Shared helpers: reading tables, lineage cuts, bounded Arrow slices."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpusmill.session import ship_package, work_path

#: Text bytes that one Python step holds at a time (a longer text is one slice).
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch between the JVM and a Python worker.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: a lineage
    cut that every executor can read again after a loss."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Make the package importable in the Python workers, and keep the batches
    that go to them and back within ``batch_bytes`` (Spark's own bound, 64 MB
    and 10,000 rows, is held several times over by a task's two processes)."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))


_HELD: dict[str, Callable[[], None]] = {}


def holds(owner: str, release: Callable[[], None]) -> None:
    """``owner``'s tasks keep something in this worker for their next ones."""
    _HELD[owner] = release


def start_task(owner: str = "") -> None:
    """Where a task's Python work begins: Spark reuses its Python workers, and
    what other operators' tasks keep in this one (tokenizers, word memories)
    would take its memory from all later stages, so it goes back."""
    others = [k for k in _HELD if k != owner]
    for k in others:
        _HELD.pop(k)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library: it decides itself
            pass


def slices(batch: pa.RecordBatch, text_col: int, limit: int = SLICE_BYTES):
    """Cut an Arrow batch into runs of rows with at most ``limit`` bytes of
    text each (always at least one row)."""
    col = batch.column(text_col)
    ends = text_buffers(col)[1]
    start = 0
    while start < batch.num_rows:
        stop = start + 1
        while stop < batch.num_rows and ends[stop + 1] - ends[start] <= limit:
            stop += 1
        yield batch.slice(start, stop - start)
        start = stop


def text_buffers(col: pa.Array):
    """(bytes as uint8, offsets) of a string column; a null text is empty."""
    import numpy as np
    if not pa.types.is_large_string(col.type) and not pa.types.is_large_binary(col.type):
        col = col.cast(pa.large_binary() if pa.types.is_binary(col.type) else pa.large_string())
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_large_binary(col.type) else "")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    if data is None or len(data) == 0:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    raw = np.frombuffer(data, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
