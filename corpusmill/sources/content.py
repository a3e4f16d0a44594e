"""File content for manifest rows (SRC-10).

``binaryFile`` hides names starting with '.' or '_' and cannot be driven by
a manifest; this reads exactly the listed files, in the tasks that hold
their rows (``mapInArrow`` + ``pyarrow.fs``), so a converter of binary
formats gets ``content BINARY`` next to the path. A task holds at most
``HELD_BYTES`` of content, or one file, before it hands a batch on.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from corpusmill.session import ship_package
from corpusmill.sources.manifest import _filesystem

HELD_BYTES = 32 << 20


def with_content(manifest: DataFrame, root: str, path_col: str = "path") -> DataFrame:
    """Adds ``content`` (the file bytes) and ``read_error`` (``None`` when
    the file was read) to every manifest row; a missing or unreadable file is
    a row with an error, not a failed task."""
    ship_package(manifest.sparkSession)
    schema = manifest.select("*").schema.add("content", "binary").add("read_error", "string")
    place = manifest.columns.index(path_col)

    def run(batches):
        filesystem, base = _filesystem(root)
        for batch in batches:
            start, held, contents, errors = 0, 0, [], []

            def done(stop):
                part = batch.slice(start, stop - start)
                return pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(contents, pa.binary()), pa.array(errors, pa.string())], names=schema.names)

            for i, rel in enumerate(batch.column(place).to_pylist()):
                try:
                    with filesystem.open_input_stream(f"{base}/{rel}") as f:
                        contents.append(f.read())
                    errors.append(None)
                    held += len(contents[-1])
                except Exception as exc:  # noqa: BLE001 - recorded per row
                    contents.append(None)
                    errors.append(f"{type(exc).__name__}: {exc}")
                if held >= HELD_BYTES:
                    yield done(i + 1)
                    start, held, contents, errors = i + 1, 0, [], []
            if contents:
                yield done(batch.num_rows)

    return manifest.mapInArrow(run, schema)
