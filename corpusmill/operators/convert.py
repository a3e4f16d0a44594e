"""Documents → Markdown with per-document status (JOB-05, UDF-01, SNK-03).

The result table has one row per input: ``status`` ``ok`` / ``error`` (and
``skipped`` in incremental runs), the Markdown, the error text. A bad
document is a row, never a failed job.

Two converters:

* ``convert_html`` — native column expressions (``functions.html``); the
  whole job stays in the JVM.
* ``convert_with`` — any Python function ``bytes|str -> str`` (a PDF or
  office-format library, say) run by ``mapInArrow``: the function is
  created once per Python worker, rows arrive in Arrow batches, an
  exception becomes an ``error`` row. Select only the needed columns
  before calling it (Catalyst cannot prune through a Python operator) and
  drop already-finished inputs first (a join cannot be pushed below it).
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusmill.functions import html as H
from corpusmill.functions import text as T
from corpusmill.session import ship_package

#: Characters of converted text that a task holds before it hands them on
HELD_CHARS = 16 << 20


def convert_html(df: DataFrame, html_col: str = "html", key_cols: list[str] | None = None,
                 finish: str = "clean") -> DataFrame:
    """Native HTML converter: keys, status, md, error, complete. Every page
    that is there is converted; ``complete`` says whether it closes its
    ``html`` element (the end tag is optional, so its absence is no error)."""
    keys = key_cols if key_cols is not None else [c for c in df.columns if c != html_col]
    h = F.col(html_col)
    # the tag rules once per row, in their own projection: entity decoding
    # reads the result several times and Catalyst keeps it computed once
    staged = df.select(*keys, F.when(h.isNull(), "error").otherwise("ok").alias("status"),
                       F.when(h.isNull(), F.lit("no content")).alias("error"),
                       F.coalesce(H.is_complete(h), F.lit(False)).alias("complete"), H.tags_to_text(h).alias("__text"))
    md = H.finish_text(H.decode_entities(F.col("__text")), finish)
    return staged.select(*keys, "status", md.alias("md"), "error", "complete")


def _run_converter(make: Callable[[], Callable], schema: StructType):
    def run(batches):
        fn = make()  # once per Python worker, outside the batch loop

        def outcome(content):
            try:
                md = fn(content)
                if not isinstance(md, str):
                    raise TypeError(f"converter returned {type(md).__name__}, not str")
                return "ok", md, None
            except Exception as exc:  # noqa: BLE001 - the row records it
                return "error", None, f"{type(exc).__name__}: {exc}"

        for batch in batches:
            start, held, rows = 0, 0, []
            for i in range(batch.num_rows):
                rows.append(outcome(batch.column(1)[i].as_py()))
                held += len(rows[-1][1] or "")
                if held >= HELD_CHARS or i + 1 == batch.num_rows:
                    status, md, error = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, i + 1 - start), pa.array(status, pa.string()),
                         pa.array(md, pa.string()), pa.array(error, pa.string())],
                        names=[schema.names[0], "status", "md", "error"])
                    start, held, rows = i + 1, 0, []
    return run


def convert_with(df: DataFrame, make_converter: Callable[[], Callable], key_col: str,
                 content_col: str, finish: str = "clean") -> DataFrame:
    """Pluggable converter (UDF-01): one output row per input row, errors
    captured per row, the key keeps its type. ``make_converter`` returns the
    per-document function (built once per worker, so heavy models load
    once). The finish (``clean`` or ``strip``) runs afterwards in the JVM."""
    ship_package(df.sparkSession)
    slim = df.select(key_col, content_col)
    schema = StructType([slim.schema[key_col], StructField("status", StringType()),
                         StructField("md", StringType()), StructField("error", StringType())])
    out = slim.mapInArrow(_run_converter(make_converter, schema), schema)
    ok = F.col("status") == "ok"
    finished = T.clean_markdown("md") if finish == "clean" else T.strip_only("md")
    return out.withColumn("md", F.when(ok, finished))
