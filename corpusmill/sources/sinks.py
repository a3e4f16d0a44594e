"""Writers: CSV as Python's ``csv`` module writes it, tables, the spec.

Spark writes one part file per task; a single-file CSV would route every row
through one task, so it is not offered. Downstream readers take the folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Spark's CSV defaults differ from Python's csv module: they trim blanks,
# escape quotes with a backslash and write "" for empty strings.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}
CSV_READ_OPTIONS = {
    "header": "true",
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, headers: list[str] | None = None, mode: str = "overwrite") -> None:
    """Header row, fixed column order (``headers``; other columns ignored),
    UTF-8 (SNK-01)."""
    out = df.select(*headers) if headers else df
    out.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, headers: list[str]) -> DataFrame:
    """Read back a labelled CSV: every column a string, empty → ``""``."""
    schema = ", ".join(f"`{h}` STRING" for h in headers)
    df = spark.read.schema(schema).options(**CSV_READ_OPTIONS).csv(path)
    return df.select(*[F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(h) for h in headers])


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet table (summaries, reports, Markdown results: SNK-02/03/06)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """A small driver-side document (the column spec, SNK-05) written through
    Hadoop's file system so that it lands on the same storage as the data."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text_file(spark: SparkSession, path: str) -> str | None:
    """Counterpart of ``write_text_file``; ``None`` when the file is absent."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0][0] if rows else ""
