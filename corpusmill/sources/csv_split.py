"""CSV with quoted line breaks, read in parallel within a file (SNK-01).

Spark's ``multiLine`` reader gives a whole file to one task. Here a file is
read as lines, in byte ranges. A line begins inside a quoted value exactly if
the number of quotes before it in its file is odd, so one number per byte
range says where its first record starts:

1. the quotes of each byte range are counted (lines only, partial sums);
2. a running sum per file over its byte ranges gives each range's state;
3. the lines are read again and joined to records within their range, in
   order and without a shuffle of texts;
4. only the pieces of records that cross from one range into the next, at
   most two a range, are grouped and put together.

The rule holds for files whose quotes are all opened, closed and doubled as
Python's and Spark's writers do. A file that ends inside a quoted value fails
the query and is named, since its records are not defined.
"""

from __future__ import annotations

import csv
import io

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.session import ship_package
from corpusmill.sources.sinks import CSV_READ_OPTIONS, CSV_WRITE_OPTIONS, write_text_file

BROADCAST_RANGES = 500_000   # byte ranges; a row of the broadcast is under 100 bytes
HEADER_FILE = "header.csv"   # sorts before the parts
_RANGE = ["file", "start", "length"]
_PIECES = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("place", pa.int8()), ("first", pa.bool_()),
                     ("text", pa.binary())])
_PIECES_DDL = "file BIGINT, start BIGINT, place TINYINT, first BOOLEAN, text BINARY"
# where a piece of text stands: a whole record, or a part of one
WHOLE, THROUGH, HEAD, TAIL = 0, 1, 2, 3


def write_csv_ordered(df: DataFrame, path: str, headers: list[str]) -> None:
    """Parts in the order of ``df`` with one header before them: the files of
    the folder in name order, put end to end, are one ordered CSV file with
    one header. No task and no driver holds more than its own part."""
    options = {**CSV_WRITE_OPTIONS, "header": "false"}
    df.select(*headers).write.mode("overwrite").options(**options).csv(path)
    line = io.StringIO()
    csv.writer(line, lineterminator="\n").writerow(headers)
    write_text_file(df.sparkSession, f"{path.rstrip('/')}/{HEADER_FILE}", line.getvalue())


def _lines(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    meta = F.col("_metadata")
    return reader.text(path).select(
        F.xxhash64(meta["file_path"]).alias("file"), meta["file_path"].alias("name"),
        meta["file_block_start"].alias("start"), meta["file_block_length"].alias("length"), "value")


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, start, length, opened): whether the range starts inside a quoted
    value."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    per = lines.groupBy("name", *_RANGE).agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("name").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("name")
    unclosed = F.raise_error(F.concat(F.lit("CSV file ends inside a quoted value: "), F.col("name")))
    opened = F.coalesce(F.sum("odd").over(before) % 2, F.lit(0)) == 1
    return per.select(*_RANGE, F.when(F.sum("odd").over(whole) % 2 == 1, unclosed).otherwise(opened).alias("opened"))


def _records(batches):
    """Lines of byte ranges, each range's in order → records and pieces of
    records. A record is held until its last line is seen."""
    key, held, inside, crossing, first = None, [], False, False, False
    out = []

    def close(at_end: bool):
        # crossing: the held lines belong to a record of an earlier range
        place = (THROUGH if at_end else HEAD) if crossing else (TAIL if at_end else WHOLE)
        out.append((*key, place, first, b"\n".join(held)))

    def batch():
        cols = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECES)], schema=_PIECES)

    for b in batches:
        files, starts, opens = (b.column(n).to_pylist() for n in ("file", "start", "opened"))
        odd = [n % 2 for n in pc.count_substring(b.column("value"), '"').to_pylist()]
        for i, value in enumerate(b.column("value").to_pylist()):
            if (files[i], starts[i]) != key:
                if held:
                    close(at_end=True)
                key, held = (files[i], starts[i]), []
                inside = crossing = opens[i]
                first = starts[i] == 0
            held.append(value)
            inside ^= bool(odd[i])
            if not inside:
                close(at_end=False)
                held, crossing, first = [], False, False
        if out:
            yield batch()
    if held:
        close(at_end=True)
    if out:
        yield batch()


def read_records(spark: SparkSession, path: str, glob: str | None = None, header: bool = True) -> DataFrame:
    """The records of CSV files as texts (column ``text``), without empty
    ones and, with ``header``, without each file's first."""
    ship_package(spark)
    lines = _lines(spark, path, glob)
    ranges = _ranges(lines).checkpoint()
    small = ranges.count() <= BROADCAST_RANGES
    numbered = lines.drop("name").withColumn("row", F.monotonically_increasing_id())
    joined = numbered.join(F.broadcast(ranges) if small else ranges, _RANGE, "left")
    if not small:  # a shuffled join loses the order of the lines
        joined = joined.repartition(*_RANGE).sortWithinPartitions(*_RANGE, "row")
    moved = F.raise_error(F.lit("the byte ranges of the files changed between two reads"))
    pieces = joined.select("file", "start", F.coalesce("opened", moved.cast("boolean")).alias("opened"),
                           F.col("value").cast("binary").alias("value")).mapInArrow(_records, _PIECES_DDL)
    whole = pieces.where(F.col("place") == WHOLE).select("first", "text")
    # a record that crosses ranges starts with a tail; what follows up to the next tail is its rest
    parts = pieces.where(F.col("place") != WHOLE)
    along = Window.partitionBy("file").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, 0)
    crossed = parts.withColumn("record", F.count_if(F.col("place") == TAIL).over(along)).groupBy("file", "record").agg(
        F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("start", "place", "text"))).alias("parts"))
    joined_parts = crossed.select("first", F.array_join(F.transform("parts", lambda p: p["text"].cast("string")), "\n")
                                  .cast("binary").alias("text"))
    out = whole.unionByName(joined_parts)
    if header:
        out = out.where(~F.col("first"))
    return out.select(F.col("text").cast("string").alias("text")).where("text <> ''")


def read_csv_split(spark: SparkSession, path: str, headers: list[str], glob: str | None = None,
                   header: bool = True) -> DataFrame:
    """Like ``sinks.read_csv`` (every column a string, empty → ``""``), with
    all byte ranges of a file read in parallel. ``header=False`` and
    ``glob='part-*'`` for a folder of ``write_csv_ordered``."""
    schema = ", ".join(f"`{h}` STRING" for h in headers)
    options = {k: v for k, v in CSV_READ_OPTIONS.items() if k not in ("header", "multiLine")}
    row = F.from_csv("text", schema, options).alias("row")
    rows = read_records(spark, path, glob, header).select(row)
    return rows.select(*[F.coalesce(F.col("row")[h], F.lit("")).alias(h) for h in headers])
