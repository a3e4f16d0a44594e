"""Global order as data: consecutive positions and running counts.

A window without ``PARTITION BY`` moves every row into one task. Instead the
rows are range-partitioned and sorted (``orderBy``), tagged with
``monotonically_increasing_id`` (partition index in the upper bits, row
number within the partition in the lower 33 bits) and written once to the
shared checkpoint folder, which pins the partitioning. Per-partition
totals (one row per partition, so bounded by the partition count, not by
the data) give each partition its offset; that small table is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import work_path

_LOW_BITS = 33
_LOW_MASK = (1 << _LOW_BITS) - 1


def _ranked(df: DataFrame, order_by: list[Column | str], keep: list[str]) -> DataFrame:
    """The kept columns in order, written once below the checkpoint folder."""
    path = work_path(df.sparkSession, "ranked")
    out = df.orderBy(*order_by).select(*keep, F.monotonically_increasing_id().alias("__rid"))
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path) \
             .withColumn("__pid", F.shiftright("__rid", _LOW_BITS)) \
             .withColumn("__local", F.col("__rid").bitwiseAND(F.lit(_LOW_MASK)))


def _offsets(ranked: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per partition: the totals of all earlier partitions (exclusive prefix)."""
    per_part = ranked.groupBy("__pid").agg(*[c.alias(k) for k, c in sums.items()])
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: this window is over the partition count only
    return per_part.select("__pid", *[
        F.coalesce(F.sum(k).over(w), F.lit(0)).cast("long").alias(f"__off_{k}") for k in sums])


def with_position(df: DataFrame, order_by: list[Column | str], name: str = "pos") -> DataFrame:
    """Rows of ``df`` with ``name`` = 1, 2, 3, ... in the given order.

    Keys should be unique (paths are); ties get distinct positions in an
    unspecified order.
    """
    ranked = _ranked(df, order_by, df.columns)
    offs = _offsets(ranked, {"n": F.count(F.lit(1))})
    out = ranked.join(F.broadcast(offs), "__pid")
    return out.select(*df.columns, (F.col("__off_n") + F.col("__local") + 1).alias(name))


def running_counts(df: DataFrame, order_by: list[Column | str], flags: dict[str, Column],
                   name: str = "pos", keep: list[str] | None = None) -> DataFrame:
    """Position plus, for every flag, the number of rows up to and including
    this one where the flag holds (a global running ``count_if``). Only the
    columns in ``keep`` (default: all) are carried along."""
    keep = df.columns if keep is None else keep
    flagged = df.select("*", *[F.when(c, 1).otherwise(0).alias(f"__f_{k}") for k, c in flags.items()])
    ranked = _ranked(flagged, order_by, [*keep, *[f"__f_{k}" for k in flags]])
    sums = {"n": F.count(F.lit(1))}
    sums.update({k: F.sum(f"__f_{k}") for k in flags})
    offs = _offsets(ranked, sums)
    # running sums inside each range partition: the window's partition key is
    # the partition index, so every task holds one range partition
    w = Window.partitionBy("__pid").orderBy("__local").rowsBetween(Window.unboundedPreceding, 0)
    local = ranked.select("*", *[F.sum(f"__f_{k}").over(w).alias(f"__run_{k}") for k in flags])
    out = local.join(F.broadcast(offs), "__pid")
    return out.select(*keep, (F.col("__off_n") + F.col("__local") + 1).alias(name),
                      *[(F.col(f"__off_{k}") + F.col(f"__run_{k}")).cast("long").alias(k) for k in flags])


def first_and_last(df: DataFrame, order_by: list[Column | str], k: int = 3,
                   desc_by: list[Column] | None = None) -> DataFrame:
    """First ``k`` and last ``k`` rows in the given order, tagged ``part`` =
    'first' / 'last' (SRT-05). Two TakeOrderedAndProject: every task keeps
    ``k`` rows, the merge sees ``k`` per task. Overlaps below ``2k`` rows, as
    the source's ``[:3]`` and ``[-3:]`` do."""
    if desc_by is None:
        raise ValueError("desc_by: the same keys in descending order")
    first = df.orderBy(*order_by).limit(k).withColumn("part", F.lit("first"))
    last = df.orderBy(*desc_by).limit(k).withColumn("part", F.lit("last"))
    return first.unionByName(last)
