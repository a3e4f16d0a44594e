"""Run reports: tallies, detail lines, failure lists, running progress.

A result table has one row per input with a ``status`` column; every report
is an aggregate or projection of it (no driver-side counters)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.fixed import CONVERT_STATUSES, DOWNLOAD_STATUSES, FETCH_STATUSES, PROGRESS_EVERY  # noqa: F401
from corpusmill.functions import paths as P
from corpusmill.operators import ordering as O


def tally(results: DataFrame, statuses=FETCH_STATUSES, status_col: str = "status",
          ok: str = "success", fail: str = "fail") -> DataFrame:
    """One row: ``n_total`` (all inputs), ``n_<status>`` for each status and
    ``n_attempted`` = ok + fail (skips and unavailable excluded) (AGG-03,
    AGG-07)."""
    s = F.col(status_col)
    aggs = [F.count(F.lit(1)).alias("n_total")]
    aggs += [F.count_if(s == st).alias(f"n_{st}") for st in statuses]
    aggs.append(F.count_if(s.isin(ok, fail)).alias("n_attempted"))
    return results.agg(*aggs)


def detail_lines(results: DataFrame, path_col: str = "path", status_col: str = "status",
                 fail: str = "fail") -> DataFrame:
    """``STATUS: name``: the base name for success and skip, the full path
    for a failure (PRJ-10, STR-13, STR-15)."""
    p = F.col(path_col)
    who = F.when(F.col(status_col) == fail, p).otherwise(P.file_name(p))
    return results.select(p, F.concat(F.upper(status_col), F.lit(": "), who).alias("detail"))


def failures(results: DataFrame, status_col: str = "status", fail: str = "error") -> DataFrame:
    """Failed rows only (FLT-08)."""
    return results.where(F.col(status_col) == fail)


def progress(results: DataFrame, order_by, every: int = PROGRESS_EVERY,
             statuses=FETCH_STATUSES, status_col: str = "status") -> DataFrame:
    """Running counts per status after every ``every``-th item in the given
    order (WIN-03), without moving all rows into one task (see
    ``ordering.running_counts``)."""
    flags = {st: F.col(status_col) == st for st in statuses}
    run = O.running_counts(results, order_by, flags, keep=[])
    return run.where(F.col("pos") % every == 0).select("pos", *statuses)
