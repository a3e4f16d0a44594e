"""What still has to be fetched or converted: wanted ⟕ present.

Every existence test of the source (``path.exists()``, ``exists() and
st_size > N``) is a join here. No broadcast is forced: manifests on both
sides grow with the data, so Catalyst/AQE pick broadcast only when the
measured side is under ``spark.sql.autoBroadcastJoinThreshold`` and a
sort-merge join otherwise; paths are unique keys, so no key is hot, and AQE
skew handling covers duplicated listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.fixed import (CONVERTED_DIR, DATA_FILE_MIN_BYTES, MARKDOWN_SUFFIX,  # noqa: F401
                              SHARD_MIN_BYTES, TARGET_ROOT_SIBLING)
from corpusmill.functions import paths as P
from corpusmill.functions import text as T


def pending(plan: DataFrame, done: DataFrame, on: str | list[str] = "path") -> DataFrame:
    """Rows of ``plan`` with no match in ``done`` (JON-01, left anti)."""
    keys = [on] if isinstance(on, str) else on
    return plan.join(done.select(*keys), keys, "left_anti")


def already_done(plan: DataFrame, done: DataFrame, on: str | list[str] = "path") -> DataFrame:
    """Rows of ``plan`` with a match in ``done`` (JON-04, left semi)."""
    keys = [on] if isinstance(on, str) else on
    return plan.join(done.select(*keys), keys, "left_semi")


def mark_present(wanted: DataFrame, present: DataFrame, key: str = "path",
                 min_bytes: int | None = None, length_col: str = "length") -> DataFrame:
    """All wanted rows plus ``present BOOLEAN``: a match exists (and, when
    ``min_bytes`` is given, is strictly larger than it) (JON-02, FLT-07).

    The size test sits in the join condition, so a too-small file is simply
    not a match. ``present`` is de-duplicated on the key first, so a listing
    that repeats a path cannot multiply wanted rows.
    """
    right = present if min_bytes is None else present.where(F.col(length_col) > min_bytes)
    right = right.select(F.col(key).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    joined = wanted.join(right, wanted[key] == right["__k"], "left")
    return joined.select(*[wanted[c] for c in wanted.columns],
                         F.coalesce(F.col("__hit"), F.lit(False)).alias("present"))


def plan_acquisition(wanted: DataFrame, present: DataFrame, key: str = "path",
                     min_bytes: int | None = None, url_col: str | None = None) -> DataFrame:
    """Plan of a fetch run (JOB-04): ``status`` is ``unavailable`` (blank
    URL; the row keeps its number), ``skip`` (already present) or ``fetch``.
    The blank-URL test comes first, as in the source. The fetch itself is not
    part of the library."""
    marked = mark_present(wanted, present, key, min_bytes)
    status = F.when(F.col("present"), "skip").otherwise("fetch")
    if url_col is not None:
        status = F.when(T.is_blank(F.col(url_col)), "unavailable").otherwise(status)
    return marked.withColumn("status", status).drop("present")


def apply_outcomes(plan: DataFrame, outcomes: DataFrame, key: str = "path",
                   outcome_col: str = "outcome", error_col: str | None = "error",
                   attempt_col: str | None = None) -> DataFrame:
    """Run results (JON-03): every planned row kept once; rows planned for
    fetch take the recorded outcome (``success``/``fail``), others keep their
    plan status. ``outcomes`` is the fetch log of the run; of several entries
    for a key the one with the highest ``attempt_col`` counts, and without
    such a column a success before a failure. The log is reduced to a row per
    key (with partial maxima) before the join."""
    error = F.col(error_col) if error_col else F.lit(None).cast("string")
    order = F.col(attempt_col) if attempt_col else (F.col(outcome_col) == "success").cast("int")
    last = F.max(F.struct(order.alias("n"), F.col(outcome_col).alias("o"), error.alias("e"))).alias("__last")
    log = outcomes.groupBy(F.col(key).alias("__k")).agg(last) \
                  .select("__k", F.col("__last.o").alias("__o"), F.col("__last.e").alias("__e"))
    j = plan.join(log, plan[key] == log["__k"], "left")
    status = F.when(F.col("status") == "fetch", F.coalesce(F.col("__o"), F.lit("fail"))).otherwise(F.col("status"))
    err = F.when(status == "fail", F.coalesce("__e", F.lit("no outcome recorded")))
    return j.select(*[plan[c] for c in plan.columns if c != "status"], status.alias("status"), err.alias("error"))


def sibling_target_root(source_root: str) -> str:
    """The mirrored tree's root: a folder next to the source root."""
    parent = source_root.rstrip("/").rpartition("/")[0]
    return f"{parent}/{TARGET_ROOT_SIBLING}" if parent else TARGET_ROOT_SIBLING


def mirrored_target(df: DataFrame, path_col: str = "path", suffix: str = MARKDOWN_SUFFIX) -> DataFrame:
    """Target under the sibling root (``sibling_target_root``) that mirrors
    the source folders, last suffix replaced (PRJ-08, STR-12):
    ``a/b/x.pdf`` → ``a/b/x.md``; a file named ``.pdf`` becomes ``.pdf.md``.
    Paths stay relative to their roots."""
    return df.withColumn("target_path", P.with_suffix(F.col(path_col), suffix))


def nested_target(df: DataFrame, path_col: str = "path", folder: str = CONVERTED_DIR,
                  suffix: str = MARKDOWN_SUFFIX) -> DataFrame:
    """Target in a ``Converted/`` folder next to the source (PRJ-09)."""
    p = F.col(path_col)
    name = F.concat(P.stem(P.file_name(p)), F.lit(suffix))
    return df.withColumn("target_path", F.concat_ws("/", F.array_append(P.folders(p), F.lit(folder)), name))


def target_collisions(df: DataFrame, target_col: str = "target_path", source_col: str = "path") -> DataFrame:
    """Targets claimed by more than one source (``a.pdf`` and ``a.PDF`` in
    one folder), reported instead of silently overwritten. Partial
    aggregation bounds what each task ships per target."""
    return (df.groupBy(target_col)
            .agg(F.count(F.lit(1)).alias("n_sources"),
                 F.min(source_col).alias("first_source"), F.max(source_col).alias("last_source"))
            .where(F.col("n_sources") > 1))
