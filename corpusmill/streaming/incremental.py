"""Incremental conversion (STM-01): each run converts only what is new.

Layout below one shared folder::

    results/batch=<seq>/   key, status, md, error of one run or micro-batch
    keys/batch=<seq>/      the same rows without texts: key, status, attempts
    base/upto=<seq>/       one row per key over all batches <= seq

A batch's folders are written with ``overwrite`` and every decision reads
only batches with a *smaller* number, never a folder that is being written.
A micro-batch that is replayed, after a lost driver or commit marker,
therefore makes the same decisions again and writes the same rows.

State is keys only: what is finished (``ok``) and how often a key failed.
Every ``COMPACT_EVERY`` batches it is folded into one table, so a batch reads
one base and a few small tables. Decisions are made on the input's keys; its
documents are read once, by the converter, and cross the network only where
the keys to leave out are too many to broadcast (``BROADCAST_KEYS``).

Failed inputs are not copied. They are read again from where they came in a
retry pass of their own, up to ``max_attempts`` times; a newer version of a
failed input is converted when it arrives. Of several versions of a key in one
batch the newest counts, by ``version`` (or any one, without such a column).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.session import work_path

Converter = Callable[[DataFrame], DataFrame]
STREAM_SEQ_STEP = 1_000
COMPACT_EVERY = 16
BROADCAST_KEYS = 1_000_000
MAX_ATTEMPTS = 3


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Batch numbers of the finished folders ``<name>=<n>`` below ``folder``
    (one folder listing)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if "=" in name and fs.exists(done):
            found.append(int(name.partition("=")[2]))
    return sorted(found)


def _folded(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: finished or not, attempts, its last batch."""
    return rows.groupBy(key).agg(F.max("done").alias("done"), F.sum("attempts").alias("attempts"),
                                 F.max("batch").alias("batch"))


def key_state(spark: SparkSession, state_dir: str, key: str, before: int) -> DataFrame | None:
    """(key, done, attempts, batch) over the batches with a number below
    ``before``; None if there are none."""
    bases = [n for n in _numbers(spark, f"{state_dir}/base") if n < before]
    base = bases[-1] if bases else None
    tables = [] if base is None else [spark.read.parquet(f"{state_dir}/base/upto={base}")]
    for n in _numbers(spark, f"{state_dir}/keys"):
        if (base is None or n > base) and n < before:
            rows = spark.read.parquet(f"{state_dir}/keys/batch={n}")
            tables.append(rows.select(key, (F.col("status") == "ok").alias("done"),
                                      F.lit(1).cast("long").alias("attempts"), F.lit(n).cast("long").alias("batch")))
    if not tables:
        return None
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return _folded(out, key) if len(tables) > 1 or base is None else out


def _without(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of other keys. The rows are not shuffled while ``keys`` fits a
    broadcast, which is counted first."""
    n = keys.count()
    if n == 0:
        return rows
    return rows.join(F.broadcast(keys) if n <= BROADCAST_KEYS else keys, key, "left_anti")


def newest_versions(rows: DataFrame, key: str, version: str | None) -> DataFrame:
    """One row per key. Only the rows of repeated keys are grouped."""
    repeated = rows.groupBy(key).count().where("count > 1").select(key)
    n = repeated.count()
    if n == 0:
        return rows
    hint = F.broadcast(repeated) if n <= BROADCAST_KEYS else repeated
    order = [F.col(version)] if version else []
    several = rows.join(hint, key, "left_semi")
    one = several.groupBy(key).agg(F.max(F.struct(*order, *[F.col(c).alias(f"v{i}") for i, c in enumerate(rows.columns)]))
                                   .alias("last"))
    one = one.select(*[F.col(f"last.v{i}").alias(c) for i, c in enumerate(rows.columns)])
    return rows.join(hint, key, "left_anti").unionByName(one)


def run_batch(spark: SparkSession, inputs: DataFrame, convert: Converter, key: str, state_dir: str,
              seq: int, version: str | None = None) -> None:
    """One step: the newest version of every input key that is not finished
    is converted, and the results and their keys are written as batch
    ``seq``. Null keys are left out."""
    inputs = inputs.where(F.col(key).isNotNull())
    state = key_state(spark, state_dir, key, seq)
    todo = inputs
    if state is not None:
        finished = state.where("done").select(key).join(inputs.select(key).distinct(), key, "left_semi")
        todo = _without(inputs, finished, key)
    convert(newest_versions(todo, key, version)).write.mode("overwrite").parquet(f"{state_dir}/results/batch={seq}")
    spark.read.parquet(f"{state_dir}/results/batch={seq}").select(key, "status") \
        .write.mode("overwrite").parquet(f"{state_dir}/keys/batch={seq}")
    bases = _numbers(spark, f"{state_dir}/base")
    since = [n for n in _numbers(spark, f"{state_dir}/keys") if n <= seq and (not bases or n > bases[-1])]
    if len(since) >= COMPACT_EVERY:
        # the batch before this one is the last that cannot be replayed any more
        key_state(spark, state_dir, key, seq).write.mode("overwrite").parquet(f"{state_dir}/base/upto={since[-2]}")


def failed_keys(spark: SparkSession, state_dir: str, key: str, before: int, max_attempts: int = MAX_ATTEMPTS) -> DataFrame | None:
    """Keys that failed, fewer than ``max_attempts`` times, and were never
    finished."""
    state = key_state(spark, state_dir, key, before)
    return None if state is None else state.where(~F.col("done") & (F.col("attempts") < max_attempts)).select(key)


def retry_failed(spark: SparkSession, source: DataFrame, convert: Converter, key: str, state_dir: str, seq: int,
                 max_attempts: int = MAX_ATTEMPTS, version: str | None = None) -> bool:
    """A retry pass as batch ``seq``: reads the failed keys' rows from the
    source once more. False if there is nothing to retry."""
    failed = failed_keys(spark, state_dir, key, seq, max_attempts)
    n = 0 if failed is None else failed.count()
    if n == 0:
        return False
    again = source.join(F.broadcast(failed) if n <= BROADCAST_KEYS else failed, key, "left_semi").select(*source.columns)
    run_batch(spark, again, convert, key, state_dir, seq, version)
    return True


def latest_status(spark: SparkSession, state_dir: str, key: str) -> DataFrame:
    """Current row per key: that of its latest batch."""
    last = key_state(spark, state_dir, key, 1 << 62).select(key, F.col("batch"))
    res = spark.read.option("basePath", f"{state_dir}/results").parquet(f"{state_dir}/results")
    return res.withColumn("batch", F.col("batch").cast("long")).join(last, [key, "batch"], "left_semi")


def table_source(spark: SparkSession, path: str) -> tuple[str, str | None]:
    """(source_dir, glob) of a table for ``stream_convert``. A stream lists
    folders and its glob holds for the files in them: a table that is a folder
    of files is the folder itself, one that is a single file is named in its
    folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return path, None
    return p.getParent().toString(), p.getName()


def stream_convert(spark: SparkSession, source_dir: str, schema: str, convert: Converter, key: str,
                   state_dir: str | None = None, glob: str | None = None, retry_pass: bool = True,
                   processing_time: str | None = None, max_files_per_trigger: int | None = None,
                   max_attempts: int = MAX_ATTEMPTS, version: str | None = None):
    """Structured Streaming form: a file stream over ``source_dir``, each
    micro-batch through ``run_batch`` (batch ``b`` has number
    ``(b + 1) * STREAM_SEQ_STEP``). By default ``trigger(availableNow=True)``
    (all that is new, then stop; then one retry pass for what failed, numbered
    after the last batch) and ``state_dir`` is returned. With
    ``processing_time`` (e.g. ``"1 minute"``) the query keeps running and the
    ``StreamingQuery`` is returned; call ``retry_failed`` from time to time.
    ``max_files_per_trigger`` bounds a micro-batch where the caller wants
    that. The stream checkpoint and the state live in ``state_dir`` (default:
    a new folder below ``spark.checkpoint.dir``)."""
    state = state_dir or work_path(spark, "incremental")
    reader = spark.readStream.schema(schema)
    files = spark.read.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader, files = reader.option("pathGlobFilter", glob), files.option("pathGlobFilter", glob)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        run_batch(batch_df.sparkSession, batch_df, convert, key, state, (int(batch_id) + 1) * STREAM_SEQ_STEP, version)

    writer = reader.parquet(source_dir).writeStream.foreachBatch(each).option("checkpointLocation", f"{state}/checkpoint")
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    writer.trigger(availableNow=True).start().awaitTermination()
    if retry_pass:
        retry_failed(spark, files.parquet(source_dir), convert, key, state, next_batch(spark, state), max_attempts, version)
    return state


def live_progress(spark: SparkSession, state_dir: str) -> DataFrame:
    """Progress while a stream runs (WIN-03, SNK-06): per finished batch its
    number, how many items it tried, and the tallies of all batches up to it.
    Reads the key tables of batches that are written, no texts; ask again for
    later figures."""
    done = _numbers(spark, f"{state_dir}/keys")
    rows = spark.read.option("basePath", f"{state_dir}/keys").schema("status STRING, batch BIGINT").parquet(
        *[f"{state_dir}/keys/batch={n}" for n in done])
    per = rows.groupBy("batch").agg(F.count("*").alias("n_items"), F.count_if(F.col("status") == "ok").alias("ok"),
                                    F.count_if(F.col("status") == "error").alias("error"))
    so_far = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)  # one row per batch
    return per.select("batch", "n_items", F.sum("ok").over(so_far).alias("n_ok"), F.sum("error").over(so_far).alias("n_error"))


def next_batch(spark: SparkSession, state_dir: str) -> int:
    """The number after the latest batch."""
    return max([0, *_numbers(spark, f"{state_dir}/keys")]) + 1


def convert_run(spark: SparkSession, inputs: DataFrame, convert: Converter, key: str,
                state_dir: str, version: str | None = None) -> DataFrame:
    """Batch form of one incremental run (JON-01, JOB-09): converts the
    inputs not finished before, and returns this run's status per input key —
    ``skipped`` for work finished earlier, else the conversion result. The
    returned rows are read back from the written batch, so later actions do
    not convert again."""
    seq = next_batch(spark, state_dir)
    run_batch(spark, inputs, convert, key, state_dir, seq, version)
    this = spark.read.parquet(f"{state_dir}/results/batch={seq}")
    before = key_state(spark, state_dir, key, seq)
    keys = inputs.where(F.col(key).isNotNull()).select(key).distinct()
    skipped = keys.join(before.where("done").select(key), key, "left_semi") if before is not None else keys.limit(0)
    return this.unionByName(skipped.withColumn("status", F.lit("skipped")), allowMissingColumns=True)
