"""Attempts spaced in time (STM-01): failed documents are tried again after
2, 4, 8, ... units, up to a limit.

The attempt log (key, attempt, status, at) is the stream's source and sink:

    attempts/batch=<n>/   one row per attempt of that batch (0: the first run)
    results/batch=<n>/    what the converter returned in that batch
    due/batch=<n>/        keys whose time had come in that batch

A stateful operator keyed by document holds the failed ones only: how often
each was tried, and a timer. When the timer fires the key is due; its row is
read from the source again, converted and logged, and the log tells the state
how it went. A document that succeeds or reaches the limit leaves the state.

After a restart the checkpoint gives back state and timers; a batch that is
run again writes its folders anew, and an attempt that is already counted
changes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from corpusmill.session import ship_package
from corpusmill.streaming.incremental import BROADCAST_KEYS

MAX_ATTEMPTS = 4


def log_attempts(results: DataFrame, key: str, attempt, state_dir: str, batch: int) -> None:
    """Writes a batch's results, then its attempts. ``attempt`` is a column
    of ``results`` or a number."""
    number = F.col(attempt) if isinstance(attempt, str) else F.lit(attempt)
    results.write.mode("overwrite").parquet(f"{state_dir}/results/batch={batch}")
    done = results.sparkSession.read.parquet(f"{state_dir}/results/batch={batch}")
    done.select(key, number.cast("int").alias("attempt"), "status", F.current_timestamp().alias("at")) \
        .write.mode("overwrite").parquet(f"{state_dir}/attempts/batch={batch}")


def _timer(unit_ms: int, max_attempts: int, key_name: str):
    """State per failed key: the attempts that failed. Returns the key with
    the number of its next attempt when its time has come."""
    import pandas as pd

    def step(key, frames, state):
        if state.hasTimedOut:
            (tried,) = state.get
            state.update((tried,))  # no timer: waits for the log
            yield pd.DataFrame({key_name: [key[0]], "attempt": [tried + 1]})
            return
        tried = state.get[0] if state.exists else 0
        ok, seen = False, tried
        for frame in frames:
            ok = ok or bool((frame["status"] == "ok").any())
            seen = max(seen, int(frame["attempt"].max()))
        if ok or seen >= max_attempts:
            if state.exists:
                state.remove()
        elif seen > tried:
            state.update((seen,))
            state.setTimeoutDuration(unit_ms * 2 ** seen)
        # an attempt that is counted already leaves the state as it is; its timer has to be set again
        elif state.exists:
            state.setTimeoutDuration(unit_ms * 2 ** seen)
    return step


def start_retries(spark: SparkSession, source: Callable[[], DataFrame], convert: Callable[[DataFrame], DataFrame],
                  key: str, state_dir: str, unit_seconds: float, max_attempts: int = MAX_ATTEMPTS,
                  poll: str = "10 seconds") -> StreamingQuery:
    """Starts the stream over the attempt log of ``state_dir``.

    ``source()`` gives the documents as they are at that time; a due key that
    is no longer among them counts as a failed attempt. Null keys take no
    part. The wait after attempt ``n`` is ``unit_seconds * 2**n``, rounded up
    to the next poll."""
    ship_package(spark)
    key_field = spark.read.parquet(f"{state_dir}/attempts").schema[key]
    log = spark.readStream.schema(StructType([key_field, StructField("attempt", IntegerType())]).add("status", "string")) \
        .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{state_dir}/attempts")
    due = log.where(F.col(key).isNotNull()).groupBy(key).applyInPandasWithState(
        _timer(int(unit_seconds * 1000), max_attempts, key),
        StructType([key_field, StructField("attempt", IntegerType())]),
        StructType([StructField("tried", IntegerType())]), "append", "ProcessingTimeTimeout")

    def each(rows: DataFrame, batch: int) -> None:
        session, number = rows.sparkSession, batch + 1
        rows.write.mode("overwrite").parquet(f"{state_dir}/due/batch={number}")  # the state is stepped once
        found = session.read.parquet(f"{state_dir}/due/batch={number}")
        n = found.count()
        if n == 0:
            return
        hint = F.broadcast(found) if n <= BROADCAST_KEYS else found
        done = convert(source().join(hint.select(key), key, "left_semi"))
        tried = done.join(found, key, "right").withColumn("status", F.coalesce("status", F.lit("error")))
        log_attempts(tried, key, "attempt", state_dir, number)

    return due.writeStream.foreachBatch(each).option("checkpointLocation", f"{state_dir}/checkpoint") \
        .trigger(processingTime=poll).start()


def settled(query: StreamingQuery) -> bool:
    """Whether no document waits for an attempt: the state is empty and the
    last batch read nothing new."""
    last = query.lastProgress
    if last is None or not last["stateOperators"]:
        return False
    return last["batchId"] > 0 and last["numInputRows"] == 0 and last["stateOperators"][0]["numRowsTotal"] == 0


def run_until_settled(query: StreamingQuery, seconds: float) -> bool:
    """Waits until all documents succeeded or were given up, at most
    ``seconds``, and stops the stream. Its state lasts; a later start goes on."""
    end = time.monotonic() + seconds
    try:
        while time.monotonic() < end:
            if query.exception() is not None:
                raise RuntimeError(str(query.exception()))
            if settled(query):
                return True
            time.sleep(0.2)
        return False
    finally:
        query.stop()


def outcome(spark: SparkSession, state_dir: str, key: str) -> DataFrame:
    """Per key: its last status and the number of attempts."""
    log = spark.read.parquet(f"{state_dir}/attempts")
    return log.groupBy(key).agg(F.max_by("status", "attempt").alias("status"), F.max("attempt").alias("attempts"))
