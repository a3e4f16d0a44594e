"""Converters in a process of their own (UDF-01): a document that kills, hangs
or bloats the converter is a row, not a failed job.

``convert_with`` turns exceptions into ``error`` rows, but a converter that ends
its process, never returns or takes all memory takes the Python worker, the
task and, after the retries, the job with it. Here each task runs the converter
in a child process. Documents go to it one at a time over a pipe, so the task
knows which one is being worked on. A child that ends is replaced; one that
takes longer than ``seconds`` for a document is killed first; the child's
address space may grow by ``memory_mb`` beyond what it starts with. Each of
these ends gives an ``error`` row for that document alone, and the next document
gets a fresh child, with the converter made anew.

Every row says when its document was handed over and how long it took
(``started``, ``seconds``), so the result is also the log of the run.
"""

from __future__ import annotations

import multiprocessing
import time
from collections.abc import Callable
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from corpusmill.functions import text as T
from corpusmill.operators.convert import HELD_CHARS
from corpusmill.session import ship_package


def _limit(memory_mb: int) -> None:
    """Bound this process's memory, and end it with its parent (on Linux)."""
    import ctypes
    import resource
    import signal
    try:
        ctypes.CDLL(None).prctl(1, signal.SIGKILL)  # PR_SET_PDEATHSIG
        with open("/proc/self/statm", encoding="ascii") as f:
            now = int(f.read().split()[0]) * resource.getpagesize()
    except (OSError, AttributeError):
        now = 0
    most = now + (memory_mb << 20)
    resource.setrlimit(resource.RLIMIT_AS, (most, most))
    resource.setrlimit(resource.RLIMIT_CORE, (0, 0))


def _serve(make: Callable[[], Callable], mine, theirs, memory_mb: int) -> None:
    """The child: answers each document with (status, md, error)."""
    theirs.close()  # or the end of the parent would never show
    _limit(memory_mb)
    convert = None
    while True:
        try:
            content = mine.recv()
        except EOFError:
            return
        try:
            convert = convert or make()
            md = convert(content)
            if not isinstance(md, str):
                raise TypeError(f"converter returned {type(md).__name__}, not str")
            answer = ("ok", md, None)
        except MemoryError:
            answer = ("error", None, f"MemoryError: more than {memory_mb} MB")
        except BaseException as exc:  # noqa: BLE001 - the row records it
            answer = ("error", None, f"{type(exc).__name__}: {exc}")
        mine.send(answer)


class Child:
    """The converter's process, started when first needed."""

    def __init__(self, make: Callable[[], Callable], seconds: float, memory_mb: int):
        self.make, self.seconds, self.memory_mb = make, seconds, memory_mb
        self.process = self.pipe = None

    def _start(self) -> None:
        fork = multiprocessing.get_context("fork")  # the converter need not be picklable
        self.pipe, other = fork.Pipe()
        self.process = fork.Process(target=_serve, args=(self.make, other, self.pipe, self.memory_mb), daemon=True)
        self.process.start()
        other.close()

    def stop(self) -> int | None:
        """Ends the process; its exit code."""
        process, pipe, self.process, self.pipe = self.process, self.pipe, None, None
        if process is None:
            return None
        pipe.close()
        process.join(0.2)
        code = process.exitcode
        if code is None:
            process.kill()
            process.join()
        process.close()
        return code

    def convert(self, content) -> tuple[str, str | None, str | None]:
        if self.process is None:
            self._start()
        try:
            self.pipe.send(content)
            if not self.pipe.poll(self.seconds):
                self.stop()
                return "error", None, f"stopped after {self.seconds:g} seconds"
            return self.pipe.recv()
        except (EOFError, OSError):
            code = self.stop()
            return "error", None, f"converter ended with code {code}"


def convert_quarantined(df: DataFrame, make_converter: Callable[[], Callable], key_col: str, content_col: str,
                        seconds: float = 60.0, memory_mb: int = 1024, finish: str = "clean") -> DataFrame:
    """Like ``convert_with``, in a process of its own per task: key, status, md,
    error, started, seconds; one row per input row."""
    ship_package(df.sparkSession)
    slim = df.select(key_col, content_col)
    schema = StructType([slim.schema[key_col], StructField("status", StringType()), StructField("md", StringType()),
                         StructField("error", StringType()), StructField("started", TimestampType()), StructField("seconds", DoubleType())])

    def run(batches):
        child = Child(make_converter, seconds, memory_mb)
        try:
            for batch in batches:
                start, held, rows = 0, 0, []
                for i in range(batch.num_rows):
                    began = time.time()
                    status, md, error = child.convert(batch.column(1)[i].as_py())
                    rows.append((status, md, error, datetime.fromtimestamp(began, UTC), time.time() - began))
                    held += len(md or "")
                    if held >= HELD_CHARS or i + 1 == batch.num_rows:
                        columns = list(zip(*rows))
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).slice(start, len(rows)), *(pa.array(c, pa.string()) for c in columns[:3]),
                             pa.array(columns[3], pa.timestamp("us", "UTC")), pa.array(columns[4], pa.float64())], names=schema.names)
                        start, held, rows = i + 1, 0, []
        finally:
            child.stop()

    out = slim.mapInArrow(run, schema)
    finished = T.clean_markdown("md") if finish == "clean" else T.strip_only("md")
    return out.withColumn("md", F.when(F.col("status") == "ok", finished))
