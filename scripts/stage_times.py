"""Per-job and per-stage durations of registered queries, from Spark's event
log written to a fresh scratch folder (no UI, no server).

    python scripts/stage_times.py [sf_dir] name [name ...]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir: str):
    import zstandard
    for path in sorted(glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/app*")):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode().splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    from pyspark.sql import SparkSession

    from corpusmill.plans.queries import QUERIES
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for name in args:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - t0:.2f}s wall")
    spark.stop()
    stages, jobs = {}, {}
    for e in _events(log_dir):
        kind = e.get("Event")
        if kind == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:48], si["Number of Tasks"],
                                      si["Completion Time"] - si["Submission Time"])
        elif kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, e["Stage IDs"]]
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
    for jid, (start, end, sids) in sorted(jobs.items()):
        print(f"job {jid}: {end - start if end else '?'} ms")
        for sid in sids:
            if sid in stages:
                n, tasks, ms = stages[sid]
                print(f"   stage {sid}: {ms} ms, {tasks} tasks, {n}")
    print("event log:", log_dir)


if __name__ == "__main__":
    main()
