"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no rows are
brought to the driver), once to warm up and then ``$BENCH_REPEAT`` times;
the median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusmill.plans.fixtures import fixture_tree  # noqa: E402
from corpusmill.plans.queries import QUERIES  # noqa: E402
from corpusmill.session import build_session  # noqa: E402
from corpusmill.sources import content as CT  # noqa: E402
from corpusmill.sources import manifest as M  # noqa: E402

HEADLINE = [
    "label_summary", "rows_images", "sample_tree", "order_tree", "column_widths",
    "acquisition_plan", "skip_by_size", "run_report", "progress_every_10",
    "clean_markdown", "references_section", "citations_rules", "citations_from_json",
    "convert_documents", "incremental_run", "conversion_report", "label_dataset", "csv_round_trip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    times: dict[str, float] = {}
    tree = {}

    def listing(spark, _sf):
        # the folder tree is written once (setup, not timed); the listing is timed
        if "root" not in tree:
            tree["root"] = fixture_tree(spark, sf_dir)
        return M.list_files(spark, tree["root"])

    def contents(spark, sf):
        return CT.with_content(listing(spark, sf), tree["root"]).drop("content")

    extra = {"list_files_tree": listing, "read_file_contents": contents}
    if not only:
        listing(spark, sf_dir)
    for name in only or HEADLINE + list(extra):
        fn = extra.get(name) or QUERIES[name]
        runs = []
        for i in range(repeat + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
