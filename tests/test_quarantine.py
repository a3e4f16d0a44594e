"""UDF-01: converters that end, hang or take all memory."""

import os
import time

from corpusmill.operators.quarantine import convert_quarantined

ROWS = [(1, "fine"), (2, "exit"), (3, "signal"), (4, "sleep"), (5, "hog"), (6, "raise"), (7, "number"), (8, None), (9, ""), (10, "SystemExit"),
        (11, "fine too"), (None, "no key"), (11, "fine too")]


def fragile():
    def make():
        made = []

        def convert(text):
            made.append(text)
            if text is None:
                return "nothing"
            if text == "exit":
                os._exit(7)
            if text == "signal":
                os.kill(os.getpid(), 9)
            if text == "sleep":
                time.sleep(100)
            if text == "hog":
                return bytearray(1 << 34).decode()
            if text == "raise":
                raise ValueError("no good")
            if text == "SystemExit":
                raise SystemExit(4)
            return 5 if text == "number" else f"{text} {len(made)}"
        return convert
    return make  # local: workers cannot import this module


def test_every_end_is_a_row(spark):
    df = spark.createDataFrame([(*r, "extra") for r in ROWS], "k LONG, t STRING, status STRING").coalesce(1)
    got = convert_quarantined(df, fragile(), "k", "t", seconds=1.5, memory_mb=256)
    assert got.columns == ["k", "status", "md", "error", "started", "seconds"]
    rows = got.collect()
    assert [r.k for r in rows] == [k for k, _ in ROWS]
    by = {r.k: r for r in rows}
    # the converter is made anew after each document that ended its process, and only then
    assert (by[1].md, by[8].md, by[11].md) == ("fine 1\n", "nothing\n", "fine too 9\n") and all(by[k].status == "ok" for k in (1, 8, 9, 11, None))
    errors = {k: by[k].error for k in (2, 3, 4, 5, 6, 7, 10)}
    assert errors == {2: "converter ended with code 7", 3: "converter ended with code -9", 4: "stopped after 1.5 seconds",
                      5: "MemoryError: more than 256 MB", 6: "ValueError: no good", 7: "TypeError: converter returned int, not str",
                      10: "SystemExit: 4"}
    assert all(by[k].status == "error" and by[k].md is None for k in errors)
    assert 1.4 < by[4].seconds < 10 and by[1].started is not None


def test_no_rows(spark):
    df = spark.createDataFrame([], "k STRING, t STRING")
    assert convert_quarantined(df, fragile(), "k", "t").count() == 0


def test_no_child_outlives_its_task(spark):
    df = spark.range(8).selectExpr("id", "'fine' as t").repartition(4)

    def leaves_its_number():
        return lambda text: str(os.getpid())

    children = {int(r.md) for r in convert_quarantined(df, leaves_its_number, "id", "t").collect()}
    time.sleep(0.5)
    assert children and not any(os.path.exists(f"/proc/{pid}") for pid in children)
