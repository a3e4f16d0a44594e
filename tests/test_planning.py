"""Joins, statuses, reports, ordering: against brute force."""

import random

from pyspark.sql import functions as F

from corpusmill.functions import paths as P
from corpusmill.operators import ordering as O
from corpusmill.operators import planning as PL
from corpusmill.operators import report as R
from corpusmill.sources import catalogue as C


def test_anti_semi(spark):
    plan = spark.createDataFrame([(p,) for p in ["a", "b", "c", "c"]], "path STRING")
    done = spark.createDataFrame([(p,) for p in ["b", "c", "c", "z"]], "path STRING")
    assert sorted(r.path for r in PL.pending(plan, done).collect()) == ["a"]
    assert sorted(r.path for r in PL.already_done(plan, done).collect()) == ["b", "c", "c"]


def test_skip_strictly_larger(spark):
    wanted = spark.createDataFrame([(p,) for p in ["s1", "s2", "s3", "s4"]], "path STRING")
    present = spark.createDataFrame([("s1", 1_000_000), ("s2", 1_000_001), ("s3", 5), ("s3", 2_000_000)],
                                    "path STRING, length BIGINT")
    plan = {r.path: r.status for r in PL.plan_acquisition(wanted, present, min_bytes=1_000_000).collect()}
    assert plan == {"s1": "fetch", "s2": "skip", "s3": "skip", "s4": "fetch"}


def test_catalogue_plan(spark):
    nested = spark.createDataFrame(
        [("IV. Tokens: x", [("01 Sub/word: a", "https://x/1.pdf"), ("02 B", " "), ("03 C", None)])],
        "category STRING, papers ARRAY<STRUCT<title: STRING, url: STRING>>")
    rows = C.target_paths(C.flatten(nested)).orderBy("pos").collect()
    assert [r.target_path for r in rows] == ["IV. Tokens x/01. Subword a.pdf", "IV. Tokens x/02. B.pdf",
                                             "IV. Tokens x/03. C.pdf"]
    present = spark.createDataFrame([("IV. Tokens x/01. Subword a.pdf",)], "path STRING")
    wanted = C.target_paths(C.flatten(nested)).select("pos", "url", F.col("target_path").alias("path"))
    st = {r.pos: r.status for r in PL.plan_acquisition(wanted, present, url_col="url").collect()}
    assert st == {1: "skip", 2: "unavailable", 3: "unavailable"}


def test_report_and_details(spark):
    res = spark.createDataFrame([("d/a.parquet", "success"), ("d/b.parquet", "skip"), ("d/c.parquet", "fail")],
                                "path STRING, status STRING")
    t = R.tally(res).first()
    assert (t.n_total, t.n_success, t.n_skip, t.n_fail, t.n_attempted) == (3, 1, 1, 1, 2)
    d = sorted(r.detail for r in R.detail_lines(res).collect())
    assert d == ["FAIL: d/c.parquet", "SKIP: b.parquet", "SUCCESS: a.parquet"]


def test_with_position_many_partitions(spark):
    rnd = random.Random(7)
    paths = sorted({f"{rnd.choice('abc')}/{rnd.randint(0, 10**6)}.x" for _ in range(3000)})
    rnd.shuffle(paths)
    df = spark.createDataFrame([(p,) for p in paths], "path STRING").repartition(13)
    got = {r.path: r.pos for r in O.with_position(df, [P.component_order_key("path")]).collect()}
    want = {p: i + 1 for i, p in enumerate(sorted(paths, key=lambda s: s.split("/")))}
    assert got == want


def test_running_counts_many_partitions(spark):
    rnd = random.Random(3)
    rows = [(f"{i:05d}", rnd.choice(["success", "skip", "fail"])) for i in range(2000)]
    df = spark.createDataFrame(rows, "path STRING, status STRING").repartition(11)
    got = [tuple(r) for r in R.progress(df, [F.col("path")]).orderBy("pos").collect()]
    want, c = [], {"success": 0, "skip": 0, "fail": 0}
    for i, (_, s) in enumerate(rows, start=1):
        c[s] += 1
        if i % 10 == 0:
            want.append((i, c["success"], c["skip"], c["fail"]))
    assert got == want


def test_nested_target_and_collisions(spark):
    df = spark.createDataFrame([("A/x.pdf",), ("A/x.PDF",), ("y.pdf",)], "path STRING")
    t = {r.path: r.target_path for r in PL.nested_target(df).collect()}
    assert t == {"A/x.pdf": "A/Converted/x.md", "A/x.PDF": "A/Converted/x.md", "y.pdf": "Converted/y.md"}
    c = PL.target_collisions(PL.nested_target(df)).collect()
    assert [(r.target_path, r.n_sources) for r in c] == [("A/Converted/x.md", 2)]


def test_csv_matches_python_csv_module(spark, tmp_path):
    import csv
    import glob
    import io

    from corpusmill.sources import sinks as SK
    rows = [("a.jpg", 'x "quoted"', "", " lead", "trail "), ("b,c.png", "line\nbreak", "ü", "", "back\\slash")]
    headers = ["filename", "path", "level_1", "level_2", "level_3"]
    df = spark.createDataFrame(rows, ", ".join(f"{h} STRING" for h in headers)).coalesce(1)
    out = str(tmp_path / "csv")
    SK.write_csv(df, out, headers)
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{out}/part-*.csv")))
    buf = io.StringIO()
    w = csv.DictWriter(buf, fieldnames=headers, lineterminator="\n")
    w.writeheader()
    w.writerows(dict(zip(headers, r)) for r in rows)
    assert text == buf.getvalue()
    back = [tuple(r) for r in SK.read_csv(spark, out, headers).collect()]
    assert sorted(back) == sorted(rows)


def test_apply_outcomes_and_jobs(spark, tmp_path):
    from corpusmill.plans import jobs
    wanted = spark.createDataFrame([(f"d/s{i}.parquet",) for i in range(6)], "path STRING")
    present = spark.createDataFrame([("d/s0.parquet", 2_000_000)], "path STRING, length BIGINT")
    log = spark.createDataFrame([("d/s1.parquet", "success", None), ("d/s2.parquet", "fail", "timeout")],
                                "path STRING, outcome STRING, error STRING")
    plan = PL.plan_acquisition(wanted, present, min_bytes=1_000_000)
    res = {r.path: (r.status, r.error) for r in PL.apply_outcomes(plan, log).collect()}
    assert res["d/s0.parquet"] == ("skip", None)
    assert res["d/s1.parquet"] == ("success", None)
    assert res["d/s2.parquet"] == ("fail", "timeout")
    assert res["d/s3.parquet"] == ("fail", "no outcome recorded")
    written, counts = jobs.acquisition_job(spark, wanted, present, str(tmp_path / "acq"), min_bytes=1_000_000)
    assert {r.status: r["count"] for r in counts.collect()} == {"skip": 1, "fetch": 5}


def test_last_attempt_counts(spark):
    plan = spark.createDataFrame([(p, "fetch") for p in "abc"], "path STRING, status STRING")
    log = spark.createDataFrame([("a", 1, "fail", "x"), ("a", 2, "success", None), ("b", 2, "fail", "second"),
                                 ("b", 1, "fail", "first"), ("c", 1, "success", None), ("c", 2, "fail", "late")],
                                "path STRING, attempt INT, outcome STRING, error STRING")
    res = sorted(tuple(r) for r in PL.apply_outcomes(plan, log, attempt_col="attempt").collect())
    assert res == [("a", "success", None), ("b", "fail", "second"), ("c", "fail", "late")]
    unnumbered = PL.apply_outcomes(plan, log.drop("attempt")).collect()
    assert len(unnumbered) == 3 and {r.path: r.status for r in unnumbered} == {"a": "success", "b": "fail", "c": "success"}


def test_label_job_fixed(spark, tmp_path):
    from corpusmill.plans import jobs
    m = spark.createDataFrame([(p,) for p in ["A/a/1.jpg", "A/b/2.jpg", "B/a/3.txt", "top.jpg", "A/a/x/4.jpg"]],
                              "path STRING")
    out = jobs.label_job_fixed(spark, m, str(tmp_path / "fx"), ("image_name", "relative_path", "l1", "l2"))
    assert [r.image_name for r in out.rows.collect()] == ["1.jpg", "2.jpg", "3.txt"]
    s = {r.breakdown: r.n for r in out.summary.collect()}
    assert s == {"Total images": 3, "l1 = A": 2, "l1 = B": 1, "l2 = a": 2, "l2 = b": 1}


def test_label_jobs_read_the_manifest_once(spark, tmp_path):
    from pyspark.sql import functions as F

    from corpusmill.plans import jobs
    paths = [f"A/{i % 7}/{i}.jpg" for i in range(50)]
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def listed(path):
        read.add(1)
        return path

    m = spark.createDataFrame([(p,) for p in paths], "p STRING").select(listed.asNondeterministic()("p").alias("path"))
    out = jobs.label_job(spark, m, str(tmp_path / "any"), jobs.L.LabelSpec.default(2))
    assert read.value == 50 and out.rows.count() == 50
    out = jobs.label_job_fixed(spark, m, str(tmp_path / "fixed"), ("a", "b", "c", "d"))
    assert read.value == 100 and out.rows.first().d == "0"
    widths = {r.header: r.width for r in spark.read.parquet(str(tmp_path / "any" / "dataset_widths")).collect()}
    assert widths == {"filename": 12, "path": 14, "level_1": 11, "level_2": 11}
