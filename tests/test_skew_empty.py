"""A hot group (a third of all rows in one folder / one value) and empty
inputs: results stay whole and exact."""

import collections

from pyspark.sql import functions as F

from corpusmill.operators import labels as L
from corpusmill.operators import planning as PL
from corpusmill.operators import report as R


def _skewed_manifest(spark, n=3000):
    paths = [f"hot/x/img_{i:05d}.png" for i in range(n // 3)]
    paths += [f"f{i % 97}/y{i % 5}/img_{i:05d}.jpg" for i in range(n - n // 3)]
    return spark.createDataFrame([(p,) for p in paths], "path STRING").repartition(16), paths


def test_hot_folder_summary_and_sample(spark):
    m, paths = _skewed_manifest(spark)
    spec = L.LabelSpec.default(2)
    rows = L.label_rows(m, spec, order=False)
    summary = {r.breakdown: r.n for r in L.label_summary(rows, spec.label_headers()).collect()}
    level1 = collections.Counter(p.split("/")[0] for p in paths)
    assert summary["Total images"] == len(paths)
    assert summary["level_1  =  hot"] == level1["hot"] == len(paths) // 3
    assert sum(v for k, v in summary.items() if k.startswith("level_1")) == len(paths)
    sample = {r.folder: r.images for r in L.sample_tree(m).collect()}
    assert sample["hot/x"] == sorted(p.split("/")[-1] for p in paths if p.startswith("hot/"))[:3]


def test_hot_key_in_present_listing_does_not_multiply(spark):
    wanted = spark.createDataFrame([(f"s{i}",) for i in range(50)], "path STRING")
    present = spark.createDataFrame([("s1", 2_000_000)] * 5000 + [("s2", 10)], "path STRING, length BIGINT")
    plan = PL.plan_acquisition(wanted, present, min_bytes=1_000_000)
    assert plan.count() == 50
    assert {r.path for r in plan.where("status = 'skip'").collect()} == {"s1"}


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "path STRING")
    rows = L.label_rows(empty, L.LabelSpec.default(2), order=False)
    assert rows.isEmpty()
    assert L.label_summary(rows, ["level_1", "level_2"]).isEmpty()   # nothing to write
    assert L.label_summary(rows, []).isEmpty()
    assert L.max_depth(empty).first()["max_depth"] == 0
    t = R.tally(empty.withColumn("status", F.lit("x"))).first()
    assert t.n_total == 0 and t.n_attempted == 0


def test_deep_trees_work(spark):
    deep = "/".join(f"d{i}" for i in range(70)) + "/x.png"
    m2 = spark.createDataFrame([(deep,), ("y.png",)], "path STRING")
    spec2 = L.LabelSpec.default(70)
    s = {r.breakdown: r.n for r in L.label_summary(L.label_rows(m2, spec2, order=False), spec2.label_headers()).collect()}
    assert s["Total images"] == 2 and s["level_70  =  d69"] == 1 and s["level_70  =  (none)"] == 1
