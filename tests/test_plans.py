"""Physical plans: the shapes the operators are built to produce."""

from corpusmill.plans.queries import QUERIES

from conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "PythonUDF", "FlatMapGroupsInPandas")
NATIVE = ["rows_images", "label_summary", "sample_tree", "clean_markdown", "references_section",
          "citations_rules", "citations_from_json", "convert_documents", "acquisition_plan",
          "skip_by_size", "catalogue_rows", "status_details"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_native_jobs_stay_in_the_jvm(spark):
    for name in NATIVE:
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert not any(n in p for n in PYTHON_NODES), name


def test_summary_is_one_grouping_pass(spark):
    p = plan(QUERIES["label_summary"](spark, SF_SMALL))
    assert p.count("Generate explode") == 1
    assert p.count("HashAggregate") == 2  # partial before the exchange, final after


def test_summary_reads_unordered_rows(spark):
    for name in ("label_dataset", "label_dataset_fixed"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "rangepartitioning" not in p[p.index("Generate explode"):], name


def test_no_window_and_no_text_in_the_catalogue(spark):
    for name in ("catalogue_rows", "acquisition_plan"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "Window" not in p and "text:string" not in p, name


def test_no_query_spreads_rows_by_number(spark):
    for name in ("clean_markdown", "citations_rules", "citations_from_json", "convert_documents", "failures"):
        assert "REPARTITION_BY_NUM" not in plan(QUERIES[name](spark, SF_SMALL)), name


def test_sample_tree_limits_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(QUERIES["sample_tree"](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in p
    assert p.index("Exchange") < p.rindex("WindowGroupLimit")  # a partial limit sits below the exchange


def test_scan_prunes_columns(spark):
    p = plan(QUERIES["rows_images"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in p  # no text, no size


def _upper():
    return lambda text: text.upper()


def test_skip_join_sits_below_python_converter(spark):
    from corpusmill.operators import convert as CV
    from corpusmill.operators import planning as PL
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    done = pages.select("page_id").where("page_id % 2 = 0")
    p = plan(CV.convert_with(PL.pending(pages, done, "page_id"), _upper, "page_id", "html"))
    assert p.index("MapInArrow") < p.index("LeftAnti")  # the join runs first, inside the converter's input
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p


def test_first_and_last_overlap(spark):
    from pyspark.sql import functions as F
    from corpusmill.operators import ordering as O
    df = spark.createDataFrame([(p,) for p in ["a", "b", "c", "d"]], "path STRING")
    rows = O.first_and_last(df, [F.col("path")], 3, desc_by=[F.col("path").desc()]).collect()
    assert sorted((r.part, r.path) for r in rows) == [("first", "a"), ("first", "b"), ("first", "c"),
                                                        ("last", "b"), ("last", "c"), ("last", "d")]


def test_selection_predicates_reach_the_parquet_scan(spark, tmp_path):
    from corpusmill.sources import select as S
    path = str(tmp_path / "manifest")
    spark.createDataFrame([("data/python/a.parquet", 10), ("docs/README.md", 5)],
                          "path STRING, length BIGINT").write.parquet(path)
    m = spark.read.parquet(path)
    p = plan(S.shards_by_prefix(m, "data/python").select("path"))
    assert "PushedFilters: [IsNotNull(path), StringStartsWith(path,data/python/), StringEndsWith(path,.parquet)]" in p
    assert "ReadSchema: struct<path:string>" in p


def test_no_query_plans_a_cross_join(spark):
    # the streaming and writing queries run jobs while being built; their
    # plans are covered by the unit tests of the same operators
    skip = {"incremental_run", "incremental_replay", "conversion_report", "conversion_rows", "csv_round_trip", "spec_json",
            "file_manifest", "file_contents", "citation_files", "report_tables", "label_job_widths", "label_job_rows", "empty_runs",
            "timed_retries", "flat_folder", "live_progress"}
    for name, fn in QUERIES.items():
        if name in skip:
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name
