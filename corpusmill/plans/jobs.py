"""User-level jobs: the end-to-end workflows, composed from the operators.

Each job reads a manifest or a document table, writes its outputs to a
folder (parquet/CSV part files, never one file per row) and returns the
DataFrames it wrote. Empty input writes nothing (FLT-09).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusmill.fixed import SPEC_FILE
from corpusmill.functions import paths as P
from corpusmill.functions import text as T
from corpusmill.operators import citations as CI
from corpusmill.operators import convert as CV
from corpusmill.operators import labels as L
from corpusmill.operators import planning as PL
from corpusmill.operators import report as R
from corpusmill.session import work_path
from corpusmill.sources import sinks as SK
from corpusmill.streaming import incremental as INC


@dataclass
class LabelOutputs:
    spec: L.LabelSpec
    rows: DataFrame | None = None
    summary: DataFrame | None = None


PATH = "__tree_path"  # column of the labelled table that the rows are ordered by


def _label_outputs(spark: SparkSession, labelled: DataFrame, out: str, spec: L.LabelSpec, headers: list[str],
                   order: Column, summarise) -> LabelOutputs:
    """Writes the labelled rows (with their path) once, unordered, to a work
    table; row count and column widths come out of that write as observed
    metrics. The manifest, which may be a listing of the whole tree, is read
    by this write alone: rows in order and summary are read from the table.
    No rows: no output is written (FLT-09)."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("n"), *L.width_metrics(headers)]
    work = work_path(spark, "labelled")
    SK.write_table(labelled.observe(seen, *metrics), work)
    got = seen.get
    if not got.get("n"):
        return LabelOutputs(spec)
    table = spark.read.parquet(work)
    rows = table.orderBy(order).select(*headers)
    SK.write_csv(rows, f"{out}_rows")
    # counted once; the CSV is written from the table
    SK.write_table(summarise(table), f"{out}_summary.parquet")
    summary = spark.read.parquet(f"{out}_summary.parquet")
    SK.write_csv(summary.orderBy("pos", "value").select("breakdown", "n"), f"{out}_summary")
    names = [f"__w{i}" for i in range(len(headers))]
    widths = spark.createDataFrame([tuple(got[c] for c in names)], ", ".join(f"{c} INT" for c in names))
    SK.write_table(L.shown_widths(widths, headers), f"{out}_widths")
    return LabelOutputs(spec, rows, summary.orderBy("pos", "value"))


def label_job(spark: SparkSession, manifest: DataFrame, out_dir: str,
              spec: L.LabelSpec | None = None) -> LabelOutputs:
    """Any-depth labelling (JOB-01/02). Without a spec: discover one, write
    it as ``dataset_config.json`` for the user to edit plus the per-folder
    sample as the table ``sample_tree``, stop. With a spec (or the edited
    file): scan the manifest once and write ``<stem>_rows`` (CSV, tree order),
    ``<stem>_summary`` (CSV and parquet) and ``<stem>_widths`` (display width
    per column). Without an image nothing is written."""
    out_dir = out_dir.rstrip("/")
    if spec is None:
        text = SK.read_text_file(spark, f"{out_dir}/{SPEC_FILE}")
        if text is None:
            spec, sample = L.discover_structure(manifest)
            if spec.max_depth == 0:
                return LabelOutputs(spec)  # no images in any subfolder
            SK.write_text_file(spark, f"{out_dir}/{SPEC_FILE}", spec.to_json())
            SK.write_table(sample, f"{out_dir}/sample_tree")
            return LabelOutputs(spec)
        spec = L.LabelSpec.from_json(text)
    return _label_outputs(
        spark, L.label_rows(manifest, spec, order=False, path_as=PATH), f"{out_dir}/{spec.output_stem}", spec,
        spec.active_headers(), P.tree_order_key(F.col(PATH)),
        lambda table: L.label_summary(table, spec.label_headers(), L.SEP_SPEC, none_placeholder=True))


def label_job_fixed(spark: SparkSession, manifest: DataFrame, out_dir: str,
                    headers=L.FIXED_HEADERS, output_stem: str = L.DEFAULT_OUTPUT_STEM) -> LabelOutputs:
    """Fixed-depth labelling (JOB-03): the outputs of ``label_job``."""
    headers = list(headers)
    spec = L.LabelSpec(len(headers) - 2, {}, output_stem)
    return _label_outputs(
        spark, L.label_rows_fixed(manifest, headers, order=False, path_as=PATH), f"{out_dir.rstrip('/')}/{output_stem}",
        spec, headers, P.component_order_key(F.col(PATH)),
        lambda table: L.label_summary(table, headers[2:], L.SEP_FIXED, none_placeholder=False))


def acquisition_job(spark: SparkSession, wanted: DataFrame, present: DataFrame, out_dir: str,
                    min_bytes: int | None = None, url_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Dry run of a fetch (JOB-04): the plan table and its tally."""
    plan = PL.plan_acquisition(wanted, present, min_bytes=min_bytes, url_col=url_col)
    if wanted.isEmpty():
        return plan, plan.groupBy("status").count()
    SK.write_table(plan, f"{out_dir.rstrip('/')}/plan")
    written = spark.read.parquet(f"{out_dir.rstrip('/')}/plan")
    counts = written.groupBy("status").count()
    return written, counts


def convert_job(spark: SparkSession, docs: DataFrame, key: str, state_dir: str,
                html_col: str = "html", with_citations: bool = False,
                target: str | None = None) -> dict[str, DataFrame]:
    """Incremental document conversion (JOB-05/06/07/09): convert what is not
    finished, report this run, list failures; optionally references and
    rule-based citations of the converted documents. When ``key`` is a
    source path, ``target='nested'`` (``Converted/`` next to the source) or
    ``'mirrored'`` (same folders under the sibling root) adds the Markdown
    file's ``target_path`` to the run table (SNK-03: the path is data, the
    Markdown stays in the table)."""
    def convert(df: DataFrame) -> DataFrame:
        return CV.convert_html(df.select(key, html_col), html_col, [key])

    inputs = docs.select(key, html_col)
    run = convert(inputs) if inputs.isEmpty() else INC.convert_run(spark, inputs, convert, key, state_dir)
    if with_citations:
        # citations per converted document, from its own Markdown (no join)
        n = F.size(CI.citation_array(T.references_section(F.col("md"))))
        run = run.withColumn("citations", F.when(F.col("status") == "ok", n.cast("int")))
    if target == "nested":
        run = PL.nested_target(run, key)
    elif target == "mirrored":
        run = PL.mirrored_target(run, key)
    elif target is not None:
        raise ValueError("target must be 'nested', 'mirrored' or None")
    out = {"run": run,
           "report": R.tally(run, R.CONVERT_STATUSES, ok="ok", fail="error"),
           "failures": R.failures(run).select(key, "error")}
    if with_citations:
        ok = run.where("status = 'ok'")
        refs = CI.references(ok, "md", clean=False).select(key, "references")
        out["citations"] = CI.extract_citations(refs, "references", [key])
    return out
