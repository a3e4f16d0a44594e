"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the given tables
or views Spark derives from them (``plans.fixtures``). Computed columns carry
the same names as in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.fixed import REFERENCE_TEXT_LIMIT
from corpusmill.functions import paths as P
from corpusmill.functions import text as T
from corpusmill.operators import citations as CI
from corpusmill.operators import convert as CV
from corpusmill.operators import labels as L
from corpusmill.operators import ordering as O
from corpusmill.operators import planning as PL
from corpusmill.operators import quarantine as Q
from corpusmill.operators import report as R
from corpusmill.plans import jobs as JOBS
from corpusmill.plans.fixtures import catalogue_nested, fixture, fixture_tree, table
from corpusmill.session import work_path
from corpusmill.sources import catalogue as C
from corpusmill.sources import content as CT
from corpusmill.sources import csv_split as CS
from corpusmill.sources import manifest as M
from corpusmill.sources import select as S
from corpusmill.sources import sinks as SK
from corpusmill.sources.stored import KeyStore
from corpusmill.streaming import incremental as INC
from corpusmill.streaming import retries as RT

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Spec used by the label queries: some slots renamed, some disabled.
EDITED_SPEC = L.LabelSpec(3, {
    "filename": {"header": "image", "enabled": True},
    "path": {"header": "path", "enabled": False},
    "level_1": {"header": "source", "enabled": True},
    "level_2": {"header": "lang", "enabled": False},
    "level_3": {"header": "detail", "enabled": True},
})
FIXED_DEPTH2 = ("image_name", "relative_path", "license_type", "crop_type")


# ---------------------------------------------------------------- labels --

@query
def rows_images(spark, sf_dir):
    """SRC-03, PRJ-01, PRJ-03, FLT-01, FLT-02."""
    return L.label_rows(fixture(spark, sf_dir, "fx_manifest"), L.LabelSpec.default(3), order=False)


@query
def rows_exact_depth(spark, sf_dir):
    """SRC-02, PRJ-02."""
    return L.label_rows_fixed(fixture(spark, sf_dir, "fx_manifest"), FIXED_DEPTH2, order=False)


@query
def label_columns(spark, sf_dir):
    """PRJ-04, PRJ-05: renamed and disabled slots."""
    return L.label_rows(fixture(spark, sf_dir, "fx_manifest"), EDITED_SPEC, order=False)


@query
def label_summary(spark, sf_dir):
    """AGG-01, AGG-02, SET-01, SRT-04, PRJ-11, STR-14, SNK-02."""
    rows = L.label_rows(fixture(spark, sf_dir, "fx_manifest"), L.LabelSpec.default(3), order=False)
    return L.label_summary(rows, ["level_1", "level_2", "level_3"])


@query
def label_summary_spec(spark, sf_dir):
    """PRJ-06: the summary groups by enabled, renamed level headers only."""
    rows = L.label_rows(fixture(spark, sf_dir, "fx_manifest"), EDITED_SPEC, order=False)
    return L.label_summary(rows, EDITED_SPEC.label_headers())


@query
def max_depth(spark, sf_dir):
    """AGG-04."""
    return L.max_depth(fixture(spark, sf_dir, "fx_manifest"))


@query
def sample_tree(spark, sf_dir):
    """WIN-02: first three images of every folder."""
    s = L.sample_tree(fixture(spark, sf_dir, "fx_manifest"))
    return s.select("folder", F.col("depth").cast("int").alias("depth"),
                    F.size("images").cast("int").alias("n_images"),
                    F.array_join("images", ", ").alias("images"))


@query
def column_widths(spark, sf_dir):
    """AGG-06: widths over all rows."""
    spec = L.LabelSpec.default(3)
    rows = L.label_rows(fixture(spark, sf_dir, "fx_manifest"), spec, order=False)
    return L.column_widths(rows, spec.active_headers())


@query
def discover_structure(spark, sf_dir):
    """JOB-01, SNK-05: the default spec as rows (slot, header, enabled, pos)."""
    spec, _ = L.discover_structure(fixture(spark, sf_dir, "fx_manifest"))
    # one row per column of the spec; the table's depth decides how many
    return spark.createDataFrame([(i, s.name, s.header, s.enabled) for i, s in enumerate(spec.slots())],
                                 "pos int, slot string, header string, enabled boolean")


@query
def download_report(spark, sf_dir):
    """AGG-03: the four-way tally of a catalogue run (downloaded, skipped,
    unavailable, failed) and how many were attempted. The log has the entry of
    every document whose label is toxic as a failure."""
    wanted = C.target_paths(C.flatten(catalogue_nested(spark, sf_dir))).select("url", F.col("target_path").alias("path"))
    plan = PL.plan_acquisition(wanted, _catalogue_present(spark, sf_dir), url_col="url")
    doc = F.regexp_extract("url", r"/([0-9]+)(?:-2)?\.pdf$", 1)
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.lit(True).alias("toxic"))
    log = wanted.where(doc != "").withColumn("doc_id", doc.cast("bigint")).join(toxic, "doc_id", "left").select(
        "path", F.when(F.col("toxic"), "fail").otherwise("success").alias("outcome"))
    return R.tally(PL.apply_outcomes(plan, log, error_col=None), R.DOWNLOAD_STATUSES)


@query
def label_dataset(spark, sf_dir):
    """JOB-02: discover the spec, label, summarise (the summary is returned)."""
    manifest = fixture(spark, sf_dir, "fx_manifest")
    spec, _ = L.discover_structure(manifest)
    _, summary = L.label_dataset(manifest, spec)
    return summary


@query
def label_dataset_fixed(spark, sf_dir):
    """JOB-03: fixed headers, raw values, 'h = v' text."""
    _, summary = L.label_dataset_fixed(fixture(spark, sf_dir, "fx_manifest"), FIXED_DEPTH2)
    return summary


@query
def order_tree(spark, sf_dir):
    """SRT-01: pre-order of the folder walk, as positions."""
    rows = L.label_rows(fixture(spark, sf_dir, "fx_manifest"), L.LabelSpec.default(3), order=False)
    return O.with_position(rows.select("path"), [P.tree_order_key(F.col("path"))])


@query
def order_parts(spark, sf_dir):
    """SRT-02, SRT-03: order by path components, as positions."""
    m = fixture(spark, sf_dir, "fx_manifest").select("path")
    return O.with_position(m, [P.component_order_key(F.col("path"))])


# ----------------------------------------------------------- scans/plans --


@query
def file_manifest(spark, sf_dir):
    """SRC-01, FLT-03: list the folder tree of a partitioned table; one row per
    folder with its depth and whether every file in it has bytes (file names
    are the writer's own)."""
    files = M.list_files(spark, fixture_tree(spark, sf_dir)).where(F.col("path").endswith(".parquet"))
    return files.groupBy(P.folder_path(F.col("path")).alias("folder")).agg(
        F.max(P.depth(F.col("path"))).cast("int").alias("depth"), (F.min("length") > 0).alias("has_bytes"))


@query
def file_contents(spark, sf_dir):
    """SRC-10: the bytes of every listed file, read by the tasks that hold
    the manifest rows: whole (as long as listed) and of the expected format."""
    root = fixture_tree(spark, sf_dir)
    files = M.list_files(spark, root).where(F.col("path").endswith(".parquet"))
    whole = (F.octet_length("content") == F.col("length")) \
        & (F.hex(F.substring("content", -4, 4)) == F.hex(F.lit("PAR1"))) & F.col("read_error").isNull()
    return CT.with_content(files, root).groupBy(P.folder_path(F.col("path")).alias("folder")).agg(
        F.every(whole).alias("whole"))


@query
def scan_pdf_strict(spark, sf_dir):
    """SRC-04."""
    return S.pdf_files_strict(fixture(spark, sf_dir, "fx_manifest")).select("path")


@query
def scan_pdf_pruned(spark, sf_dir):
    """SRC-05, FLT-04."""
    return S.pdf_files_pruned(fixture(spark, sf_dir, "fx_manifest")).select("path")


@query
def shards_by_prefix(spark, sf_dir):
    """SRC-06."""
    return S.shards_by_prefix(fixture(spark, sf_dir, "fx_shards"), "data/python").select("path")


@query
def shards_by_suffix(spark, sf_dir):
    """SRC-07, FLT-05."""
    return S.shards_by_suffix(fixture(spark, sf_dir, "fx_shards")).select("path")


@query
def catalogue_rows(spark, sf_dir):
    """SRC-08, PRJ-07, STR-09..11, WIN-01: the nested catalogue as rows; an
    entry's number is its list position."""
    return C.target_paths(C.flatten(catalogue_nested(spark, sf_dir))).select(
        "category", "pos", "url", "filename", "target_path")


def _catalogue_present(spark, sf_dir):
    # downloaded by an earlier run: the entries whose document was labelled
    # good (the URL carries the document id)
    rows = C.target_paths(C.flatten(catalogue_nested(spark, sf_dir)))
    doc = F.regexp_extract("url", r"/([0-9]+)\.pdf$", 1)
    labels = table(spark, sf_dir, "labels").where("quality = 1")
    hit = rows.withColumn("doc_id", F.when(doc != "", doc.cast("bigint"))) \
              .join(labels.select("doc_id"), "doc_id", "left_semi")
    return hit.select(F.col("target_path").alias("path"))


@query
def acquisition_plan(spark, sf_dir):
    """JOB-04, FLT-06: unavailable / skip / fetch per catalogue entry."""
    wanted = C.target_paths(C.flatten(catalogue_nested(spark, sf_dir))).select(
        "category", "pos", "url", F.col("target_path").alias("path"))
    plan = PL.plan_acquisition(wanted, _catalogue_present(spark, sf_dir), url_col="url")
    return plan.select("category", "pos", "path", "status")


@query
def skip_by_size(spark, sf_dir):
    """JON-02, FLT-07: present and strictly larger than 1,000,000 bytes."""
    wanted = S.shards_by_prefix(fixture(spark, sf_dir, "fx_shards"), "data/python").select("path")
    plan = PL.plan_acquisition(wanted, fixture(spark, sf_dir, "fx_present"), min_bytes=PL.SHARD_MIN_BYTES)
    return plan


@query
def pending_anti(spark, sf_dir):
    """JON-01: not yet done."""
    return PL.pending(fixture(spark, sf_dir, "fx_manifest").select("path"), fixture(spark, sf_dir, "fx_outputs"))


@query
def done_semi(spark, sf_dir):
    """JON-04: already done."""
    return PL.already_done(fixture(spark, sf_dir, "fx_manifest").select("path"), fixture(spark, sf_dir, "fx_outputs"))


@query
def target_mirrored(spark, sf_dir):
    """PRJ-08, STR-12: mirrored tree, suffix → .md."""
    return PL.mirrored_target(S.pdf_files_strict(fixture(spark, sf_dir, "fx_manifest")).select("path"))


@query
def target_nested(spark, sf_dir):
    """PRJ-09: Converted/ next to the source."""
    return PL.nested_target(S.pdf_files_pruned(fixture(spark, sf_dir, "fx_manifest")).select("path"))


@query
def target_collisions(spark, sf_dir):
    """Two sources, one target (edge rule d), on the case-insensitive scan:
    every third PDF is there under a lower-case suffix as well."""
    pdfs = S.pdf_files_pruned(fixture(spark, sf_dir, "fx_manifest"))
    twins = pdfs.where("doc_id % 3 = 2").select(F.concat(F.substring_index("path", ".", 1), F.lit(".pdf")).alias("path"))
    t = PL.nested_target(pdfs.select("path").unionByName(twins))
    return PL.target_collisions(t).select("target_path", F.col("n_sources").cast("bigint").alias("n_sources"),
                                          "first_source", "last_source")


def _shard_run(spark, sf_dir):
    wanted = S.shards_by_prefix(fixture(spark, sf_dir, "fx_shards"), "data/python").select("path")
    plan = PL.plan_acquisition(wanted, fixture(spark, sf_dir, "fx_present"), min_bytes=PL.SHARD_MIN_BYTES)
    return PL.apply_outcomes(plan, fixture(spark, sf_dir, "fx_fetch_log"), attempt_col="attempt")


@query
def run_report(spark, sf_dir):
    """JON-03, AGG-03, AGG-07, SNK-06: tally of a fetch run."""
    return R.tally(_shard_run(spark, sf_dir))


@query
def status_details(spark, sf_dir):
    """PRJ-10, STR-13, STR-15: one detail line per item."""
    return R.detail_lines(_shard_run(spark, sf_dir))


@query
def progress_every_10(spark, sf_dir):
    """WIN-03: running counts after every 10th item, in path order."""
    return R.progress(_shard_run(spark, sf_dir), [P.component_order_key(F.col("path"))])


@query
def shard_preview(spark, sf_dir):
    """SRT-05: first three and last three shards."""
    s = S.shards_by_prefix(fixture(spark, sf_dir, "fx_shards"), "data/python").select("path")
    key = P.component_order_key(F.col("path"))
    return O.first_and_last(s, [key], 3, desc_by=[key.desc()]).select("part", "path")


# ------------------------------------------------------ text / citations --


@query
def file_extension(spark, sf_dir):
    """STR-01: os.path.splitext(name)[1].lower()."""
    m = fixture(spark, sf_dir, "fx_manifest")
    return m.select("path", P.lower_extension(P.file_name(F.col("path"))).alias("ext"))


@query
def strip_text(spark, sf_dir):
    """STR-02: str.strip() over all 29 blank characters."""
    t = fixture(spark, sf_dir, "fx_noisy_text")
    return t.select("doc_id", T.py_strip("text").alias("text"))


@query
def clean_markdown(spark, sf_dir):
    """STR-03, STR-04."""
    t = fixture(spark, sf_dir, "fx_noisy_text")
    return t.select("doc_id", T.clean_markdown("text").alias("md"))


@query
def references_section(spark, sf_dir):
    """STR-05, JOB-06: section after clean-up ('' when none)."""
    t = CI.references(fixture(spark, sf_dir, "fx_noisy_text"), "text")
    return t.select("doc_id", "references")


@query
def references_truncated(spark, sf_dir):
    """STR-06: the first 8,000 characters (code points), as asked for by the
    argument, of the section and of the whole cleaned text. The full lengths
    come along; nothing else in the library cuts a text."""
    t = fixture(spark, sf_dir, "fx_noisy_text").select("doc_id", T.clean_markdown("text").alias("md"))
    return t.select("doc_id", T.truncate_chars(T.references_section("md"), REFERENCE_TEXT_LIMIT).alias("references"),
                    T.truncate_chars("md", REFERENCE_TEXT_LIMIT).alias("md_head"),
                    F.char_length("md").cast("bigint").alias("n_chars"))


@query
def strip_fence(spark, sf_dir):
    """STR-07."""
    r = fixture(spark, sf_dir, "fx_responses")
    return r.select("conv_id", "turn", T.strip_fence("response").alias("raw"))


def _flat_citations(df, keys):
    return df.select(*keys, "pos", "id", F.array_join("authors", "; ").alias("authors"),
                     F.size("authors").cast("int").alias("n_authors"), "year", "title", "venue", "doi")


@query
def citations_from_json(spark, sf_dir):
    """STR-08, JOB-08: one row per parsed citation."""
    r = CI.parse_citation_responses(fixture(spark, sf_dir, "fx_responses"), "response", ["conv_id", "turn"])
    return _flat_citations(r, ["conv_id", "turn"])


@query
def citation_counts(spark, sf_dir):
    """AGG-05: citations per answer, with the parse flag."""
    return CI.citation_counts(fixture(spark, sf_dir, "fx_responses"), "response", ["conv_id", "turn"])


@query
def citations_nonempty(spark, sf_dir):
    """SNK-04: the answers whose citation file is written (at least one)."""
    c = CI.citation_counts(fixture(spark, sf_dir, "fx_responses"), "response", ["conv_id", "turn"])
    return c.where(F.col("n_citations") > 0).select("conv_id", "turn", "n_citations")


@query
def citations_rules(spark, sf_dir):
    """JOB-07: rule-based citations from the references sections."""
    t = CI.references(fixture(spark, sf_dir, "fx_noisy_text"), "text").select("doc_id", "references")
    return _flat_citations(CI.extract_citations(t, "references", ["doc_id"]), ["doc_id"])


@query
def citations_mixed(spark, sf_dir):
    """JOB-07: citations of sections that mix the forms of entries."""
    t = fixture(spark, sf_dir, "fx_mixed_refs")
    return _flat_citations(CI.extract_citations(t, "refs", ["page_id"]), ["page_id"])


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


@query
def convert_documents(spark, sf_dir):
    """JOB-05, SNK-03: native HTML → Markdown with per-page status."""
    return CV.convert_html(_pages(spark, sf_dir).select("page_id", "html"), "html", ["page_id"])


@query
def convert_hostile(spark, sf_dir):
    """JOB-05: pages with quoted brackets, stray signs, unclosed elements and
    comments, nested lists, tables and code, against Markdown written by hand."""
    return CV.convert_html(fixture(spark, sf_dir, "fx_hostile_pages"), "html", ["page_id"]).select("page_id", "status", "md")


def _fragile_converter():
    """Makes a converter that some documents take down."""
    import os
    import time

    def convert(html):
        if html == "exit":
            os._exit(3)
        if html == "sleep":
            time.sleep(600)
        if html == "hog":
            return "x" * (1 << 34)
        return f"{len(html)} characters"
    return convert


@query
def convert_quarantine(spark, sf_dir):
    """UDF-01: a plugged-in converter in a process of its own; documents that
    end it, hang it or exhaust its memory are error rows, all others are ok."""
    done = Q.convert_quarantined(fixture(spark, sf_dir, "fx_fatal_pages"), _fragile_converter, "page_id", "html", seconds=1.0, memory_mb=512)
    return done.select("page_id", "status", "md", "error")


def _with_missing(pages):
    """Every eleventh page has no content, so that its conversion fails."""
    return pages.select("page_id", F.when(F.col("page_id") % 11 != 3, F.col("html")).alias("html"))


@query
def failures(spark, sf_dir):
    """FLT-08: the failed conversions and their error text."""
    res = CV.convert_html(_with_missing(_pages(spark, sf_dir)), "html", ["page_id"])
    return R.failures(res).select("page_id", "error")


# ------------------------------------------------------- sinks / streams --


@query
def csv_round_trip(spark, sf_dir):
    """SNK-01: labelled rows written as CSV (Python csv conventions) and read
    back unchanged."""
    spec = L.LabelSpec.default(3)
    rows = L.label_rows(fixture(spark, sf_dir, "fx_manifest"), spec, order=True)
    path = work_path(spark, "csv")
    SK.write_csv(rows, path, spec.active_headers())
    return SK.read_csv(spark, path, spec.active_headers())


PAGES_SCHEMA = "page_id BIGINT, url STRING, html STRING"


def _convert_pages(df):
    return CV.convert_html(_with_missing(df), "html", ["page_id"])


@query
def incremental_run(spark, sf_dir):
    """STM-01: two runs of the streaming conversion over the pages table;
    the second finds nothing new and retries the failures. The end state
    per page equals a one-shot conversion."""
    state = work_path(spark, "incremental")
    source, glob = INC.table_source(spark, f"{sf_dir.rstrip('/')}/pages.parquet")
    for _ in range(2):
        INC.stream_convert(spark, source, PAGES_SCHEMA, _convert_pages, "page_id", state_dir=state, glob=glob)
    return INC.latest_status(spark, state, "page_id").select("page_id", "status", "md", "error")


@query
def incremental_replay(spark, sf_dir):
    """STM-01 after a lost commit: two batches, then both once more under
    their numbers. The rows of all batches together are those of one run."""
    state = work_path(spark, "incremental-replay")
    pages = _pages(spark, sf_dir).select("page_id", "html")
    halves = [pages.where("page_id % 2 = 0"), pages]
    for seq in (1, 2, 1, 2):
        INC.run_batch(spark, halves[seq - 1], _convert_pages, "page_id", state, seq)
    rows = spark.read.parquet(f"{state}/results")
    return rows.groupBy("page_id").agg(F.max("status").alias("status"), F.count_if(F.col("status") == "ok").alias("n_ok"),
                                       F.count("*").alias("n_rows"))


@query
def conversion_report(spark, sf_dir):
    """JOB-09 over an incremental batch run: the second run of the page
    conversion skips what the first finished and tries the failures again."""
    state = work_path(spark, "convert-runs")
    pages = _pages(spark, sf_dir).select("page_id", "html")
    INC.convert_run(spark, pages, _convert_pages, "page_id", state)
    second = INC.convert_run(spark, pages, _convert_pages, "page_id", state)
    return R.tally(second, R.CONVERT_STATUSES, ok="ok", fail="error")


@query
def conversion_rows(spark, sf_dir):
    """JOB-05/06/09, SNK-03: the conversion job over pages named by path: per
    page its status, the Markdown's target path and its number of citations,
    read back from the written run table."""
    pages = _pages(spark, sf_dir).select(
        F.concat(F.lit("site/"), F.col("page_id") % 7, F.lit("/p"), "page_id", F.lit(".html")).alias("path"), "html")
    run = JOBS.convert_job(spark, pages, "path", work_path(spark, "convert-job"), with_citations=True, target="nested")["run"]
    return run.select("path", "status", "target_path", "citations", "complete")


@query
def citation_files(spark, sf_dir):
    """SNK-04: the citation files written for the answers with at least one
    citation, read back."""
    cits, _ = CI.parse_citation_array("response")
    path = work_path(spark, "citation-files")
    CI.write_citations(fixture(spark, sf_dir, "fx_responses").select("conv_id", "turn", cits.alias("citations")),
                       "citations", path, ["conv_id", "turn"])
    back = spark.read.schema(f"conv_id BIGINT, turn INT, citations {CI.CITATION_TYPE}").json(path)
    return back.select("conv_id", "turn", F.size("citations").cast("int").alias("n_citations"))


@query
def report_tables(spark, sf_dir):
    """SNK-02, SNK-06: the label summary and the run report written as tables
    and read back."""
    rows = L.label_rows(fixture(spark, sf_dir, "fx_manifest"), L.LabelSpec.default(3), order=False)
    path = work_path(spark, "reports")
    SK.write_table(L.label_summary(rows, ["level_1", "level_2", "level_3"]), f"{path}/summary")
    SK.write_table(R.tally(_shard_run(spark, sf_dir)), f"{path}/run")
    summary = spark.read.parquet(f"{path}/summary").select("breakdown", "n")
    run = spark.read.parquet(f"{path}/run")
    return summary.unionByName(run.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("breakdown"), F.col(c).alias("n")) for c in run.columns])).alias("r")).select("r.*"))


@query
def summary_order(spark, sf_dir):
    """SRT-04: the order of the summary as positions."""
    _, summary = L.label_dataset(fixture(spark, sf_dir, "fx_manifest"), L.LabelSpec.default(3))
    return O.with_position(summary.select(F.col("pos").alias("level"), "value", "n"),
                           [F.col("level"), F.col("value").asc_nulls_first()], name="place")


@query
def spec_json(spark, sf_dir):
    """SNK-05, SRC-09: the discovered spec written as JSON and read back as
    the column spec of the next run."""
    spec, _ = L.discover_structure(fixture(spark, sf_dir, "fx_manifest"))
    path = work_path(spark, "spec") + "/dataset_config.json"
    SK.write_text_file(spark, path, spec.to_json())
    back = L.LabelSpec.from_json(SK.read_text_file(spark, path))
    return spark.createDataFrame([(s.name, s.header, s.enabled, back.max_depth) for s in back.slots()],
                                 "slot string, header string, enabled boolean, max_depth int")


@query
def data_files_plan(spark, sf_dir):
    """SRC-07 + FLT-07 with the data-file threshold: data shards by suffix,
    skipped when present and larger than 100,000 bytes."""
    wanted = S.shards_by_suffix(fixture(spark, sf_dir, "fx_shards")).select("path")
    return PL.plan_acquisition(wanted, fixture(spark, sf_dir, "fx_present"), min_bytes=PL.DATA_FILE_MIN_BYTES)


@query
def conversion_plan(spark, sf_dir):
    """Dry run of the mirrored-tree converter (PRJ-08 + JON-01/04): every
    PDF of the strict scan with its target; ``skipped`` when the target
    exists already (targets of the sources finished earlier), else
    ``convert``. The skip test precedes the dry-run stop, as in the source."""
    pdfs = S.pdf_files_strict(fixture(spark, sf_dir, "fx_manifest")).select(
        F.col("path").alias("source"), P.with_suffix("path", ".md").alias("path"))
    existing = PL.mirrored_target(fixture(spark, sf_dir, "fx_outputs")).select(F.col("target_path").alias("path"))
    plan = PL.plan_acquisition(pdfs, existing)
    return plan.select(F.col("source").alias("path"), F.col("path").alias("target_path"),
                       F.when(F.col("status") == "skip", "skipped").otherwise("convert").alias("status"))


# ------------------------------------ one pass, stored keys, timed retries --


@query
def label_job_widths(spark, sf_dir):
    """JOB-02, AGG-06, SNK-01/02: the labelling job, whose one scan of the
    manifest also carries the column widths out; they are read back."""
    out = work_path(spark, "label-job")
    JOBS.label_job(spark, fixture(spark, sf_dir, "fx_manifest"), out, L.LabelSpec.default(3))
    return spark.read.parquet(f"{out}/{L.DEFAULT_OUTPUT_STEM}_widths")


@query
def label_job_rows(spark, sf_dir):
    """JOB-03, SNK-01: the rows written by the fixed-depth labelling job, read
    back."""
    out = work_path(spark, "label-job-fixed")
    JOBS.label_job_fixed(spark, fixture(spark, sf_dir, "fx_manifest"), out, FIXED_DEPTH2)
    return SK.read_csv(spark, f"{out}/{L.DEFAULT_OUTPUT_STEM}_rows", list(FIXED_DEPTH2))


@query
def empty_runs(spark, sf_dir):
    """FLT-09: the outputs that the labelling job writes for the whole
    manifest and for its PDF files alone (no image: none)."""
    manifest = fixture(spark, sf_dir, "fx_manifest")
    found = None
    for name, part in (("all", manifest), ("no image", S.pdf_files_pruned(manifest))):
        out = work_path(spark, "guarded")
        JOBS.label_job(spark, part, out, L.LabelSpec.default(3))
        outputs = M.list_files(spark, out).select(F.lit(name).alias("run"), P.level(F.col("path"), 1).alias("output")).distinct()
        found = outputs if found is None else found.unionByName(outputs)
    return found


@query
def sample_widths(spark, sf_dir):
    """SRT-06: column widths over the first 500 rows in tree order."""
    spec = L.LabelSpec.default(3)
    rows = L.label_rows(fixture(spark, sf_dir, "fx_manifest"), spec, order=False)
    return L.column_widths(rows, spec.active_headers(), sample_rows=500, order_by=[P.tree_order_key(F.col("path"))])


@query
def csv_split_read(spark, sf_dir):
    """SNK-01: texts with quotes and line breaks written as CSV and read back
    by byte ranges, many tasks a file."""
    path = work_path(spark, "csv-split")
    texts = fixture(spark, sf_dir, "fx_noisy_text").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    SK.write_csv(texts, path)
    back = CS.read_csv_split(spark, path, ["doc_id", "text"], glob="*.csv")
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


@query
def csv_one_header(spark, sf_dir):
    """SNK-01: rows in tree order as parts below one header, read back."""
    spec = L.LabelSpec.default(3)
    path = work_path(spark, "csv-ordered")
    CS.write_csv_ordered(L.label_rows(fixture(spark, sf_dir, "fx_manifest"), spec), path, spec.active_headers())
    return CS.read_csv_split(spark, path, spec.active_headers(), glob="part-*", header=False)


@query
def stored_skip(spark, sf_dir):
    """JON-02: the present files kept as a bucketed table, appended by two
    runs; wanted shards against it."""
    store = KeyStore(work_path(spark, "present"), buckets=8)
    present = fixture(spark, sf_dir, "fx_present").select("path", "length")
    for run in (0, 1):
        store.append(present.where(F.col("length") % 2 == run))
    wanted = S.shards_by_prefix(fixture(spark, sf_dir, "fx_shards"), "data/python").select("path")
    return PL.plan_acquisition(wanted, store.read(spark), min_bytes=PL.SHARD_MIN_BYTES)


@query
def stored_pending(spark, sf_dir):
    """JON-01: what is not finished, against the bucketed table of finished
    paths."""
    store = KeyStore(work_path(spark, "finished"), schema="path STRING", buckets=8)
    store.append(fixture(spark, sf_dir, "fx_outputs"))
    return PL.pending(fixture(spark, sf_dir, "fx_manifest").select("path"), store.read(spark))


@query
def timed_retries(spark, sf_dir):
    """STM-01: pages without content fail and are tried again after 2, 4 and 8
    units; half of them have content by then. Status and attempts per page."""
    state = work_path(spark, "retries")
    pages = _pages(spark, sf_dir).select("page_id", "html")
    broken = pages.where("page_id % 11 = 3").select((-F.col("page_id") - 1).alias("page_id"), "html")
    now = pages.unionByName(broken.withColumn("html", F.lit(None).cast("string")))
    later = pages.unionByName(broken.withColumn("html", F.when(F.col("page_id") % 2 == 0, F.col("html"))))

    def convert(df):
        return CV.convert_html(df, "html", ["page_id"])
    RT.log_attempts(convert(now), "page_id", 1, state, 0)
    stream = RT.start_retries(spark, lambda: later, convert, "page_id", state, unit_seconds=0.25, poll="250 milliseconds")
    if not RT.run_until_settled(stream, 300):
        raise TimeoutError("the retries did not settle")
    return RT.outcome(spark, state, "page_id")


@query
def flat_folder(spark, sf_dir):
    """SRC-01: a folder with more entries than one task takes, listed in
    shares by several tasks."""
    root = work_path(spark, "flat")
    table(spark, sf_dir, "documents").select((F.col("doc_id") % 200).alias("part"), "n_chars") \
        .repartition("part").write.partitionBy("part").parquet(root)
    files = M.list_files(spark, root, split_at=50).where(F.col("path").endswith(".parquet"))
    return files.groupBy(P.folder_path(F.col("path")).alias("folder")).agg(
        F.count("*").alias("n_files"), (F.min("length") > 0).alias("has_bytes"))


@query
def live_progress(spark, sf_dir):
    """WIN-03, SNK-06: the progress of an incremental conversion after each of
    its batches; the second brings failures, the third tries them again."""
    state = work_path(spark, "live")
    pages = _pages(spark, sf_dir).select("page_id", "html")
    empty = pages.where("page_id % 11 = 3").select((-F.col("page_id") - 1).alias("page_id"), F.lit(None).cast("string").alias("html"))
    batches = [pages.where("page_id % 2 = 0"), pages.unionByName(empty), empty]

    def convert(df):
        return CV.convert_html(df, "html", ["page_id"])
    seen = None
    for seq, batch in enumerate(batches, start=1):
        INC.run_batch(spark, batch, convert, "page_id", state, seq)
        now = INC.live_progress(spark, state).where(F.col("batch") == seq)
        seen = now if seen is None else seen.unionByName(now)
    return seen
