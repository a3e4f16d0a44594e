"""Folder structure → label columns, per-label summaries, structure discovery.

Input is a file manifest (``path`` relative to the dataset root, '/'-
separated). Everything is a lazy DataFrame plan: the summary is one
aggregation of (level, value) pairs (partial counts → Exchange → final), the
sample of every folder is a ``row_number() <= 3`` window that
Spark turns into a partial group limit before the shuffle.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.fixed import (DEFAULT_OUTPUT_STEM, FIXED_HEADERS, NONE_VALUE, SAMPLE_IMAGES_PER_FOLDER,
                              SEP_FIXED, SEP_SPEC, TOTAL_LABEL, WIDTH_MAX, WIDTH_PADDING)
from corpusmill.functions import paths as P
from corpusmill.functions import text as T


@dataclass(frozen=True)
class Slot:
    """One possible output column: what it holds, its header, whether it is
    written. ``level`` is 0 for the two columns that are not labels."""

    name: str
    level: int
    header: str
    enabled: bool


@dataclass
class LabelSpec:
    """Column spec: a header and a switch per slot, plus depth and output stem.

    Slots are ``filename``, ``path`` and ``level_1`` .. ``level_<max_depth>``;
    ``columns`` holds the entries of the JSON file under these names.
    """

    max_depth: int
    columns: dict[str, dict] = field(default_factory=dict)
    output_stem: str = DEFAULT_OUTPUT_STEM

    def slots(self) -> list[Slot]:
        """Every slot in output order; one without an entry is off."""
        names = {"filename": 0, "path": 0}
        names.update((f"level_{n}", n) for n in range(1, self.max_depth + 1))
        typed = []
        for name, level in names.items():
            entry = self.columns.get(name)
            typed.append(Slot(name, level, name if entry is None else entry["header"],
                              entry is not None and bool(entry.get("enabled", True))))
        return typed

    @classmethod
    def default(cls, max_depth: int) -> "LabelSpec":
        spec = cls(max_depth)
        spec.columns = {slot.name: {"header": slot.name, "enabled": True} for slot in spec.slots()}
        return spec

    @classmethod
    def from_json(cls, text: str) -> "LabelSpec":
        d = json.loads(text)
        return cls(int(d["max_depth"]), dict(d["columns"]), d.get("output_stem", DEFAULT_OUTPUT_STEM))

    def to_json(self) -> str:
        return json.dumps({"max_depth": self.max_depth, "columns": self.columns,
                           "output_stem": self.output_stem}, indent=2)

    def validate(self) -> None:
        missing = [slot.name for slot in self.slots() if slot.name not in self.columns]
        if missing:
            raise ValueError(f"column spec has no entry for slot(s) {missing}")
        headers = self.active_headers()
        dup = sorted({h for h in headers if headers.count(h) > 1})
        if dup:
            raise ValueError(f"column spec repeats header(s) {dup}")

    def active_headers(self) -> list[str]:
        """Headers of the columns that are written, in output order (PRJ-05)."""
        return [slot.header for slot in self.slots() if slot.enabled]

    def label_headers(self) -> list[str]:
        """The label columns among them, for the summary (PRJ-06)."""
        return [slot.header for slot in self.slots() if slot.enabled and slot.level]


# ----------------------------------------------------------------------------
# Scans over a manifest
# ----------------------------------------------------------------------------

def image_files(manifest: DataFrame, path_col: str = "path") -> DataFrame:
    """Images at any depth; folders starting with '.' are pruned at every
    level, dot *files* are kept (SRC-03, FLT-01, FLT-02)."""
    p = F.col(path_col)
    return manifest.where(P.is_image(P.file_name(p)) & ~P.has_dot_folder(p))


def files_at_depth(manifest: DataFrame, depth: int, path_col: str = "path") -> DataFrame:
    """Every file exactly ``depth`` folders down; no name or extension test
    (SRC-02)."""
    return manifest.where(P.depth(F.col(path_col)) == depth)


# ----------------------------------------------------------------------------
# Projections
# ----------------------------------------------------------------------------

def label_rows(manifest: DataFrame, spec: LabelSpec, path_col: str = "path",
               order: bool = True, path_as: str | None = None) -> DataFrame:
    """Labelled image rows for an any-depth tree (PRJ-01..05, SRT-01).

    Missing levels are ``""``. An image deeper than ``spec.max_depth`` raises
    (the spec is stale) instead of producing a ragged row. ``path_as`` names a
    further column with the path, to order by later.
    """
    spec.validate()
    src = F.col(path_col)
    guard = F.when(P.depth(src) > spec.max_depth,
                   F.raise_error(F.concat(F.lit(f"image deeper than max_depth {spec.max_depth}: "), src)))
    p = F.coalesce(guard, src)  # every label reads the checked path (evaluated once per row)
    special = {"filename": P.file_name(p), "path": p}
    cols: list[Column] = [(P.level(p, slot.level) if slot.level else special[slot.name]).alias(slot.header)
                          for slot in spec.slots() if slot.enabled]
    images = image_files(manifest, path_col)
    if path_as is not None:
        cols.append(p.alias(path_as))
    if not order:
        return images.select(*cols)
    return images.select(*cols, p.alias("__path")).orderBy(P.tree_order_key(F.col("__path"))).drop("__path")


def label_rows_fixed(manifest: DataFrame, headers: tuple[str, ...] | list[str] = FIXED_HEADERS,
                     path_col: str = "path", order: bool = True, path_as: str | None = None) -> DataFrame:
    """Rows of a fixed-depth tree: depth = ``len(headers) - 2``; every file at
    that depth, headers[2:] take the folder names in order (SRC-02, PRJ-02,
    SRT-02). ``path_as`` names a further column with the path."""
    headers = list(headers)
    if len(headers) < 2 or len(set(headers)) != len(headers):
        raise ValueError("headers: two fixed names plus one per level, no repeats")
    depth = len(headers) - 2
    p = F.col(path_col)
    rows = files_at_depth(manifest, depth, path_col)
    cols = [P.file_name(p).alias(headers[0]), p.alias(headers[1])]
    cols += [F.get(P.folders(p), i).alias(h) for i, h in enumerate(headers[2:])]
    if path_as is not None:
        cols.append(p.alias(path_as))
    out = rows.select(*cols, p.alias("__path"))
    if order:
        out = out.orderBy(P.component_order_key(F.col("__path")))
    return out.drop("__path")


# ----------------------------------------------------------------------------
# Aggregations
# ----------------------------------------------------------------------------

def label_summary(rows: DataFrame, label_headers: list[str], separator: str = SEP_SPEC,
                  none_placeholder: bool = True, order: bool = False) -> DataFrame:
    """Total row plus a count per value of every label column (AGG-01/02,
    SET-01, PRJ-11, STR-14, SRT-04), in one pass: every row becomes one
    (0, total) and one (level, value) pair per label, which are counted with
    partial sums before the shuffle, whatever the depth. No rows give no
    summary.

    Output: ``pos`` (0 for the total, i for the i-th label header), ``header``,
    ``value``, ``breakdown`` (the summary text), ``n``.
    """
    pairs = [F.struct(F.lit(0).alias("pos"), F.lit(None).cast("string").alias("value"))]
    for i, h in enumerate(label_headers):
        value = T.placeholder_if_empty(F.col(h), NONE_VALUE) if none_placeholder else F.coalesce(F.col(h), F.lit(""))
        pairs.append(F.struct(F.lit(i + 1).alias("pos"), value.alias("value")))
    stacked = rows.select(F.explode(F.array(*pairs)).alias("p")).select("p.pos", "p.value")
    agg = stacked.groupBy("pos", "value").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(F.lit(None).cast("string"), *[F.lit(h) for h in label_headers])
    header = F.element_at(names, F.col("pos") + 1)
    text = F.when(F.col("pos") == 0, F.lit(TOTAL_LABEL)).otherwise(F.concat(header, F.lit(separator), F.col("value")))
    out = agg.select("pos", header.alias("header"), "value", text.alias("breakdown"), "n")
    return out.orderBy("pos", "value") if order else out


def max_depth(manifest: DataFrame, path_col: str = "path") -> DataFrame:
    """Deepest folder level holding an image; 0 when only the root does or
    there are none (AGG-04). One row, one column ``max_depth``."""
    imgs = image_files(manifest, path_col)
    return imgs.agg(F.coalesce(F.max(P.depth(F.col(path_col))), F.lit(0)).cast("int").alias("max_depth"))


def sample_tree(manifest: DataFrame, path_col: str = "path",
                per_folder: int = SAMPLE_IMAGES_PER_FOLDER) -> DataFrame:
    """First ``per_folder`` images of every folder, by name (WIN-02).

    Output: ``folder`` (path, '' for the root), ``depth``, ``images``
    (sorted array). The ``row_number() <= k`` filter becomes a partial
    WindowGroupLimit before the shuffle, so a folder with a third of all files
    still ships at most ``k`` rows per input partition.
    """
    p = F.col(path_col)
    imgs = image_files(manifest, path_col).select(
        P.folder_path(p).alias("folder"), P.depth(p).alias("depth"),
        P.file_name(p).alias("name"))
    w = Window.partitionBy("folder").orderBy("name")
    top = imgs.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= per_folder)
    return top.groupBy("folder", "depth").agg(F.array_sort(F.collect_list("name")).alias("images"))


def column_widths(rows: DataFrame, headers: list[str], sample_rows: int | None = None,
                  order_by: list[Column] | None = None) -> DataFrame:
    """Display width per column: longest of the header and the non-empty
    values, plus 4, at most 60 (AGG-06). All rows count, in one partial
    aggregate without a sort; ``sample_rows`` limits them to the first ones in
    ``order_by`` (SRT-06) where that is what is asked for."""
    head = rows
    if sample_rows is not None:
        head = (rows.orderBy(*order_by) if order_by else rows).limit(sample_rows)
    return shown_widths(head.agg(*width_metrics(headers)), headers)


def width_metrics(headers: list[str]) -> list[Column]:
    """Longest non-empty value of every column, as aggregates ``__w<i>``."""
    return [F.max(F.char_length(F.nullif(F.col(h), F.lit("")))).alias(f"__w{i}") for i, h in enumerate(headers)]


def shown_widths(widths: DataFrame, headers: list[str]) -> DataFrame:
    """One row of ``width_metrics`` → the display width per column."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(h).alias("header"),
                 F.least(F.greatest(F.lit(len(h)), F.coalesce(F.col(f"__w{i}"), F.lit(0)))
                         + WIDTH_PADDING, F.lit(WIDTH_MAX)).alias("width"))
        for i, h in enumerate(headers)]))
    return widths.select(stacked.alias("c")).select("c.pos", "c.header", F.col("c.width").cast("int").alias("width"))


def discover_structure(manifest: DataFrame, path_col: str = "path") -> tuple[LabelSpec, DataFrame]:
    """Structure discovery (JOB-01): a default spec for the deepest image
    level and the per-folder sample. The depth is one scalar brought to the
    driver; the sample stays a DataFrame."""
    depth = max_depth(manifest, path_col).first()["max_depth"]
    return LabelSpec.default(int(depth)), sample_tree(manifest, path_col)


def label_dataset(manifest: DataFrame, spec: LabelSpec, path_col: str = "path") -> tuple[DataFrame, DataFrame]:
    """Any-depth labelling job (JOB-02): ordered rows and the summary, which is
    counted from unordered rows."""
    summary = label_summary(label_rows(manifest, spec, path_col, order=False), spec.label_headers(), SEP_SPEC,
                            none_placeholder=True, order=True)
    return label_rows(manifest, spec, path_col, order=True), summary


def label_dataset_fixed(manifest: DataFrame, headers=FIXED_HEADERS, path_col: str = "path") -> tuple[DataFrame, DataFrame]:
    """Fixed-depth labelling job (JOB-03): ordered rows and the summary
    (raw values, ``h = v``), which is counted from unordered rows."""
    summary = label_summary(label_rows_fixed(manifest, headers, path_col, order=False), list(headers[2:]), SEP_FIXED,
                            none_placeholder=False, order=True)
    return label_rows_fixed(manifest, headers, path_col, order=True), summary
