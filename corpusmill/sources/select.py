"""Selections over a file manifest or a remote listing (SRC-04..07).

All are plain predicates, so Catalyst pushes what it can into the scan of
the manifest table (``StartsWith``/``EndsWith`` become parquet filters)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.fixed import CONVERTED_DIR, DATA_SUFFIXES, README_MARK  # noqa: F401
from corpusmill.functions import paths as P


def pdf_files_strict(manifest: DataFrame, path_col: str = "path") -> DataFrame:
    """``rglob("*.pdf")`` on a POSIX file system: case-sensitive suffix, dot
    entries and every folder included (SRC-04)."""
    return manifest.where(F.col(path_col).endswith(".pdf"))


def pdf_files_pruned(manifest: DataFrame, path_col: str = "path",
                     pruned_dir: str = CONVERTED_DIR) -> DataFrame:
    """``.pdf`` in any case; folders named exactly ``pruned_dir`` are not
    entered at any level (SRC-05, FLT-04)."""
    p = F.col(path_col)
    return manifest.where(F.lower(P.file_name(p)).endswith(".pdf")
                          & ~F.array_contains(P.folders(p), pruned_dir))


def shards_by_prefix(listing: DataFrame, folder: str, suffix: str = ".parquet",
                     path_col: str = "path") -> DataFrame:
    """Files below ``folder/`` with the given suffix (SRC-06)."""
    p = F.col(path_col)
    return listing.where(p.startswith(folder.rstrip("/") + "/") & p.endswith(suffix))


def shards_by_suffix(listing: DataFrame, suffixes=DATA_SUFFIXES, path_col: str = "path") -> DataFrame:
    """Data files by suffix; drops paths whose first character is '.' and
    paths containing ``README`` anywhere, case-sensitive (SRC-07, FLT-05)."""
    p = F.col(path_col)
    any_suffix = F.lit(False)
    for s in suffixes:
        any_suffix = any_suffix | p.endswith(s)
    return listing.where(any_suffix & ~p.startswith(".") & ~p.contains(README_MARK))
