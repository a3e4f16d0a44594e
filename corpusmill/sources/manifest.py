"""File manifest of a folder tree (SRC-01, FLT-03).

``binaryFile`` and the file sources hide names starting with '.' or '_' and
zero-byte files; the labelers and converters must see all of them. The
listing is therefore its own distributed job, breadth first: each level is
one ``mapInArrow`` over the folders found so far, spread round-robin over
tasks, each folder listed without recursion. A subtree holding a third of all
files is thus listed by many tasks, level by level. A task that meets more than
``SPLIT_AT`` entries in one folder gives the folder back: on the next round it
is listed in shares by many tasks. Each of them streams through the names,
which is cheap, and asks for size and time, which is not, of its own share
alone (those whose name's hash falls to it). Entries leave a task in batches
of ``CHUNK``. Remote folders have no such stream here: one folder's direct
entries are one call and one list in memory. The driver never holds the file list, only the size of each
frontier; each level is written to the shared checkpoint folder, so that the
files and the next frontier come from one listing.
"""

from __future__ import annotations

import os
import zlib
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import checkpoint_dir, ship_package

MANIFEST_SCHEMA = "path STRING, length BIGINT, modification_time TIMESTAMP"
CHUNK = 8192
SPLIT_AT = 65_536  # entries of one folder that one task lists by itself
_ENTRY_SCHEMA = "kind STRING, path STRING, length BIGINT, mtime_us BIGINT"
_ENTRY_ARROW = pa.schema([("kind", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("mtime_us", pa.int64())])


def _filesystem(root: str):
    from pyarrow import fs as pafs
    if root.startswith("file:"):
        root = urlparse(root).path          # file:/x and file:///x are local paths
    if "://" in root:
        filesystem, base = pafs.FileSystem.from_uri(root)
    else:
        filesystem, base = pafs.LocalFileSystem(), os.path.abspath(root)
    return filesystem, base.rstrip("/")


def _local_entry(e):
    """(name, is folder, is file, size, mtime_us). Links are not followed: a
    link to a folder is neither a folder nor a file, a link to a file is a
    file."""
    if e.is_dir(follow_symlinks=False):
        return e.name, True, False, None, None
    if e.is_file():
        stat = e.stat()
        return e.name, False, True, stat.st_size, stat.st_mtime_ns // 1000
    return e.name, False, False, None, None


def _folder(filesystem, start: str, share: int, shares: int, split_at: int):
    """The entries of a folder, or of one share of them (``share`` below 0:
    all). None instead of the entries of a whole folder that has more than
    ``split_at``."""
    from pyarrow import fs as pafs
    if isinstance(filesystem, pafs.LocalFileSystem):
        if not os.path.isdir(start):
            return
        with os.scandir(start) as entries:
            if share >= 0:
                for e in entries:
                    if zlib.crc32(os.fsencode(e.name)) % shares == share:
                        yield _local_entry(e)
                return
            found = []
            for e in entries:
                found.append(e)
                if len(found) > split_at:
                    yield None
                    return
            yield from map(_local_entry, found)
        return
    for info in filesystem.get_file_info(pafs.FileSelector(start, recursive=False, allow_not_found=True)):
        yield (info.base_name, info.type == pafs.FileType.Directory, info.type == pafs.FileType.File, info.size,
               info.mtime_ns // 1000 if info.mtime_ns is not None else None)


def _entries(root: str, prune: frozenset[str], prune_dot: bool, shares: int, split_at: int):
    def run(batches):
        filesystem, base = _filesystem(root)

        def rows():
            for batch in batches:
                for rel_dir, share in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    start = f"{base}/{rel_dir}" if rel_dir else base
                    for entry in _folder(filesystem, start, share, shares, split_at):
                        if entry is None:
                            yield "large", rel_dir, None, None
                            continue
                        name, is_dir, is_file, size, mtime = entry
                        rel = f"{rel_dir}/{name}" if rel_dir else name
                        if is_dir and not (name in prune or prune_dot and name.startswith(".")):
                            yield "dir", rel, None, None
                        elif is_file:
                            yield "file", rel, size, mtime

        held = []
        for row in rows():
            held.append(row)
            if len(held) == CHUNK:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ENTRY_ARROW)],
                                                 schema=_ENTRY_ARROW)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _ENTRY_ARROW)],
                                             schema=_ENTRY_ARROW)
    return run


def list_files(spark: SparkSession, root: str, prune_dirs=(), prune_dot_dirs: bool = False,
               tasks: int | None = None, split_at: int = SPLIT_AT) -> DataFrame:
    """Every regular file below ``root``: ``path`` relative to the root
    ('/'-separated), ``length``, ``modification_time``. Dot files, '_' names
    and empty files are kept. Folders named in ``prune_dirs`` (and dot
    folders when ``prune_dot_dirs``) are not entered. Symbolic links to
    folders are not followed. A local or mounted folder of more than
    ``split_at`` entries is listed by ``tasks`` tasks together."""
    checkpoint_dir(spark)
    ship_package(spark)
    prune = frozenset(prune_dirs)
    n = tasks or spark.sparkContext.defaultParallelism
    whole = F.lit(-1).alias("share")
    frontier = spark.range(1).select(F.lit("").alias("dir"), whole)
    out = None
    while True:
        listed = frontier.repartition(n).mapInArrow(
            _entries(root, prune, prune_dot_dirs, n, split_at), _ENTRY_SCHEMA).checkpoint(eager=True)
        files = listed.where(F.col("kind") == "file")
        out = files if out is None else out.unionByName(files)
        folders = listed.where(F.col("kind") == "dir").select(F.col("path").alias("dir"), whole)
        large = listed.where(F.col("kind") == "large").select(
            F.col("path").alias("dir"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("share"))
        frontier = folders.unionByName(large)
        if frontier.isEmpty():
            break
    return out.select("path", "length", F.timestamp_micros("mtime_us").alias("modification_time"))


def from_paths(listing: DataFrame, path_col: str = "path") -> DataFrame:
    """A remote listing (paths only) in manifest shape: sizes unknown."""
    return listing.select(F.col(path_col).alias("path"), F.lit(None).cast("bigint").alias("length"),
                          F.lit(None).cast("timestamp").alias("modification_time"))
