"""Path rules as ``Column -> Column`` functions.

Paths are '/'-separated and relative to a listing root. Python's path
helpers are the behaviour to match (``os.path.splitext``, ``Path.stem``,
``Path.with_suffix``, ``os.path.basename``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from corpusmill.fixed import IMAGE_EXTENSIONS  # noqa: F401


# os.path.splitext: leading dots never start an extension.
_EXT = r"(?s)\A\.*[^.].*(\.[^.]*)\z"
# pathlib: the suffix starts at the last '.', which must be neither the first
# nor the last character of the name.
_PATHLIB_STEM = r"(?s)\A(.+)\.[^.]+\z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parts(path: Column | str) -> Column:
    """Path components."""
    return F.split(_c(path), "/", -1)


def file_name(path: Column | str) -> Column:
    """Base name (STR-13)."""
    return F.element_at(parts(path), -1)


def folders(path: Column | str) -> Column:
    """Folder components above the file (PRJ-01)."""
    p = parts(path)
    return F.slice(p, 1, F.size(p) - 1)


def depth(path: Column | str) -> Column:
    """Number of folders above the file."""
    return F.size(parts(path)) - 1


def folder_path(path: Column | str) -> Column:
    """Parent folder as a path ('' at the root)."""
    return F.array_join(folders(path), "/")


def extension(name: Column | str) -> Column:
    """``os.path.splitext(name)[1]`` (case kept)."""
    return F.regexp_extract(_c(name), _EXT, 1)


def lower_extension(name: Column | str) -> Column:
    """``os.path.splitext(name)[1].lower()`` (STR-01)."""
    return F.lower(extension(name))


def stem(name: Column | str) -> Column:
    """``Path(name).stem``: the name without its last suffix (STR-12).
    pathlib, not ``splitext``: ``..pdf`` → ``.``, ``a.`` → ``a.``."""
    n = _c(name)
    return F.when(F.regexp_like(n, F.lit(_PATHLIB_STEM)), F.regexp_extract(n, _PATHLIB_STEM, 1)).otherwise(n)


def with_suffix(path: Column | str, suffix: str) -> Column:
    """``Path(path).with_suffix(suffix)`` on the last component (PRJ-08)."""
    p = _c(path)
    name = file_name(p)
    new_name = F.concat(stem(name), F.lit(suffix))
    return F.when(F.size(parts(p)) > 1, F.concat_ws("/", folder_path(p), new_name)).otherwise(new_name)


def is_image(name: Column | str) -> Column:
    """Image by extension, case-insensitive (FLT-01)."""
    return lower_extension(name).isin(*IMAGE_EXTENSIONS)


def has_dot_folder(path: Column | str) -> Column:
    """Some folder above the file starts with '.' (FLT-02): a component that
    starts with '.' and is followed by '/'. A regex rather than
    ``exists(folders, ...)``: higher-order functions fall back to interpreted
    evaluation and take the whole filter out of whole-stage codegen."""
    return F.regexp_like(_c(path), F.lit(r"(?:^|/)\.[^/]*/"))


def level(path: Column | str, i: int) -> Column:
    """Folder at depth ``i`` (from 1), ``""`` when the file is shallower (PRJ-03)."""
    return F.coalesce(F.try_element_at(folders(path), F.lit(i)), F.lit(""))


def tree_order_key(path: Column | str) -> Column:
    """Pre-order of a folder walk: a folder's own files first, then its
    subfolders, each by name (SRT-01).

    As a string: every folder component prefixed with '1', the file name
    with '0', joined by U+0000 (below every character of a name, so a name
    sorts before its own extensions, as component order requires). String
    keys stay in whole-stage codegen and sort on an 8-byte prefix.
    """
    p = _c(path)
    folder_part = F.regexp_replace(folder_path(p), "/", "\u00001")
    return F.when(F.size(parts(p)) > 1,
                  F.concat(F.lit("1"), folder_part, F.lit("\u00000"), file_name(p))
                  ).otherwise(F.concat(F.lit("0"), file_name(p)))


def component_order_key(path: Column | str) -> Column:
    """Order by path components, not by the string (SRT-02/03):
    ``A/b.pdf`` sorts before ``A-x/1.pdf``."""
    return parts(path)
