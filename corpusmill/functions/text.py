"""String rules as ``Column -> Column`` functions (JVM-side, codegen friendly).

Python's string methods (``strip``, ``splitlines``, ``os.path.splitext``) are
the behaviour to match; Spark's ``trim`` and regex ``\\s`` cover far fewer
characters, so the character classes below are spelt out with ``\\x{hhhh}``
escapes that Java regex and RE2 read the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.fixed import BAD_FILENAME_CHARS, REFERENCE_HEADINGS

# --- Python string behaviour (what str.isspace / str.splitlines accept) -------
# Every character for which Python's str.isspace() is true (29 characters).
WS = (r"[\x{0009}-\x{000d}\x{001c}-\x{0020}\x{0085}\x{00a0}\x{1680}"
      r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
# Line boundaries of Python's str.splitlines().
SEP = r"\r\n|[\x{000a}-\x{000d}\x{001c}-\x{001e}\x{0085}\x{2028}\x{2029}]"
# Blanks that are not line boundaries (WS minus the SEP characters).
HS = (r"[\x{0009}\x{001f}\x{0020}\x{00a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{202f}\x{205f}\x{3000}]")
# The same two sets as plain characters, for the non-regex trim functions.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b))
            + "\u2028\u2029\u202f\u205f\u3000")
HS_CHARS = ("\t\x1f \xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b)) + "\u202f\u205f\u3000")
# Line boundaries other than \n and \r\n.
OTHER_LINE_ENDS = r"[\r\x{000b}\x{000c}\x{001c}-\x{001e}\x{0085}\x{2028}\x{2029}]"
# --- end of Python string behaviour -------------------------------------------

REFS = (r"(?imdu)^#{1,3}" + WS + "*(?:" + "|".join(REFERENCE_HEADINGS) + ")"
        + WS + r"*$(?s:.*)")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col: Column | str) -> Column:
    """``str.strip()``: remove all 29 Unicode blanks at both ends. ``btrim``
    with an explicit character set touches only the ends (no regex scan)."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def py_rstrip(col: Column | str, chars: str = WS_CHARS) -> Column:
    """``str.rstrip()`` (``rtrim(trimStr, str)``)."""
    return F.call_function("rtrim", F.lit(chars), _c(col))


def py_lstrip(col: Column | str, chars: str = WS_CHARS) -> Column:
    """``str.lstrip()`` (``ltrim(trimStr, str)``)."""
    return F.call_function("ltrim", F.lit(chars), _c(col))


def split_lines(col: Column | str) -> Column:
    """``str.splitlines()`` as an array (a final line break adds no element)."""
    c = _c(col)
    parts = F.split(c, SEP, -1)
    # splitlines drops the empty piece after a trailing line break
    ends_with_break = F.regexp_like(c, F.lit("(?:" + SEP + r")\z"))
    return F.when(c == "", F.array().cast("array<string>")).when(
        ends_with_break, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def clean_markdown(col: Column | str) -> Column:
    """Clean-up of converted Markdown (STR-04).

    Rule: split into lines at every Python line end, strip the right end of
    each line, keep only the first of several consecutive blank lines, join
    with ``\\n``, strip the whole text and end it with exactly one ``\\n``.

    Cost-driven form: line ends are unified by a literal replace and one
    character-class pass; the split on ``\\n`` takes Java's single-character
    fast path; ``rtrim`` per line touches only line ends; the blank-run
    collapse is a pattern that starts with a literal. (A regex that must be
    tried at every blank, such as ``\\s+$``, was four times slower.)
    """
    c = F.regexp_replace(F.replace(_c(col), F.lit("\r\n"), F.lit("\n")), OTHER_LINE_ENDS, "\n")
    lines = F.transform(F.split(c, "\n", -1), lambda x: py_rstrip(x, HS_CHARS))
    c = F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n")
    return F.concat(py_strip(c), F.lit("\n"))


def strip_only(col: Column | str) -> Column:
    """The simpler finish of the mirrored-tree converter: ``text.strip()``."""
    return py_strip(col)


def references_section(col: Column | str) -> Column:
    """From the first level-1..3 heading named references / bibliography /
    works cited to the end of the text; ``""`` when there is none (STR-05)."""
    return F.regexp_extract(_c(col), REFS, 0)


def truncate_chars(col: Column | str, limit: int) -> Column:
    """First ``limit`` characters (code points) (STR-06); the caller states the
    limit, since nothing in this library needs one."""
    return F.substring(_c(col), 1, limit)


def strip_fence(col: Column | str) -> Column:
    """Drop an accidental code fence and a leading ``json`` tag (STR-07).

    Rule: strip; if the text starts with three back-ticks keep what lies
    between the first and second fence; then drop a leading ``json``.
    """
    raw = py_strip(col)
    inner = F.split_part(raw, F.lit("```"), F.lit(2))
    tagless = F.when(F.startswith(inner, F.lit("json")), F.substring(inner, 5, 1 << 30)).otherwise(inner)
    return F.when(F.startswith(raw, F.lit("```")), tagless).otherwise(raw)


def sanitize_filename(col: Column | str) -> Column:
    """Remove the nine characters not allowed in file names, then strip (STR-09)."""
    return py_strip(F.translate(_c(col), BAD_FILENAME_CHARS, ""))


def drop_leading_number(col: Column | str) -> Column:
    """``title[3:].strip()``: the first three characters held the old number
    (STR-10). Titles numbered 100 or more keep a digit, as in the source."""
    return py_strip(F.substring(_c(col), 4, 1 << 30))


def two_digit(col: Column | str) -> Column:
    """``f"{n:02d}"`` (STR-11); wider numbers are kept whole."""
    return F.format_string("%02d", _c(col))


def placeholder_if_empty(col: Column | str, placeholder: str = "(none)") -> Column:
    """``value or "(none)"`` (STR-14)."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(placeholder))


def is_blank(col: Column | str) -> Column:
    """``not s or s.strip() == ""`` (FLT-06)."""
    c = _c(col)
    return c.isNull() | (py_strip(c) == "")
