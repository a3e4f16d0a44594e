"""HTML → Markdown with column functions: nothing leaves the JVM.

1. Tokenizer: the page is split at every ``<``; a fold over the pieces carries
   the tokenizer's state (text, an unfinished tag, a quoted attribute value, a
   comment, raw text), so a ``>`` inside quotes ends no tag, and a ``<`` that opens
   none is text. The content of ``script`` and ``style`` is raw text and goes, closed
   or not. A quote, a comment or a ``<`` that nothing later in the page closes is
   taken as ordinary, so nothing after it is lost.
2. Structure: a fold over the tags carries what is open. ``head``, ``nav`` and
   ``footer`` go with their content (if the page closes them). Headings become
   ``#`` .. ``######`` lines, list items ``- `` lines, two blanks deeper per list
   around them, ``br`` a line break, ``p`` a blank line, ``pre`` a fenced block with its
   lines. Table rows become pipe rows with a delimiter row after each table's
   first row; a cell is one line and its ``|`` is escaped; a table inside a cell
   is text of that cell. Every other tag is removed, its text kept (images
   vanish: no graphics).
3. Character references are decoded once: the five commonest by replacement,
   then numbers, all names of HTML5, and the names it accepts without the
   final ``;``.
4. The finish: ``clean`` (line clean-up) or ``strip``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions.folds import fold_text, let

# --- Rules of this converter -------------------------------------------------------------
RAW = ("script", "style")
# Elements that go with their content, and the tags that end them.
DROPPED = {"head": ("/head", "body"), "nav": ("/nav",), "footer": ("/footer",)}
# Tags that more than the removal of the tag depends on.
STRUCTURE = sorted({f"{end}{name}" for name in ("p", "br", "li", "ul", "ol", "pre", "table", "tr", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6",
                                                 "body", *DROPPED) for end in ("", "/")})
# Attributes up to the end of a tag or to a quote that stays open; no step goes back.
_ATTRIBUTES = r"(?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=(?!\s*+[\"']))*+"
_NAME = r"\A/?([A-Za-z][^\s/>]*+)"
_TAG = r"(?s)" + _NAME + _ATTRIBUTES + ">"
_OPEN_QUOTE = r"(?s)" + _NAME + _ATTRIBUTES + r"=\s*+([\"'])"
_TAIL = r"(?s)\A" + _ATTRIBUTES + ">"
_TAIL_QUOTE = r"(?s)\A" + _ATTRIBUTES + r"=\s*+([\"'])"
# --- end of converter rules --------------------------------------------------------


def _pieces(html: Column) -> Column:
    """What each piece after a ``<`` is if it is reached in text."""
    def one(p: Column) -> Column:
        name = F.lower(F.regexp_extract(p, _NAME, 1))
        kind = F.when(name != "", "tag").when(F.startswith(p, F.lit("!--")), "comment") \
            .when(F.regexp_like(p, F.lit(r"\A[!?/]")), "bogus").otherwise("text")
        gt, end = F.locate(">", p), F.locate("-->", p)
        length = F.when(name != "", F.char_length(F.regexp_extract(p, _TAG, 0))) \
            .when(F.startswith(p, F.lit("!--")), F.when(end > 0, end + 2).otherwise(0)).otherwise(gt)
        return F.struct(p.alias("p"), name.alias("name"), F.startswith(p, F.lit("/")).alias("closing"), kind.alias("kind"), length.alias("length"),
                        gt.alias("gt"), (end > 0).cast("int").alias("ends"), F.contains(p, F.lit('"')).cast("int").alias("double"),
                        F.contains(p, F.lit("'")).cast("int").alias("single"))
    return F.transform(html, one)


def _reached(s: Column, x: Column) -> Column:
    """For piece ``x`` in state ``s``: where its text starts (0: it is text with
    its ``<``), the mode after it, and whether a tag begins here."""
    p, later = x["p"], {k: s[k] - x[k] for k in ("ends", "double", "single")}
    gts = s["gts"] - (x["gt"] > 0).cast("int")

    nothing, yes, no = F.char_length(p) + 1, F.lit(True), F.lit(False)

    def found(at: Column, mode: Column | str, tag: Column) -> Column:
        return F.struct(at.alias("at"), (F.lit(mode) if isinstance(mode, str) else mode).alias("mode"), tag.alias("tag"))

    def ended(at: Column, mode: Column, tag: Column) -> Column:
        """A tag ends before ``at``; after the tag of a raw element comes no text."""
        return found(F.when(mode == "text", at).otherwise(nothing), mode, tag)

    def closes(quote: Column) -> Column:
        return F.when(quote == '"', later["double"] > 0).when(quote == "'", later["single"] > 0).otherwise(F.lit(False))

    after = F.when(x["name"].isin(*RAW) & ~x["closing"], F.concat(F.lit("raw "), x["name"])).otherwise("text")
    quote = F.regexp_extract(p, _OPEN_QUOTE, 2)
    unfinished = F.when(closes(quote), found(nothing, F.concat(F.lit("quote "), quote), yes)) \
        .when(x["gt"] > 0, ended(x["gt"] + 1, after, yes)) \
        .when(gts > 0, found(nothing, "tag", yes)).otherwise(found(F.lit(0), "text", no))
    in_text = F.when(x["kind"] == "text", found(F.lit(0), "text", no)) \
        .when(x["length"] > 0, ended(x["length"] + 1, F.when(x["kind"] == "tag", after).otherwise("text"), x["kind"] == "tag")) \
        .when(x["kind"] == "tag", unfinished) \
        .when((x["kind"] == "comment") & (later["ends"] > 0), found(nothing, "comment", no)) \
        .when(x["gt"] > 0, found(x["gt"] + 1, "text", no)) \
        .when(gts > 0, found(nothing, "bogus", no)).otherwise(found(F.lit(0), "text", no))

    def in_tag(rest: Column) -> Column:
        """``rest`` goes on inside a tag, after ``p`` without it."""
        passed, tail = F.char_length(p) - F.char_length(rest), F.char_length(F.regexp_extract(rest, _TAIL, 0))
        open_quote = F.regexp_extract(rest, _TAIL_QUOTE, 1)
        return F.when(tail > 0, ended(passed + tail + 1, s["next"], no)) \
            .when(closes(open_quote), found(nothing, F.concat(F.lit("quote "), open_quote), no)) \
            .when(F.locate(">", rest) > 0, ended(passed + F.locate(">", rest) + 1, s["next"], no)).otherwise(found(nothing, "tag", no))

    mark = F.right(s["mode"], F.lit(1))
    at = F.position(mark, p)
    quoted = F.when(at > 0, let(F.substr(p, at + 1), in_tag)).otherwise(found(nothing, s["mode"], no))
    raw = F.when((x["kind"] == "tag") & x["closing"] & (F.concat(F.lit("raw "), x["name"]) == s["mode"]), in_text) \
        .otherwise(found(nothing, s["mode"], no))
    plain = (s["mode"] == "text") & (x["length"] > 0) & (x["kind"] == "tag") & ~x["name"].isin(*RAW)
    return F.when(plain, found(x["length"] + 1, "text", yes)).when(s["mode"] == "text", in_text).when(F.startswith(s["mode"], F.lit("raw ")), raw) \
        .when(F.startswith(s["mode"], F.lit("quote ")), quoted).when(s["mode"] == "tag", in_tag(p)) \
        .when(s["mode"] == "comment", F.when(x["ends"] > 0, found(F.locate("-->", p) + 3, "text", no)).otherwise(found(nothing, "comment", no))) \
        .otherwise(F.when(x["gt"] > 0, found(x["gt"] + 1, "text", no)).otherwise(found(nothing, "bogus", no)))


def tags(html: Column) -> Column:
    """The page as an array of (name, text after it): names as in ``p`` or
    ``/p``, empty for text without a tag before it."""
    split = F.split(html, "<", -1)
    first = F.struct(F.lit("").alias("name"), split[0].alias("text"))

    def tokenized(pieces: Column) -> Column:
        def total(of) -> Column:
            return F.aggregate(pieces, F.lit(0), lambda n, x: n + of(x))
        start = F.struct(F.lit("text").alias("mode"), F.lit("text").alias("next"), total(lambda x: x["ends"]).alias("ends"),
                         total(lambda x: x["double"]).alias("double"), total(lambda x: x["single"]).alias("single"),
                         total(lambda x: (x["gt"] > 0).cast("int")).alias("gts"))

        def step(s: Column, x: Column):
            raw = F.when(x["name"].isin(*RAW) & ~x["closing"], F.concat(F.lit("raw "), x["name"])).otherwise("text")
            return (_reached(s, x), lambda v: F.struct(
                v["mode"].alias("mode"), F.when(v["tag"], raw).otherwise(s["next"]).alias("next"), (s["ends"] - x["ends"]).alias("ends"),
                (s["double"] - x["double"]).alias("double"), (s["single"] - x["single"]).alias("single"),
                (s["gts"] - (x["gt"] > 0).cast("int")).alias("gts")),
                lambda v: F.concat(v["at"].cast("string"), F.when(v["tag"], "+ ").otherwise(" ")))

        def token(x: Column, code: Column) -> Column:
            tag, at = F.endswith(code, F.lit("+")), F.translate(code, "+", "").cast("int")
            name = F.when(tag, F.concat(F.when(x["closing"], "/").otherwise(""), x["name"])).otherwise("")
            text = F.when(at == 0, F.concat(F.lit("<"), x["p"])).otherwise(F.substr(x["p"], at))
            return F.struct(name.alias("name"), text.alias("text"))

        codes = F.split(F.rtrim(fold_text(pieces, start, step)), " ")
        return F.when(F.size(pieces) > 0, F.zip_with(pieces, codes, token)).otherwise(F.array().cast("array<struct<name:string,text:string>>"))

    rest = F.slice(split, 2, F.greatest(F.size(split) - 1, F.lit(0)))
    return F.concat(F.array(first), let(_pieces(rest), tokenized))


def _render(s: Column, x: Column):
    """Markdown of a tag and the text after it, and the state after it."""
    name = x["name"]
    opens = F.coalesce(*[F.when((name == k) & (s[f"left_{k}"] > 0), k) for k in DROPPED], F.lit(""))
    ends = F.coalesce(*[F.when((s["drop"] == k) & name.isin(*tags), True) for k, tags in DROPPED.items()], F.lit(False))
    depth = F.when(s["drop"] == "", F.when(opens != "", 1).otherwise(0)) \
        .otherwise(F.when(s["drop"] == "head", F.when(ends, 0).otherwise(1))
                   .otherwise(s["depth"] + (name == s["drop"]).cast("int") - ends.cast("int")))
    gone = (s["drop"] != "") | (opens != "")
    inner, cell = s["tables"] > 1, s["cell"]
    heading = F.regexp_extract(name, r"\A(/?)h([1-6])\z", 2)
    breaks = F.when(name == "br", "\n").when(name.isin("p", "/p"), "\n\n") \
        .when(heading != "", F.when(F.startswith(name, F.lit("/")), "\n\n").otherwise(F.concat(F.lit("\n\n"), F.repeat(F.lit("#"), heading.cast("int")), F.lit(" ")))) \
        .when(name == "li", F.concat(F.lit("\n"), F.repeat(F.lit("  "), F.greatest(s["lists"] - 1, F.lit(0))), F.lit("- "))) \
        .when((name == "pre") & (s["pre"] == 0), "\n\n```\n").when((name == "/pre") & (s["pre"] == 1), "\n```\n\n")
    close = F.when(cell, " |").otherwise("")
    rule = F.when((s["rows"] == 1) & (s["cells"] > 0), F.concat(F.lit("\n|"), F.repeat(F.lit(" --- |"), s["cells"]))).otherwise("")
    row_ends = name.isin("tr", "/tr", "/table", "table")
    table = F.when(name == "tr", F.concat(close, rule, F.lit("\n|"))).when(name.isin("td", "th"), F.concat(close, F.lit(" "))) \
        .when(name.isin("/td", "/th"), close).when(name == "/tr", F.concat(close, rule)) \
        .when(name == "/table", F.concat(close, rule, F.lit("\n\n")))
    mark = F.when(gone, "").when(inner | (cell & breaks.isNotNull()), F.when(breaks.isNotNull() | name.isin("td", "th"), " ").otherwise("")) \
        .when(table.isNotNull(), table).otherwise(F.coalesce(breaks, F.lit("")))
    opened = name.isin("td", "th") & ~inner
    in_cell = F.when(gone, cell).when(inner, cell).when(opened, True).when(name.isin("/td", "/th") | row_ends & (name != "table"), False).otherwise(cell)
    text = F.when(gone & (depth > 0), "").when(in_cell, F.replace(F.translate(x["text"], "\r\n", "  "), F.lit("|"), F.lit("\\|"))) \
        .otherwise(x["text"])

    def after(v: Column) -> Column:
        def kept(new: Column, old: str) -> Column:
            return F.when(gone, s[old]).otherwise(new).alias(old)
        new_rows = F.when(inner, s["rows"]).when((name == "table") & (s["tables"] == 0), 0).when(name == "tr", s["rows"] + 1) \
            .when(name == "/tr", F.when(s["rows"] == 1, 2).otherwise(s["rows"])).when(name == "/table", 0).otherwise(s["rows"])
        new_cells = F.when(s["tables"] > (name != "table").cast("int"), s["cells"]).when(name.isin("table", "tr"), 0).when(opened, s["cells"] + 1) \
            .when(row_ends, 0).otherwise(s["cells"])
        return F.struct(
            F.when(depth > 0, F.when(s["drop"] == "", opens).otherwise(s["drop"])).otherwise("").alias("drop"), depth.alias("depth"),
            *[(s[f"left_{k}"] - name.isin(*tags).cast("int")).alias(f"left_{k}") for k, tags in DROPPED.items()],
            kept(F.greatest(s["lists"] + F.when(name.isin("ul", "ol"), 1).when(name.isin("/ul", "/ol"), -1).otherwise(0), F.lit(0)), "lists"),
            kept(F.greatest(s["pre"] + F.when(name == "pre", 1).when(name == "/pre", -1).otherwise(0), F.lit(0)), "pre"),
            kept(F.greatest(s["tables"] + F.when(name == "table", 1).when(name == "/table", -1).otherwise(0), F.lit(0)), "tables"),
            in_cell.alias("cell"), kept(new_rows, "rows"), kept(new_cells, "cells"))

    inline = ~name.isin(*STRUCTURE)  # changes nothing but the text
    return (F.when(inline & (s["drop"] == "") & ~cell, x["text"]).otherwise(F.concat(mark, text)),
            lambda v: F.when(inline, s).otherwise(after(v)), lambda v: v)


def tags_to_text(col: Column | str) -> Column:
    """Steps 1 and 2: the Markdown, character references still encoded."""
    html = F.col(col) if isinstance(col, str) else col

    def rendered(t: Column) -> Column:
        def total(names) -> Column:
            return F.aggregate(t, F.lit(0), lambda n, x: n + x["name"].isin(*names).cast("int"))
        zero = {k: F.lit(0) for k in ("lists", "pre", "tables")}
        start = F.struct(F.lit("").alias("drop"), F.lit(0).alias("depth"), *[total(v).alias(f"left_{k}") for k, v in DROPPED.items()],
                         *[v.alias(k) for k, v in zero.items()], F.lit(False).alias("cell"), F.lit(0).alias("rows"), F.lit(0).alias("cells"))
        return fold_text(t, start, _render)

    return let(tags(html), rendered)


def finish_text(c: Column, finish: str = "clean") -> Column:
    """Rule 7."""
    if finish == "clean":
        return T.clean_markdown(c)
    if finish == "strip":
        return T.strip_only(c)
    raise ValueError("finish must be 'clean' or 'strip'")


def html_to_markdown(col: Column | str, finish: str = "clean") -> Column:
    """Markdown text of an HTML column (JOB-05) as one expression. Inside a
    DataFrame job prefer ``convert.convert_html``, which evaluates the tag
    rules once per row before decoding entities."""
    return let(tags_to_text(col), lambda t: finish_text(decode_entities(t), finish))


def _reference_tables() -> tuple[dict[str, str], list[str], dict[str, str]]:
    """Named references with ``;``, names that need none (longest first), and
    what the numbers 128 to 159 stand for: from the standard library's tables
    of HTML5 and of Windows-1252."""
    from html.entities import html5

    low = {str(n): bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}
    return ({k: v for k, v in html5.items() if k.endswith(";")},
            sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k)), low)


def _map(values: dict[str, str]) -> Column:
    """A constant map (parsed once, when the plan is optimised)."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,string>")


def decode_entities(c: Column) -> Column:
    """Character references, each decoded once (``&amp;lt;`` → ``&lt;``):
    decimal and hexadecimal ones, all named ones, and those HTML5 accepts
    without the final ``;``. Texts without ``&`` skip the work."""
    named, bare, low = _reference_tables()
    names, numbers = _map(named | {n: named[n + ";"] for n in bare}), _map(low)

    def one(x: Column, i: Column) -> Column:
        digits = F.regexp_extract(x, r"\A#([0-9]{1,7}(?![0-9])|[xX][0-9a-fA-F]{1,6}(?![0-9a-fA-F]));?", 1)
        taken = F.length(F.regexp_extract(x, r"\A#(?:[0-9]{1,7}(?![0-9])|[xX][0-9a-fA-F]{1,6}(?![0-9a-fA-F]));?", 0))
        code = F.when(F.lower(F.substring(digits, 1, 1)) == "x", F.conv(F.substring(digits, 2, 6), 16, 10)) \
                .otherwise(digits).cast("int")
        legal = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.coalesce(F.try_element_at(numbers, code.cast("string")),
                          F.decode(F.unhex(F.lpad(F.hex(F.when(legal, code)), 8, "0")), "UTF-32"), F.lit("\ufffd"))
        name = F.regexp_extract(x, r"\A[A-Za-z][A-Za-z0-9]{0,31};", 0)
        short = F.regexp_extract(x, r"\A(?:" + "|".join(bare) + ")", 0)
        hit = F.when(F.try_element_at(names, name).isNotNull(), name).otherwise(short)
        return F.when(i == 0, x).when(digits != "", F.concat(char, F.substr(x, taken + 1))) \
                .when(hit != "", F.concat(F.try_element_at(names, hit), F.substr(x, F.length(hit) + 1))) \
                .otherwise(F.concat(F.lit("&"), x))

    def rest(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "&", -1), one), "")).otherwise(t)

    def common(t: Column) -> Column:
        for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", _AMPERSAND)):
            t = F.replace(t, F.lit(name), F.lit(char))
        return t

    quick = let(common(c), lambda t: F.replace(rest(t), F.lit(_AMPERSAND), F.lit("&")))
    return F.when(F.contains(c, F.lit("&")), F.when(F.contains(c, F.lit(_AMPERSAND)), rest(c)).otherwise(quick)).otherwise(c)


#: Stands for a decoded ``&`` while the rest is decoded (texts that hold it are decoded in one go).
_AMPERSAND = "\ue000"


def is_complete(col: Column | str) -> Column:
    """The document closes its ``html`` element (not cut off in transfer)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_like(c, F.lit(r"(?i)</html\s*>"))
