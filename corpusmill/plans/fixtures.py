"""Derived inputs for the registered queries.

The raw tables do not exercise this domain (no folder trees, no noisy
Markdown), so each query starts from a view derived from them. Every view is
one SQL statement that runs unchanged on Spark and DuckDB; table names are
``{placeholders}`` (literal braces doubled) bound to DataFrames on Spark (no global temp views) and
to the pre-registered views or CTEs on DuckDB. The work of every view grows
with the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.sources.tables import read_table

TABLES = ("documents", "pages", "labels", "events", "conversations")


def sql_text(s: str) -> str:
    """A text as an SQL expression that Spark and DuckDB read alike."""
    parts = ["'" + line.replace("'", "', chr(39), '") + "'" for line in s.split("\n")]
    return "concat(" + ", chr(10), ".join(parts) + ")"


# Pages and the Markdown they should give, written by hand (@ is the page's number).
HOSTILE_PAGES = [
    ("<p>if a < b and c > d then @</p>", "if a < b and c > d then @\n"),
    ("one<img alt='a>b'> two @", "one two @\n"),
    ('<a title="x<y>z" href=u>link @</a> after', "link @ after\n"),
    ("kept @<script>if (a < b) document.write('<p>gone</p>')", "kept @\n"),
    ("<style>p > a { color: '</p>' }</style>text @<script>var t = 1 < 2;</script> more", "text @ more\n"),
    ("a<!-- gone > gone <b>gone</b> -->b @", "ab @\n"),
    ("a <!-- never closed @", "a <!-- never closed @\n"),
    ('<p class="open>kept @ <b>bold</b> end', "kept @ bold end\n"),
    ("<ul><li>one @<ul><li>two<ol><li>three</ol></ul><li>four</ul>", "- one @\n  - two\n    - three\n- four\n"),
    ("text<pre>  def f(@):\n      return <b>1</b> &lt; 2</pre>end", "text\n\n```\n  def f(@):\n      return 1 < 2\n```\n\nend\n"),
    ("<table><tr><th>a|b<th>c @<tr><td>d<br>e</td><td>f</table>after", "| a\\|b | c @ |\n| --- | --- |\n| d e | f |\n\nafter\n"),
    ("<table><tr><td>x<table><tr><td>in</td><td>ner</table></td><td>@</td></tr></table>", "| x in ner | @ |\n| --- | --- |\n"),
    ("<nav>never closed, so kept @<p>next", "never closed, so kept @\n\nnext\n"),
    ("<nav>a<nav>b</nav>gone</nav>kept @<footer>gone</footer>", "kept @\n"),
    ("<head><title>gone</title><body>body @ 1 <2 and 3<4", "body @ 1 <2 and 3<4\n"),
    ("&amp;lt; &amp;amp; @ &lt;b&gt; &copy &#x41;<h2 id='x>y'>Head</h2>t", "&lt; &amp; @ <b> © A\n\n## Head\n\nt\n"),
]

FX_SQL: dict[str, str] = {
    # File manifest (path, length): root image; one/three-level images; dot
    # folder; extensionless dot file; .PDF; dotted stem; PDF inside Converted;
    # dot-file image in an underscore folder; src0-x vs src0/ order; ordinary.
    "fx_manifest": """
SELECT doc_id,
       CASE doc_id % 12
         WHEN 0 THEN concat('doc_', doc_id, '.JPG')
         WHEN 1 THEN concat(source, '/doc_', doc_id, '.png')
         WHEN 2 THEN concat(source, '/', lang, '/deep/doc_', doc_id, '.jpeg')
         WHEN 3 THEN concat(source, '/.cache/doc_', doc_id, '.png')
         WHEN 4 THEN concat(source, '/', lang, '/.doc_', doc_id)
         WHEN 5 THEN concat(source, '/', lang, '/doc_', doc_id, '.PDF')
         WHEN 6 THEN concat(source, '/', lang, '/doc.', doc_id, '.pdf')
         WHEN 7 THEN concat(source, '/Converted/doc_', doc_id, '.pdf')
         WHEN 8 THEN concat('_u/', lang, '/.doc_', doc_id, '.gif')
         WHEN 9 THEN concat(source, '-x/', lang, '/doc_', doc_id, '.tar.webp')
         ELSE concat(source, '/', lang, '/doc_', doc_id, '.webp')
       END AS path,
       n_chars AS length
FROM {documents}""",
    # Remote listing (path): wanted shard, near-miss folder, upper-case
    # suffix, hidden first component, hidden inner folder, README, arrow, txt.
    "fx_shards": """
SELECT event_id,
       CASE event_id % 8
         WHEN 0 THEN concat('data/python/train-', event_id, '.parquet')
         WHEN 1 THEN concat('data/python3/train-', event_id, '.parquet')
         WHEN 2 THEN concat('data/python/train-', event_id, '.PARQUET')
         WHEN 3 THEN concat('.hidden/', event_id, '.json')
         WHEN 4 THEN concat('a/.x/', event_id, '.jsonl')
         WHEN 5 THEN concat('docs/README_', event_id, '.csv')
         WHEN 6 THEN concat('data/', event_type, '/', event_id, '.arrow')
         ELSE concat('data/python/', event_id, '.txt')
       END AS path
FROM {events}""",
    # Files already present (path, length); both limits occur exactly, one byte
    # above and one below.
    "fx_present": """
SELECT path, CAST(CASE event_id % 7 WHEN 0 THEN 99999 WHEN 1 THEN 100000 WHEN 2 THEN 100001
                                    WHEN 3 THEN 999999 WHEN 4 THEN 1000000 WHEN 5 THEN 1000001 ELSE 0 END AS BIGINT) AS length
FROM {fx_shards}
WHERE event_id % 3 = 0""",
    # Log of fetching each listed shard, one to three attempts (path, attempt,
    # outcome, error): earlier attempts failed, the last has the outcome of the
    # listing's event; a few shards have no entry.
    "fx_fetch_log": """
SELECT path, attempt,
       CASE WHEN attempt < 1 + event_id % 3 OR event_type = 'error' THEN 'fail' ELSE 'success' END AS outcome,
       CASE WHEN attempt < 1 + event_id % 3 OR event_type = 'error'
            THEN concat('attempt ', attempt, ': event ', event_id) END AS error
FROM (SELECT s.path, e.event_id, e.event_type, CAST(1 AS INT) AS attempt FROM {fx_shards} s JOIN {events} e ON s.event_id = e.event_id
      UNION ALL
      SELECT s.path, e.event_id, e.event_type, 2 FROM {fx_shards} s JOIN {events} e ON s.event_id = e.event_id WHERE e.event_id % 3 >= 1
      UNION ALL
      SELECT s.path, e.event_id, e.event_type, 3 FROM {fx_shards} s JOIN {events} e ON s.event_id = e.event_id WHERE e.event_id % 3 = 2) a
WHERE event_id % 16 <> 8""",
    # Finished outputs (path).
    "fx_outputs": """
SELECT path FROM {fx_manifest} WHERE doc_id IN (SELECT doc_id FROM {labels} WHERE quality = 1)""",
    # Flat form of the catalogue (category, pos, title, url): one category per
    # document with one to three entries; see catalogue_nested.
    "fx_catalogue": """
SELECT concat('I. ', source, ': "', lang, '" ', doc_id) AS category, CAST(1 AS INT) AS pos,
       concat('01 ', lang, ' ', doc_id, '?: "a/b" <x>|* ') AS title, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN NULL ELSE concat('https://example.org/pdf/', doc_id, '.pdf') END AS url
FROM {documents}
UNION ALL
SELECT concat('I. ', source, ': "', lang, '" ', doc_id) AS category, CAST(2 AS INT) AS pos,
       concat('02 ', lang, ' ', doc_id, '?: "a/b" <x>|* ') AS title, concat('https://example.org/pdf/', doc_id, '-2.pdf') AS url
FROM {documents} WHERE doc_id % 3 >= 1
UNION ALL
SELECT concat('I. ', source, ': "', lang, '" ', doc_id) AS category, CAST(3 AS INT) AS pos,
       concat('03 ', lang, ' ', doc_id, '?: "a/b" <x>|* ') AS title, '' AS url
FROM {documents} WHERE doc_id % 3 = 2""",
    # Noisy Markdown (doc_id, text): blank runs and CR; references with an
    # appendix; level-4 heading; lower case with trailing blanks; numbered,
    # list-marked and author-year entries; inline heading then '##Works Cited'
    # before '## References'.
    "fx_noisy_text": """
SELECT doc_id,
       CASE doc_id % 8
         WHEN 0 THEN concat('  ', replace(text, '. ', concat('.  ', chr(13), chr(10), chr(10), chr(10), ' ', chr(10))), chr(10), chr(10))
         WHEN 1 THEN concat(text, chr(10), '## References', chr(10), '[1] A. Author and B. Writer. A title ', doc_id, '. Venue, 20', lpad(CAST(doc_id % 25 AS VARCHAR(9)), 2, '0'), '. 10.1234/x', doc_id, chr(10), '[Smith2020] Smith. Other. Press.', chr(10), '# Appendix')
         WHEN 2 THEN concat(text, chr(13), chr(10), '#### References', chr(10), 'x')
         WHEN 3 THEN concat(text, chr(160), chr(10), '# bibliography  ', chr(10), chr(10), chr(10), '[2] B')
         WHEN 4 THEN concat(text, chr(10), '## References', chr(10), '1. A. Author. First ', doc_id, '. Press, 2001.', chr(10), 'continued', chr(10), '2) B. Writer and C. Third. Second. Venue. 10.1234/y', doc_id)
         WHEN 5 THEN concat(text, chr(10), '# Bibliography', chr(10), '- A. Author. Listed ', doc_id, '. Press.', chr(10), '* B. Writer. Other. Venue, 1999.', chr(10), '  wrapped')
         WHEN 6 THEN concat(text, chr(10), '### Works Cited', chr(10), 'Smith, J. and Lee, K. 2020. Work ', doc_id, '. Press.', chr(10), chr(10), 'Doe-Roe, A. Old work. Venue, 1987.')
         ELSE concat(text, chr(10), 'a ## References', chr(10), '##Works Cited', chr(10), '## References')
       END AS text
FROM {documents}""",
    # References of mixed forms (page_id, refs), see MIXED_CITATIONS for what
    # each holds: copies' descriptions in brackets; a number, then names;
    # wrapped names; every form; a year that opens a line; a higher heading;
    # brackets that are no keys; no entry at all.
    "fx_mixed_refs": """
SELECT page_id, concat('## References', chr(10), CASE page_id % 8
         WHEN 0 THEN concat(chr(10), '1. A. Author and B. Writer. First ', page_id, '. Journal, 2019.', chr(10), '[Online]. Available: https://example.org/a', chr(10),
                            '2. C. Third. Second. Venue, 2020.', chr(10), '[Online]. Available: https://example.org/b', chr(10), '3. D. Fourth. Third. Press, 2021.', chr(10), '[PDF] https://example.org/c.pdf')
         WHEN 1 THEN concat('1. A. Author. Numbered ', page_id, '. Press, 2001.', chr(10), 'Smith, J. 2020. Dated. Press.', chr(10), 'Doe-Roe, A. 1987. Old work. Venue.')
         WHEN 2 THEN concat('Smith, J. 2018. A long title', chr(10), '    that wraps ', page_id, '. Press.', chr(10), 'Doe, A. 2019. Other. Venue,', chr(10), '    Cambridge, MA.')
         WHEN 3 THEN concat(chr(10), '[Knu97] D. Knuth. The art ', page_id, '. Press, 1997.', chr(10), chr(10), '- [2] B. Writer. Second. Venue, 2002.', chr(10), '  [PDF] https://example.org/x.pdf', chr(10), chr(10),
                            '3) C. Third. Numbered. Press, 2003.', chr(10), '* D. Fourth. Listed. Press, 2004. 10.1234/z', page_id)
         WHEN 4 THEN concat('7. A. Author. Wrapped ', page_id, '. Journal of Things, volume', chr(10), '2019. Springer.', chr(10), '8. B. Writer. Next. Press, 2020.')
         WHEN 5 THEN concat('[1] A. Author. One ', page_id, '. Press, 2005.', chr(10), chr(10), 'Notes of the editor.', chr(10), '### Books', chr(10), '[2] B. Writer. Two. Press, 2006.', chr(10), '# Appendix', chr(10), '1. Not a citation. 2000.')
         WHEN 6 THEN concat('[1] A. Author. First ', page_id, '. Press, 2001.', chr(10), '[Online] https://example.org/1', chr(10), '[2] B. Writer. Second. Press, 2002.', chr(10), '[Accessed 3 May 2004]', chr(10),
                            '[3](https://example.org) is a link.', chr(10), '[3] C. Third. Last. Press, 2003.')
         ELSE concat('None of these lines is an entry.', chr(10), 'Nor this.') END) AS refs
FROM {pages}""",
    # Pages that break simple rules (page_id, html), one kind each, with the
    # page's number in the text: see HOSTILE_PAGES.
    "fx_hostile_pages": "SELECT page_id, replace(html, '@', CAST(page_id AS VARCHAR(20))) AS html FROM (SELECT page_id, CASE page_id % 16\n"
                        + "\n".join(f"WHEN {k} THEN " + sql_text(html).replace("{", "{{").replace("}", "}}") for k, (html, _) in enumerate(HOSTILE_PAGES))
                        + " END AS html FROM {pages}) p",
    # All pages, and documents (numbered below zero) that take a converter down:
    # one ends its process, one never returns, one takes all memory.
    "fx_fatal_pages": """
SELECT page_id, html FROM {pages}
UNION ALL
SELECT -1 - page_id AS page_id, CASE page_id % 100 WHEN 1 THEN 'exit' WHEN 2 THEN 'sleep' ELSE 'hog' END AS html
FROM {pages} WHERE page_id % 100 BETWEEN 1 AND 3""",
    # Model answers (conv_id, turn, response): JSON, fenced with tag, empty
    # list, prose, fenced without tag, empty; then answers that are no list of
    # citations: text after the list, two lists, a null element, a second key,
    # authors that are no list; last, a null field and a number.
    "fx_responses": """
SELECT conv_id, turn,
       CASE (conv_id * 8 + turn) % 12
         WHEN 0 THEN concat('[{{"id":"[', turn, ']","authors":["A","B"],"year":"2020","title":"T', conv_id, '","venue":"","doi":""}}]')
         WHEN 1 THEN concat('```json', chr(10), '[{{"id":"[', turn, ']","authors":[],"year":"","title":"T","venue":"V","doi":"10.1/x"}}]', chr(10), '```')
         WHEN 2 THEN '[]'
         WHEN 3 THEN concat('Sorry, ', role)
         WHEN 4 THEN '```[{{"id":"k"}}]```'
         WHEN 5 THEN '[{{"id":"a"}}] x ]'
         WHEN 6 THEN '[{{"id":"a"}}][{{"id":"b"}}]'
         WHEN 7 THEN '[null]'
         WHEN 8 THEN '[1],"x":[2]'
         WHEN 9 THEN '[{{"id":"a","authors":"A. Author"}}]'
         WHEN 10 THEN '[{{"id":null,"authors":["A"],"year":2020,"title":"T"}},{{}}]'
         ELSE ''
       END AS response
FROM {conversations}""",
}

# Which views each view reads (in creation order).
FX_DEPS: dict[str, tuple[str, ...]] = {
    "fx_manifest": ("documents",),
    "fx_shards": ("events",),
    "fx_present": ("fx_shards",),
    "fx_fetch_log": ("fx_shards", "events"),
    "fx_outputs": ("fx_manifest", "labels"),
    "fx_catalogue": ("documents",),
    "fx_noisy_text": ("documents",),
    "fx_mixed_refs": ("pages",),
    "fx_hostile_pages": ("pages",),
    "fx_fatal_pages": ("pages",),
    "fx_responses": ("conversations",),
}

# The citations of fx_mixed_refs, written by hand: case, position, id, authors, how many, year, title (@ is the
# page's number), venue, doi.
MIXED_CITATIONS = [
    (0, 1, "[1]", "A. Author; B. Writer", 2, "2019", "First @", "Journal", ""),
    (0, 2, "[2]", "C. Third", 1, "2020", "Second", "Venue", ""),
    (0, 3, "[3]", "D. Fourth", 1, "2021", "Third", "Press", ""),
    (1, 1, "[1]", "A. Author", 1, "2001", "Numbered @", "Press", ""),
    (1, 2, "[Smith 2020]", "Smith; J. 2020", 2, "2020", "Dated", "Press", ""),
    (1, 3, "[Doe-Roe 1987]", "Doe-Roe; A. 1987", 2, "1987", "Old work", "Venue", ""),
    (2, 1, "[Smith 2018]", "Smith; J. 2018", 2, "2018", "A long title that wraps @", "Press", ""),
    (2, 2, "[Doe 2019]", "Doe; A. 2019", 2, "2019", "Other", "Venue, Cambridge, MA", ""),
    (3, 1, "[Knu97]", "D. Knuth", 1, "1997", "The art @", "Press", ""),
    (3, 2, "[2]", "B. Writer", 1, "2002", "Second", "Venue", ""),
    (3, 3, "[3]", "C. Third", 1, "2003", "Numbered", "Press", ""),
    (3, 4, "", "D. Fourth", 1, "2004", "Listed", "Press", "10.1234/z@"),
    (4, 1, "[7]", "A. Author", 1, "2019", "Wrapped @", "Journal of Things, volume", ""),
    (4, 2, "[8]", "B. Writer", 1, "2020", "Next", "Press", ""),
    (5, 1, "[1]", "A. Author", 1, "2005", "One @", "Press", ""),
    (5, 2, "[2]", "B. Writer", 1, "2006", "Two", "Press", ""),
    (6, 1, "[1]", "A. Author", 1, "2001", "First @", "Press", ""),
    (6, 2, "[2]", "B. Writer", 1, "2002", "Second", "Press", ""),
    (6, 3, "[3]", "C. Third", 1, "2003", "Last", "Press", ""),
]


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables. The given tables are read-only, so a
    session reuses one DataFrame per table (one listing and footer read)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _TABLES:
        _TABLES[key] = read_table(spark, sf_dir, name)
    return _TABLES[key]


_FIXTURES: dict[tuple, DataFrame] = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame (Spark SQL with DataFrame parameters).
    Deterministic over read-only tables, so a session builds each plan once."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _FIXTURES:
        args = {}
        for dep in FX_DEPS[name]:
            args[dep] = (fixture(spark, sf_dir, dep) if dep in FX_SQL
                         else table(spark, sf_dir, dep))
        _FIXTURES[key] = spark.sql(FX_SQL[name], **args)
    return _FIXTURES[key]


def duckdb_ctes(*names: str) -> str:
    """``WITH`` clause defining the named views (and what they read) for DuckDB."""
    ordered: list[str] = []

    def visit(n: str) -> None:
        for dep in FX_DEPS[n]:
            if dep in FX_SQL:
                visit(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in ordered:
        body = FX_SQL[n].format(**{d: d for d in FX_DEPS[n]})
        parts.append(f"{n} AS ({body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"


def catalogue_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue in its nested form (category, papers): the list position
    is the entry's number. Built row by row from ``documents``."""
    from pyspark.sql import functions as F

    doc, lang = F.col("doc_id"), F.col("lang")
    pdf = F.concat(F.lit("https://example.org/pdf/"), doc, F.lit(".pdf"))
    urls = [F.when(doc % 7 == 0, "").when(doc % 7 == 1, "  ").when(doc % 7 > 2, pdf),
            F.concat(F.lit("https://example.org/pdf/"), doc, F.lit("-2.pdf")), F.lit("")]
    papers = [F.struct(F.concat(F.lit(f"0{n + 1} "), lang, F.lit(" "), doc, F.lit('?: "a/b" <x>|* ')).alias("title"),
                       url.alias("url")) for n, url in enumerate(urls)]
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("I. "), "source", F.lit(': "'), lang, F.lit('" '), doc).alias("category"),
        F.slice(F.array(*papers), F.lit(1), (1 + doc % 3).cast("int")).alias("papers"))


def fixture_tree(spark: SparkSession, sf_dir: str) -> str:
    """A real folder tree: ``documents`` written as a table partitioned by
    source and language below the shared checkpoint folder, a folder per value
    and a few files in each however many rows there are. Returns the root."""
    from corpusmill.session import work_path

    root = work_path(spark, "tree")
    table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source", "lang") \
        .write.partitionBy("source", "lang").parquet(root)
    return root
