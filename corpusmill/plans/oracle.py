"""DuckDB statements that state each registered query's rule independently.

Written from the rule, not from the Spark plan: the summaries are a total
``UNION ALL`` one ``GROUP BY`` per label (Spark uses one GROUPING SETS pass),
positions are ``row_number()`` over the whole table (Spark numbers range
partitions), the extension rule strips leading dots and takes the last
suffix (Spark uses one regex), and so on. Tables ``documents pages labels
events conversations`` are the pre-registered views; derived views are CTEs.
"""

from __future__ import annotations

from corpusmill.fixed import IMAGE_EXTENSIONS
from corpusmill.plans.fixtures import HOSTILE_PAGES, MIXED_CITATIONS, duckdb_ctes, sql_text

ORACLE: dict[str, str] = {}

IMAGE_EXTS = str(IMAGE_EXTENSIONS)

# file name, folders, extension (leading dots are not an extension)
_FILES = """,
m AS (SELECT path, length, string_split(path, '/') AS parts FROM fx_manifest),
f AS (SELECT path, length, parts, parts[-1] AS fname, parts[1:len(parts) - 1] AS dirs FROM m),
fe AS (SELECT *, CASE WHEN contains(ltrim(fname, '.'), '.')
                      THEN regexp_extract(ltrim(fname, '.'), '\\.[^.]*$', 0) ELSE '' END AS ext FROM f),
img AS (SELECT * FROM fe
        WHERE lower(ext) IN """ + IMAGE_EXTS + """
          AND len(list_filter(dirs, lambda x: starts_with(x, '.'))) = 0)
"""

_ROWS3 = """,
rows3 AS (SELECT fname AS filename, path, coalesce(dirs[1], '') AS level_1,
                 coalesce(dirs[2], '') AS level_2, coalesce(dirs[3], '') AS level_3, parts FROM img)
"""

_TREE_KEY = "list_transform(parts, lambda x, i: {'d': if(i < len(parts), 1, 0), 'n': x})"


def _with(*fx: str) -> str:
    return duckdb_ctes(*fx).rstrip("\n")


def _summary(src: str, headers: list[str], sep: str, none: bool) -> str:
    parts = [f"SELECT 0 AS pos, CAST(NULL AS VARCHAR) AS header, CAST(NULL AS VARCHAR) AS value, "
             f"'Total images' AS breakdown, count(*) AS n FROM {src}"]
    for i, h in enumerate(headers, start=1):
        v = f"coalesce(nullif({h}, ''), '(none)')" if none else h
        parts.append(f"SELECT {i} AS pos, '{h}' AS header, v AS value, '{h}{sep}' || v AS breakdown, "
                     f"count(*) AS n FROM (SELECT {v} AS v FROM {src}) GROUP BY v")
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- labels --

ORACLE["rows_images"] = _with("fx_manifest") + _FILES + """
SELECT fname AS filename, path, coalesce(dirs[1], '') AS level_1,
       coalesce(dirs[2], '') AS level_2, coalesce(dirs[3], '') AS level_3
FROM img"""

ORACLE["rows_exact_depth"] = _with("fx_manifest") + _FILES + """
SELECT fname AS image_name, path AS relative_path, dirs[1] AS license_type, dirs[2] AS crop_type
FROM f WHERE len(dirs) = 2"""

ORACLE["label_columns"] = _with("fx_manifest") + _FILES + """
SELECT fname AS image, coalesce(dirs[1], '') AS source, coalesce(dirs[3], '') AS detail
FROM img"""

ORACLE["label_summary"] = _with("fx_manifest") + _FILES + _ROWS3 + "\n" + _summary(
    "rows3", ["level_1", "level_2", "level_3"], "  =  ", True)

ORACLE["label_summary_spec"] = _with("fx_manifest") + _FILES + """,
rows_e AS (SELECT coalesce(dirs[1], '') AS source, coalesce(dirs[3], '') AS detail FROM img)
""" + _summary("rows_e", ["source", "detail"], "  =  ", True)

ORACLE["max_depth"] = _with("fx_manifest") + _FILES + """
SELECT CAST(coalesce(max(len(dirs)), 0) AS INTEGER) AS max_depth FROM img"""

ORACLE["sample_tree"] = _with("fx_manifest") + _FILES + """
SELECT folder, CAST(depth AS INTEGER) AS depth, CAST(count(*) AS INTEGER) AS n_images,
       string_agg(fname, ', ' ORDER BY fname) AS images
FROM (SELECT array_to_string(dirs, '/') AS folder, len(dirs) AS depth, fname,
             row_number() OVER (PARTITION BY array_to_string(dirs, '/') ORDER BY fname) AS rn
      FROM img)
WHERE rn <= 3
GROUP BY folder, depth"""

ORACLE["column_widths"] = _with("fx_manifest") + _FILES + _ROWS3 + "\n" + "\nUNION ALL\n".join(
    f"SELECT {i} AS pos, '{h}' AS header, CAST(least(greatest({len(h)}, "
    f"coalesce(max(length(nullif({h}, ''))), 0)) + 4, 60) AS INTEGER) AS width FROM rows3"
    for i, h in enumerate(["filename", "path", "level_1", "level_2", "level_3"]))

ORACLE["discover_structure"] = _with("fx_manifest") + _FILES + """,
d AS (SELECT coalesce(max(len(dirs)), 0) AS m FROM img),
slots AS (SELECT 0 AS pos, 'filename' AS slot
          UNION ALL SELECT 1, 'path'
          UNION ALL SELECT CAST(i + 1 AS INTEGER), 'level_' || i FROM (SELECT unnest(range(1, m + 1)) AS i FROM d))
SELECT pos, slot, slot AS header, true AS enabled FROM slots"""

ORACLE["label_dataset"] = ORACLE["label_summary"]

ORACLE["label_dataset_fixed"] = _with("fx_manifest") + _FILES + """,
fx AS (SELECT dirs[1] AS license_type, dirs[2] AS crop_type FROM f WHERE len(dirs) = 2)
""" + _summary("fx", ["license_type", "crop_type"], " = ", False)

ORACLE["order_tree"] = _with("fx_manifest") + _FILES + """
SELECT path, row_number() OVER (ORDER BY """ + _TREE_KEY + """) AS pos FROM img"""

ORACLE["order_parts"] = _with("fx_manifest") + """
SELECT path, row_number() OVER (ORDER BY string_split(path, '/')) AS pos FROM fx_manifest"""


# ----------------------------------------------------------- scans/plans --

ORACLE["scan_pdf_strict"] = _with("fx_manifest") + """
SELECT path FROM fx_manifest WHERE suffix(path, '.pdf')"""

ORACLE["scan_pdf_pruned"] = _with("fx_manifest") + _FILES + """
SELECT path FROM f WHERE suffix(lower(fname), '.pdf') AND NOT list_contains(dirs, 'Converted')"""

ORACLE["shards_by_prefix"] = _with("fx_shards") + """
SELECT path FROM fx_shards WHERE starts_with(path, 'data/python/') AND suffix(path, '.parquet')"""

ORACLE["shards_by_suffix"] = _with("fx_shards") + """
SELECT path FROM fx_shards
WHERE (suffix(path, '.parquet') OR suffix(path, '.arrow') OR suffix(path, '.json')
       OR suffix(path, '.jsonl') OR suffix(path, '.csv'))
  AND NOT starts_with(path, '.') AND strpos(path, 'README') = 0"""

# python str.strip() over the 29 blank characters; the nine characters \ / : * ? " < > |
_PYSTRIP = ("regexp_replace({x}, '^[\\x{{0009}}-\\x{{000d}}\\x{{001c}}-\\x{{0020}}\\x{{0085}}\\x{{00a0}}\\x{{1680}}"
            "\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+|[\\x{{0009}}-\\x{{000d}}"
            "\\x{{001c}}-\\x{{0020}}\\x{{0085}}\\x{{00a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}"
            "\\x{{202f}}\\x{{205f}}\\x{{3000}}]+$', '', 'g')")


def pystrip(x: str) -> str:
    return _PYSTRIP.format(x=x)


def _sanitize(x: str) -> str:
    return pystrip("regexp_replace(" + x + ", '[\\\\/:*?\"<>|]', '', 'g')")


_CAT = """,
cat AS (SELECT category, pos, url, """ + _sanitize("category") + """ AS folder,
               printf('%02d', pos) || '. ' || """ + _sanitize(pystrip("substring(title, 4)")) + """ || '.pdf' AS filename
        FROM fx_catalogue),
catp AS (SELECT *, folder || '/' || filename AS target_path FROM cat)
"""

ORACLE["catalogue_rows"] = _with("fx_catalogue") + _CAT + """
SELECT category, pos, url, filename, target_path FROM catp"""

ORACLE["acquisition_plan"] = _with("fx_catalogue") + _CAT + """,
present AS (SELECT DISTINCT target_path FROM catp
            WHERE TRY_CAST(regexp_extract(url, '/([0-9]+)\\.pdf$', 1) AS BIGINT) IN (SELECT doc_id FROM labels WHERE quality = 1))
SELECT category, pos, target_path AS path,
       CASE WHEN url IS NULL OR """ + pystrip("url") + """ = '' THEN 'unavailable'
            WHEN target_path IN (SELECT target_path FROM present) THEN 'skip'
            ELSE 'fetch' END AS status
FROM catp"""

_SHARD_PLAN = """,
wanted AS (SELECT path FROM fx_shards WHERE starts_with(path, 'data/python/') AND suffix(path, '.parquet')),
plan AS (SELECT path, CASE WHEN EXISTS (SELECT 1 FROM fx_present p WHERE p.path = w.path AND p.length > 1000000)
                           THEN 'skip' ELSE 'fetch' END AS status FROM wanted w)
"""

ORACLE["skip_by_size"] = _with("fx_shards", "fx_present") + _SHARD_PLAN + """
SELECT path, status FROM plan"""

ORACLE["pending_anti"] = _with("fx_manifest", "fx_outputs") + """
SELECT path FROM fx_manifest WHERE path NOT IN (SELECT path FROM fx_outputs)"""

ORACLE["done_semi"] = _with("fx_manifest", "fx_outputs") + """
SELECT path FROM fx_manifest WHERE path IN (SELECT path FROM fx_outputs)"""

# Path.stem: cut at the last '.' when it is neither the first nor the last
# character of the name (1-based position of the last '.': len - strpos(reverse) + 1)
_STEM = ("CASE WHEN strpos(reverse({n}), '.') > 0"
         " AND length({n}) - strpos(reverse({n}), '.') + 1 > 1"
         " AND length({n}) - strpos(reverse({n}), '.') + 1 < length({n})"
         " THEN substring({n}, 1, length({n}) - strpos(reverse({n}), '.')) ELSE {n} END")

ORACLE["target_mirrored"] = _with("fx_manifest") + _FILES + """
SELECT path, CASE WHEN len(dirs) > 0 THEN array_to_string(dirs, '/') || '/' ELSE '' END
             || """ + _STEM.format(n="fname") + """ || '.md' AS target_path
FROM f WHERE suffix(path, '.pdf')"""

_NESTED = """,
nested AS (SELECT path, array_to_string(list_append(dirs, 'Converted'), '/') || '/' || """ + _STEM.format(n="fname") + """ || '.md' AS target_path
           FROM f WHERE suffix(lower(fname), '.pdf') AND NOT list_contains(dirs, 'Converted'))
"""

ORACLE["target_nested"] = _with("fx_manifest") + _FILES + _NESTED + """
SELECT path, target_path FROM nested"""

ORACLE["target_collisions"] = _with("fx_manifest") + _FILES + _NESTED + """,
named AS (SELECT n.path, n.target_path, m.doc_id FROM nested n JOIN fx_manifest m ON m.path = n.path),
twins AS (SELECT path, target_path FROM named UNION ALL
         SELECT string_split(path, '.')[1] || '.pdf',
                regexp_replace(string_split(path, '.')[1], '([^/]*)$', 'Converted/\\1') || '.md' FROM named WHERE doc_id % 3 = 2)
SELECT target_path, count(*) AS n_sources, min(path) AS first_source, max(path) AS last_source
FROM twins GROUP BY target_path HAVING count(*) > 1"""

_SHARD_RUN = _SHARD_PLAN + """,
run AS (SELECT p.path,
               CASE WHEN p.status = 'skip' THEN 'skip' ELSE coalesce(l.outcome, 'fail') END AS status
        FROM plan p LEFT JOIN (SELECT path, arg_max(outcome, attempt) AS outcome FROM fx_fetch_log GROUP BY path) l
             ON l.path = p.path)
"""

ORACLE["run_report"] = _with("fx_shards", "fx_present", "fx_fetch_log") + _SHARD_RUN + """
SELECT count(*) AS n_total, count(*) FILTER (WHERE status = 'success') AS n_success,
       count(*) FILTER (WHERE status = 'skip') AS n_skip, count(*) FILTER (WHERE status = 'fail') AS n_fail,
       count(*) FILTER (WHERE status IN ('success', 'fail')) AS n_attempted
FROM run"""

ORACLE["status_details"] = _with("fx_shards", "fx_present", "fx_fetch_log") + _SHARD_RUN + """
SELECT path, upper(status) || ': ' || CASE WHEN status = 'fail' THEN path ELSE string_split(path, '/')[-1] END AS detail
FROM run"""

ORACLE["progress_every_10"] = _with("fx_shards", "fx_present", "fx_fetch_log") + _SHARD_RUN + """
SELECT pos, CAST(success AS BIGINT) AS success, CAST(skip AS BIGINT) AS skip, CAST(fail AS BIGINT) AS fail FROM (
  SELECT row_number() OVER w AS pos,
         sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) OVER w AS success,
         sum(CASE WHEN status = 'skip' THEN 1 ELSE 0 END) OVER w AS skip,
         sum(CASE WHEN status = 'fail' THEN 1 ELSE 0 END) OVER w AS fail
  FROM run
  WINDOW w AS (ORDER BY string_split(path, '/') ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE pos % 10 = 0"""

ORACLE["shard_preview"] = _with("fx_shards") + """,
s AS (SELECT path FROM fx_shards WHERE starts_with(path, 'data/python/') AND suffix(path, '.parquet'))
SELECT * FROM (SELECT 'first' AS part, path FROM s ORDER BY string_split(path, '/') LIMIT 3)
UNION ALL
SELECT * FROM (SELECT 'last' AS part, path FROM s ORDER BY string_split(path, '/') DESC LIMIT 3)"""


# ------------------------------------------------------ text / citations --

WS = ("[\\x{0009}-\\x{000d}\\x{001c}-\\x{0020}\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}"
      "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
SEP = "\\r\\n|[\\x{000a}-\\x{000d}\\x{001c}-\\x{001e}\\x{0085}\\x{2028}\\x{2029}]"

# clean_markdown from its statement: split lines, rstrip each, drop a blank
# line that follows a blank line, join, strip, one final line break
_CLEAN = """,
lines AS (SELECT doc_id, list_transform(string_split_regex(text, '""" + SEP + """'),
                                        lambda l: regexp_replace(l, '""" + WS + """+$', '')) AS ls
          FROM fx_noisy_text),
cm AS (SELECT doc_id, """ + pystrip("array_to_string(list_filter(ls, lambda x, i: x <> '' OR i = 1 OR ls[i - 1] <> ''), chr(10))") + """ || chr(10) AS md
       FROM lines)
"""
_REFS = ("regexp_extract(md, '(?im)^#{1,3}" + WS + "*(?:references|bibliography|works cited)" + WS
         + "*$(?s:.*)', 0)")

ORACLE["file_extension"] = _with("fx_manifest") + _FILES + """
SELECT path, lower(ext) AS ext FROM fe"""

ORACLE["strip_text"] = _with("fx_noisy_text") + """
SELECT doc_id, """ + pystrip("text") + """ AS text FROM fx_noisy_text"""

ORACLE["clean_markdown"] = _with("fx_noisy_text") + _CLEAN + """
SELECT doc_id, md FROM cm"""

ORACLE["references_section"] = _with("fx_noisy_text") + _CLEAN + """
SELECT doc_id, """ + _REFS + """ AS "references" FROM cm"""

ORACLE["references_truncated"] = _with("fx_noisy_text") + _CLEAN + """
SELECT doc_id, substring(""" + _REFS + """, 1, 8000) AS "references", substring(md, 1, 8000) AS md_head,
       CAST(length(md) AS BIGINT) AS n_chars FROM cm"""

# fence: strip; if it starts with ``` keep the text between the first two
# fences; drop a leading 'json'
_FENCE = """,
st AS (SELECT conv_id, turn, """ + pystrip("response") + """ AS s FROM fx_responses),
fenced AS (SELECT conv_id, turn,
                  CASE WHEN starts_with(s, '```') THEN
                       CASE WHEN starts_with(coalesce(string_split(s, '```')[2], ''), 'json')
                            THEN substring(string_split(s, '```')[2], 5)
                            ELSE coalesce(string_split(s, '```')[2], '') END
                  ELSE s END AS raw
           FROM st)
"""

_PARSED = _FENCE + """,
parsed AS (SELECT conv_id, turn, raw,
                  coalesce(CASE WHEN json_valid(raw) THEN json_type(raw) = 'ARRAY' AND len(list_filter(json_extract(raw, '$[*]'),
                    lambda e: json_type(e) <> 'OBJECT'
                      OR coalesce(json_type(e, '$.authors'), 'NULL') NOT IN ('ARRAY', 'NULL')
                      OR len(list_filter(json_extract(e, '$.authors[*]'), lambda a: json_type(a) <> 'VARCHAR')) > 0
                      OR len(list_filter(['$.id', '$.year', '$.title', '$.venue', '$.doi'],
                                         lambda f: coalesce(json_type(e, f), 'NULL') IN ('ARRAY', 'OBJECT'))) > 0)) = 0
                    END, false) AS ok
           FROM fenced),
items AS (SELECT conv_id, turn, unnest(json_extract(raw, '$[*]')) AS item,
                 generate_subscripts(json_extract(raw, '$[*]'), 1) AS pos
          FROM parsed WHERE ok)
"""

ORACLE["strip_fence"] = _with("fx_responses") + _FENCE + """
SELECT conv_id, turn, raw FROM fenced"""

ORACLE["citations_from_json"] = _with("fx_responses") + _PARSED + """
SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos,
       coalesce(json_extract_string(item, '$.id'), '') AS id,
       coalesce(array_to_string(CAST(json_extract(item, '$.authors') AS VARCHAR[]), '; '), '') AS authors,
       CAST(coalesce(len(CAST(json_extract(item, '$.authors') AS VARCHAR[])), 0) AS INTEGER) AS n_authors,
       coalesce(json_extract_string(item, '$.year'), '') AS year, coalesce(json_extract_string(item, '$.title'), '') AS title,
       coalesce(json_extract_string(item, '$.venue'), '') AS venue, coalesce(json_extract_string(item, '$.doi'), '') AS doi
FROM items"""

ORACLE["citation_counts"] = _with("fx_responses") + _PARSED + """
SELECT conv_id, turn, CAST(json_array_length(CASE WHEN ok THEN raw ELSE '[]' END) AS INTEGER) AS n_citations,
       NOT ok AS parse_error
FROM parsed"""

ORACLE["citations_nonempty"] = _with("fx_responses") + _PARSED + """
SELECT conv_id, turn, n AS n_citations FROM (
  SELECT conv_id, turn, CAST(json_array_length(CASE WHEN ok THEN raw ELSE '[]' END) AS INTEGER) AS n FROM parsed)
WHERE n > 0"""

ORACLE["citations_rules"] = _with("fx_noisy_text") + _CLEAN + """,
refs0 AS (SELECT doc_id, """ + _REFS + """ AS r0 FROM cm),
refs AS (SELECT doc_id, CASE
    WHEN regexp_matches(r0, '(?m)^(?:[-*+][ \\t]+)?\\[[^\\]\\n]*\\]') THEN regexp_replace(r0, '(?m)^[-*+][ \\t]+\\[', '[', 'g')
    WHEN regexp_matches(r0, '(?m)^[0-9]{1,4}[.)][ \\t]') THEN regexp_replace(r0, '(?m)^([0-9]{1,4})[.)][ \\t]+', '[\\1] ', 'g')
    WHEN regexp_matches(r0, '(?m)^[-*+][ \\t]') THEN regexp_replace(r0, '(?m)^[-*+][ \\t]+', '[] ', 'g')
    ELSE regexp_replace(r0, '(?m)^(\\p{Lu}[\\p{L}''-]+)(,[^\\n]*?)((?:19|20)[0-9]{2})', '[\\1 \\3] \\1\\2\\3', 'g') END AS r FROM refs0),
ent AS (SELECT doc_id, unnest(regexp_extract_all(r, '(?m)^\\[[^\\]\\n]*\\][^\\n]*(?:\\n[^\\[#\\n][^\\n]*)*', 0)) AS e,
               generate_subscripts(regexp_extract_all(r, '(?m)^\\[[^\\]\\n]*\\][^\\n]*(?:\\n[^\\[#\\n][^\\n]*)*', 0), 1) AS pos
        FROM refs),
k AS (SELECT doc_id, pos, e, regexp_extract(e, '^(\\[[^\\]\\n]*\\])', 1) AS key FROM ent),
b AS (SELECT doc_id, pos, CASE WHEN key = '[]' THEN '' ELSE key END AS id,
             """ + pystrip("regexp_replace(substring(e, length(key) + 1), '" + WS + "+', ' ', 'g')") + """ AS body FROM k),
d AS (SELECT doc_id, pos, id, regexp_extract(body, '10\\.[0-9]{4,9}/[^ ]*[^ .,;]', 0) AS doi,
             """ + pystrip("regexp_replace(body, '10\\.[0-9]{4,9}/[^ ]*[^ .,;]', '', 'g')") + """ AS rest FROM b),
s AS (SELECT doc_id, pos, id, doi, regexp_extract(rest, '(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)', 1) AS year,
             list_transform(regexp_extract_all(rest, '(?:\\p{Lu}\\. |[^.])+', 0), lambda x: """ + pystrip("x") + """) AS sent
      FROM d),
a AS (SELECT *, list_filter(string_split_regex(coalesce(sent[1], ''), ' *, *| +and +'), lambda x: x <> '') AS au FROM s)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, id, array_to_string(au, '; ') AS authors, CAST(len(au) AS INTEGER) AS n_authors,
       year, coalesce(sent[2], '') AS title,
       """ + pystrip("regexp_replace(regexp_replace(coalesce(sent[3], ''), '(?:19|20)[0-9]{2}', '', 'g'), '[ ,;:]+$', '')") + """ AS venue,
       doi
FROM a"""

# what each kind of section holds is written out by hand
ORACLE["citations_mixed"] = """
SELECT p.page_id, CAST(pos AS INTEGER) AS pos, id, authors, CAST(n_authors AS INTEGER) AS n_authors, year,
       replace(title, '@', CAST(page_id AS VARCHAR)) AS title, venue, replace(doi, '@', CAST(page_id AS VARCHAR)) AS doi
FROM pages p JOIN (VALUES """ + ",\n".join(map(str, MIXED_CITATIONS)) + """
) AS v(kind, pos, id, authors, n_authors, year, title, venue, doi) ON p.page_id % 8 = v.kind"""

# HTML → Markdown, rule by rule
_HTML_RULES = [
    ("(?is)<!--.*?-->|<head(?:\\s[^>]*)?>.*?</head\\s*>|<script(?:\\s[^>]*)?>.*?</script\\s*>"
     "|<style(?:\\s[^>]*)?>.*?</style\\s*>|<nav(?:\\s[^>]*)?>.*?</nav\\s*>|<footer(?:\\s[^>]*)?>.*?</footer\\s*>", ""),
] + [(f"(?i)<h{n}(?:\\s[^>]*)?>", "\n\n" + "#" * n + " ") for n in range(1, 7)] + [
    ("(?i)</h[1-6]\\s*>", "\n\n"),
    ("(?i)<li(?:\\s[^>]*)?>", "\n- "), ("(?i)</li\\s*>", ""),
    ("(?i)<br\\s*/?>", "\n"),
    ("(?i)<p(?:\\s[^>]*)?>", "\n\n"), ("(?i)</p\\s*>", "\n\n"),
    ("(?i)<tr(?:\\s[^>]*)?>", "\n|"), ("(?i)</tr\\s*>", ""),
    ("(?i)<t[dh](?:\\s[^>]*)?>", " "), ("(?i)</t[dh]\\s*>", " |"),
    ("(?s)<[^>]*>", ""),
]
# (entity, character, may the final ';' be missing)
_ENTS = [("&lt;", "<", True), ("&gt;", ">", True), ("&quot;", '"', True), ("&#39;", "'", True),
         ("&apos;", "'", False), ("&nbsp;", chr(160), True), ("&copy;", "©", True), ("&middot;", "·", True),
         ("&mdash;", "—", False), ("&ndash;", "–", False), ("&hellip;", "…", False), ("&amp;", "&", True)]


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _tables(e: str) -> str:
    # after each table's first row, a row of '---' cells, as many as it has
    pieces = f"string_split_regex({e}, '(?i)<table')"
    first = "regexp_extract(p, '(?is)<tr(?:\\s[^>]*)?>(.*?)</tr\\s*>', 1)"
    n = f"len(regexp_extract_all({first}, '(?i)<t[dh][\\s>]'))"
    fixed = (f"CASE WHEN i > 1 AND {n} > 0 THEN regexp_replace('<table' || p, '(?is)^(.*?</tr\\s*>)', "
             f"'\\1<tr>' || repeat('<td>---</td>', {n}) || '</tr>') WHEN i > 1 THEN '<table' || p ELSE p END")
    return f"array_to_string(list_transform({pieces}, lambda p, i: {fixed}), '')"


def _html_expr(col: str) -> str:
    e = col
    for k, (p, r) in enumerate(_HTML_RULES):
        e = f"regexp_replace({e}, {_sql_str(p)}, {_sql_str(r)}, 'g')"
        if k == 0:
            e = _tables(e)
    for a, b, optional in _ENTS:
        if optional:
            e = f"regexp_replace({e}, {_sql_str(a[:-1] + ';?')}, {_sql_str(b)}, 'g')"
        else:
            e = f"replace({e}, {_sql_str(a)}, {_sql_str(b)})"
    return e


_CONVERTED = """
conv AS (SELECT page_id, regexp_matches(html, '(?i)</html\\s*>') AS complete, """ + _html_expr("html") + """ AS text
         FROM pages),
lines AS (SELECT page_id, complete, list_transform(string_split_regex(text, '""" + SEP + """'),
                                                   lambda l: regexp_replace(l, '""" + WS + """+$', '')) AS ls FROM conv),
res AS (SELECT page_id, complete, """ + pystrip("array_to_string(list_filter(ls, lambda x, i: x <> '' OR i = 1 OR ls[i - 1] <> ''), chr(10))") + """ || chr(10) AS md
        FROM lines)
"""

ORACLE["convert_documents"] = "WITH" + _CONVERTED + """
SELECT page_id, 'ok' AS status, md, CAST(NULL AS VARCHAR) AS error, complete FROM res"""

ORACLE["convert_hostile"] = """
SELECT page_id, 'ok' AS status, replace(md, '@', CAST(page_id AS VARCHAR)) AS md
FROM pages p JOIN (VALUES """ + ",\n".join(f"({k}, {sql_text(md)})" for k, (_, md) in enumerate(HOSTILE_PAGES)) + """
) AS v(kind, md) ON p.page_id % 16 = v.kind"""

ORACLE["convert_quarantine"] = _with("fx_fatal_pages") + """
SELECT page_id, CASE WHEN page_id < 0 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN page_id >= 0 THEN length(html) || ' characters' || chr(10) END AS md,
       CASE WHEN page_id < 0 THEN CASE html WHEN 'exit' THEN 'converter ended with code 3' WHEN 'sleep' THEN 'stopped after 1 seconds'
                                            ELSE 'MemoryError: more than 512 MB' END END AS error
FROM fx_fatal_pages"""

# every eleventh page has no content
ORACLE["failures"] = "SELECT page_id, 'no content' AS error FROM pages WHERE page_id % 11 = 3"


# ------------------------------------------------------- sinks / streams --

ORACLE["csv_round_trip"] = ORACLE["rows_images"]

ORACLE["incremental_run"] = "WITH" + _CONVERTED + """
SELECT page_id, CASE WHEN page_id % 11 = 3 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN page_id % 11 <> 3 THEN md END AS md, CASE WHEN page_id % 11 = 3 THEN 'no content' END AS error FROM res"""

ORACLE["incremental_replay"] = """
SELECT page_id, CASE WHEN page_id % 11 = 3 THEN 'error' ELSE 'ok' END AS status,
       CAST(CASE WHEN page_id % 11 = 3 THEN 0 ELSE 1 END AS BIGINT) AS n_ok,
       CAST(CASE WHEN page_id % 11 = 3 AND page_id % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_rows FROM pages"""

ORACLE["conversion_report"] = """
SELECT count(*) AS n_total, CAST(0 AS BIGINT) AS n_ok, count(*) FILTER (WHERE page_id % 11 <> 3) AS n_skipped,
       count(*) FILTER (WHERE page_id % 11 = 3) AS n_error, count(*) FILTER (WHERE page_id % 11 = 3) AS n_attempted
FROM pages"""

ORACLE["conversion_rows"] = """
SELECT 'site/' || (page_id % 7) || '/p' || page_id || '.html' AS path, 'ok' AS status,
       'site/' || (page_id % 7) || '/Converted/p' || page_id || '.md' AS target_path, 0 AS citations,
       regexp_matches(html, '(?i)</html\\s*>') AS complete FROM pages"""

ORACLE["citation_files"] = ORACLE["citations_nonempty"]

ORACLE["report_tables"] = _with("fx_manifest", "fx_shards", "fx_present", "fx_fetch_log") + _FILES + _ROWS3 + _SHARD_RUN + """,
summary AS (""" + _summary("rows3", ["level_1", "level_2", "level_3"], "  =  ", True) + """),
tally AS (SELECT count(*) AS n_total, count(*) FILTER (WHERE status = 'success') AS n_success,
       count(*) FILTER (WHERE status = 'skip') AS n_skip, count(*) FILTER (WHERE status = 'fail') AS n_fail,
       count(*) FILTER (WHERE status IN ('success', 'fail')) AS n_attempted FROM run)
SELECT breakdown, n FROM summary
UNION ALL SELECT 'n_total', n_total FROM tally UNION ALL SELECT 'n_success', n_success FROM tally
UNION ALL SELECT 'n_skip', n_skip FROM tally UNION ALL SELECT 'n_fail', n_fail FROM tally
UNION ALL SELECT 'n_attempted', n_attempted FROM tally"""

ORACLE["summary_order"] = _with("fx_manifest") + _FILES + _ROWS3 + """,
summary AS (""" + _summary("rows3", ["level_1", "level_2", "level_3"], "  =  ", True) + """)
SELECT pos AS level, value, n, row_number() OVER (ORDER BY pos, value NULLS FIRST) AS place FROM summary"""

ORACLE["spec_json"] = _with("fx_manifest") + _FILES + """,
d AS (SELECT CAST(coalesce(max(len(dirs)), 0) AS INTEGER) AS m FROM img),
slots AS (SELECT 'filename' AS slot UNION ALL SELECT 'path'
          UNION ALL SELECT 'level_' || i FROM (SELECT unnest(range(1, m + 1)) AS i FROM d))
SELECT slot, slot AS header, true AS enabled, (SELECT m FROM d) AS max_depth FROM slots"""

ORACLE["data_files_plan"] = _with("fx_shards", "fx_present") + """
SELECT w.path, CASE WHEN EXISTS (SELECT 1 FROM fx_present p WHERE p.path = w.path AND p.length > 100000)
                    THEN 'skip' ELSE 'fetch' END AS status
FROM fx_shards w
WHERE (suffix(w.path, '.parquet') OR suffix(w.path, '.arrow') OR suffix(w.path, '.json')
       OR suffix(w.path, '.jsonl') OR suffix(w.path, '.csv'))
  AND NOT starts_with(w.path, '.') AND strpos(w.path, 'README') = 0"""

ORACLE["conversion_plan"] = _with("fx_manifest", "fx_outputs") + _FILES + """,
tgt AS (SELECT path, CASE WHEN len(dirs) > 0 THEN array_to_string(dirs, '/') || '/' ELSE '' END
                     || """ + _STEM.format(n="fname") + """ || '.md' AS target_path FROM f),
done AS (SELECT t.target_path FROM tgt t JOIN fx_outputs o ON o.path = t.path)
SELECT path, target_path,
       CASE WHEN target_path IN (SELECT target_path FROM done) THEN 'skipped' ELSE 'convert' END AS status
FROM tgt WHERE suffix(path, '.pdf')"""


# the tree of a partitioned table: a folder per source and language
ORACLE["file_manifest"] = """
SELECT DISTINCT 'source=' || source || '/lang=' || lang AS folder, 2 AS depth, true AS has_bytes FROM documents"""

ORACLE["file_contents"] = """
SELECT DISTINCT 'source=' || source || '/lang=' || lang AS folder, true AS whole FROM documents"""

ORACLE["download_report"] = _with("fx_catalogue") + _CAT + """,
present AS (SELECT DISTINCT target_path FROM catp
            WHERE TRY_CAST(regexp_extract(url, '/([0-9]+)\\.pdf$', 1) AS BIGINT) IN (SELECT doc_id FROM labels WHERE quality = 1)),
run AS (SELECT CASE WHEN url IS NULL OR """ + pystrip("url") + """ = '' THEN 'unavailable'
                    WHEN target_path IN (SELECT target_path FROM present) THEN 'skip'
                    WHEN TRY_CAST(regexp_extract(url, '/([0-9]+)(?:-2)?\\.pdf$', 1) AS BIGINT)
                         IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'fail' ELSE 'success' END AS status FROM catp)
SELECT count(*) AS n_total, count(*) FILTER (WHERE status = 'success') AS n_success,
       count(*) FILTER (WHERE status = 'skip') AS n_skip, count(*) FILTER (WHERE status = 'unavailable') AS n_unavailable,
       count(*) FILTER (WHERE status = 'fail') AS n_fail, count(*) FILTER (WHERE status IN ('success', 'fail')) AS n_attempted
FROM run"""


# ------------------------------------ one pass, stored keys, timed retries --

ORACLE["label_job_widths"] = ORACLE["column_widths"]

ORACLE["label_job_rows"] = ORACLE["rows_exact_depth"]

ORACLE["empty_runs"] = _with("fx_manifest") + _FILES + """
SELECT 'all' AS run, unnest(['dataset_rows', 'dataset_summary', 'dataset_summary.parquet', 'dataset_widths']) AS output
FROM (SELECT count(*) AS n FROM img) WHERE n > 0"""

ORACLE["sample_widths"] = _with("fx_manifest") + _FILES + _ROWS3 + """,
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY """ + _TREE_KEY + """) AS rn FROM rows3) WHERE rn <= 500)
""" + "\nUNION ALL\n".join(
    f"SELECT {i} AS pos, '{h}' AS header, CAST(least(greatest({len(h)}, "
    f"coalesce(max(length(nullif({h}, ''))), 0)) + 4, 60) AS INTEGER) AS width FROM firsts"
    for i, h in enumerate(["filename", "path", "level_1", "level_2", "level_3"]))

ORACLE["csv_split_read"] = _with("fx_noisy_text") + "\nSELECT doc_id, coalesce(text, '') AS text FROM fx_noisy_text"

ORACLE["csv_one_header"] = ORACLE["rows_images"]

ORACLE["stored_skip"] = ORACLE["skip_by_size"]

ORACLE["stored_pending"] = ORACLE["pending_anti"]

ORACLE["timed_retries"] = """
SELECT page_id, 'ok' AS status, 1 AS attempts FROM pages
UNION ALL
SELECT -page_id - 1, if(page_id % 2 = 1, 'ok', 'error'), if(page_id % 2 = 1, 2, 4) FROM pages WHERE page_id % 11 = 3"""

ORACLE["flat_folder"] = "SELECT DISTINCT 'part=' || doc_id % 200 AS folder, CAST(1 AS BIGINT) AS n_files, true AS has_bytes FROM documents"

ORACLE["live_progress"] = """
WITH n AS (SELECT count(*) AS pages, count(*) FILTER (WHERE page_id % 2 = 0) AS even,
                  count(*) FILTER (WHERE page_id % 11 = 3) AS bad FROM pages)
SELECT CAST(1 AS BIGINT) AS batch, even AS n_items, even AS n_ok, CAST(0 AS BIGINT) AS n_error FROM n WHERE even > 0
UNION ALL SELECT 2, pages - even + bad, pages, bad FROM n
UNION ALL SELECT 3, bad, pages, 2 * bad FROM n WHERE bad > 0"""
