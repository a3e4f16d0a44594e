"""Citation rules, JSON answers, HTML conversion, error isolation, streams."""

import pandas as pd
from pyspark.sql import functions as F

from corpusmill.functions import html as H
from corpusmill.operators import citations as CI
from corpusmill.operators import convert as CV
from corpusmill.streaming import incremental as INC


def test_parse_contract(spark):
    cases = [
        ('[{"id":"[1]","authors":["A"],"year":"2020","title":"T","venue":"","doi":""}]', 1, False),
        ('```json\n[{"id":"k"}]\n```', 1, False),
        ("[]", 0, False),
        ('{"id":"lone object"}', 0, True),
        ('[{"id":"a"}] trailing', 0, True),
        ("Sorry", 0, True),
        ('[{"id":"a"}] x ]', 0, True),
        ('[{"id":"a"}][{"id":"b"}]', 0, True),
        ("[null]", 0, True),
        ('[1],"x":[2]', 0, True),
        ('[{"id":"a"}],"x":[{"id":"b"}]', 0, True),
        ('[{"id":"a","authors":"A"}]', 0, True),
        ('[{"id":"a","authors":[null]}]', 0, True),
        ('[{"id":["a"]}]', 0, True),
        ('[{"id":null,"authors":null,"year":2020},{}]', 2, False),
        ("", 0, True),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i INT, response STRING")
    got = [(r.n_citations, r.parse_error) for r in CI.citation_counts(df, "response", ["i"]).orderBy("i").collect()]
    assert got == [(n, e) for _, n, e in cases]


def test_rule_citations(spark):
    refs = ("## References\n[1] A. Author and B. Writer. A title. Venue, 2019. 10.1234/abc.\n"
            "[Smith2020] Smith, Jones and Lee. Other work\ncontinued. Press.\n# Appendix\n[9] not refs? still")
    df = spark.createDataFrame([(1, refs)], "d INT, references STRING")
    rows = CI.extract_citations(df, "references", ["d"]).orderBy("pos").collect()
    assert [r.id for r in rows] == ["[1]", "[Smith2020]", "[9]"]
    r1 = rows[0]
    assert (r1.authors, r1.title, r1.venue, r1.year, r1.doi) == (
        ["A. Author", "B. Writer"], "A title", "Venue", "2019", "10.1234/abc")
    r2 = rows[1]
    assert r2.authors == ["Smith", "Jones", "Lee"] and r2.title == "Other work continued" and r2.venue == "Press"


def test_absent_fields_are_empty(spark):
    df = spark.createDataFrame([(1, '[{"id":null,"year":2020,"title":"T"},{}]')], "d INT, response STRING")
    rows = [tuple(r) for r in CI.parse_citation_responses(df, "response", ["d"]).orderBy("pos").collect()]
    assert rows == [(1, 1, "", [], "2020", "T", "", ""), (1, 2, "", [], "", "", "", "")]


def test_every_list_form_gives_its_citations(spark):
    forms = {
        "numbered": ("## References\n1. A. Author. First. Press, 2001.\nmore\n2) B. Writer. Second. Venue.", ["[1]", "[2]"]),
        "listed": ("## References\n- A. Author. First. Press.\n* B. Writer. Second.\n  wrapped", ["", ""]),
        "marked keys": ("## References\n- [1] A. Author. First.\n- [b] B. Writer. Second.", ["[1]", "[b]"]),
        "author-year": ("## References\nSmith, J. and Lee, K. 2020. Work. Press.\n\nDoe-Roe, A. Old. Venue, 1987.",
                        ["[Smith 2020]", "[Doe-Roe 1987]"]),
        "bracketed wins": ("## References\n[1] A. 1. One.\n2. not an entry\n[2] B. Two.", ["[1]", "[2]"]),
        "nothing": ("## References\nno list here", []),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in forms.items()], "d STRING, references STRING")
    got = {k: [] for k in forms}
    for r in CI.extract_citations(df, "references", ["d"]).orderBy("d", "pos").collect():
        got[r.d].append(r.id)
    assert got == {k: v[1] for k, v in forms.items()}


def test_character_references(spark):
    import html as pyhtml
    texts = ["&#8217;&#x27;&#X1F600; &eacute;&NotEqualTilde;", "&amp;#65; &amp;amp; &ampx &copy2 &nbsp", "a & b &; &#; &#x; &zzz;",
             "&#128;&#0;&#xD800;&#1114112; &notin; &notit;", "plain", "&lt;p&gt; &Aacute &Aacutes", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    got = [r[0] for r in df.orderBy("i").select(H.decode_entities(F.col("t"))).collect()]
    assert got == [pyhtml.unescape(t) for t in texts]


def test_html_rules(spark):
    html = ("<html><head><title>T</title></head><body><nav>menu</nav><!-- c --><script>x='</p>'</script>"
            "<h2 class='a'>Head &amp; more</h2><p>One<br>two</p><ul><li>i1</li><li>i2</li></ul>"
            "<table><tr><td>a</td><td>b</td></tr></table><img src=x><footer>f</footer></body></html>")
    df = spark.createDataFrame([(1, html), (2, "<html><p>cut"), (3, "<html><p>a &amp b &ampamp; &amp;lt; &lt c</p></html>")],
                               "id INT, html STRING")
    out = {r.id: r for r in CV.convert_html(df, "html", ["id"]).collect()}
    assert out[1].status == "ok"
    assert out[1].md == "## Head & more\n\nOne\ntwo\n\n- i1\n- i2\n| a | b |\n| --- | --- |\n"
    assert out[1].complete
    assert (out[2].status, out[2].md, out[2].error, out[2].complete) == ("ok", "cut\n", None, False)
    import html as pyhtml
    assert out[3].md == pyhtml.unescape("a &amp b &ampamp; &amp;lt; &lt c") + "\n"   # HTML5 entity rules


def test_python_converter_isolates_errors(spark):
    def make():
        def conv(text):
            if "boom" in text:
                raise RuntimeError("bad document")
            return text.upper()
        return conv
    df = spark.createDataFrame([(i, "boom" if i % 5 == 0 else f"doc {i}") for i in range(50)],
                               "id BIGINT, body STRING").repartition(4)
    res = CV.convert_with(df, make, "id", "body").collect()
    assert len(res) == 50
    errs = [r for r in res if r.status == "error"]
    assert len(errs) == 10 and all("bad document" in r.error for r in errs)
    assert {r.md for r in res if r.id == 1} == {"DOC 1\n"}


def _convert(df):
    return CV.convert_html(df.select("page_id", "html"), "html", ["page_id"])


def _states(spark, state):
    return {r.page_id: (r.status, r.md) for r in INC.latest_status(spark, state, "page_id").collect()}


def _add(src, name, rows):
    pd.DataFrame(rows, columns=["page_id", "url", "html"]).to_parquet(src / name)


PAGES = "page_id BIGINT, url STRING, html STRING"


def test_stream_is_incremental_and_retries(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    _add(src, "p1.parquet", [(1, "u", "<html><p>a</p></html>")])
    state = str(tmp_path / "state")
    INC.stream_convert(spark, str(src), PAGES, _convert, "page_id", state_dir=state)
    assert _states(spark, state) == {1: ("ok", "a\n")}
    _add(src, "p2.parquet", [(2, "u", "<html><p>b</p></html>"), (3, "u", None)])
    for _ in range(4):
        INC.stream_convert(spark, str(src), PAGES, _convert, "page_id", state_dir=state)
    assert _states(spark, state) == {1: ("ok", "a\n"), 2: ("ok", "b\n"), 3: ("error", None)}
    res = spark.read.parquet(f"{state}/results")
    assert res.where("page_id = 3").count() == INC.MAX_ATTEMPTS  # tried again, but not for ever
    assert res.where("page_id < 3").count() == 2  # finished work is never redone


def test_stream_over_a_table_of_one_file_or_a_folder(spark, tmp_path):
    from corpusmill.plans.queries import QUERIES
    rows = [(i, "u", f"<p>page {i}") for i in range(1, 31)]
    for form in ("file", "folder"):
        sf = tmp_path / form
        sf.mkdir()
        if form == "folder":
            (sf / "pages.parquet").mkdir()
            _add(sf, "pages.parquet/part-0.parquet", rows[:20])
            _add(sf, "pages.parquet/part-1.parquet", rows[20:])
        else:
            _add(sf, "pages.parquet", rows)
        got = {r.page_id: (r.status, r.md) for r in QUERIES["incremental_run"](spark, str(sf)).collect()}
        assert got == {i: ("error", None) if i % 11 == 3 else ("ok", f"page {i}\n") for i in range(1, 31)}


def test_replayed_batch_keeps_finished_rows(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    _add(src, "p.parquet", [(1, "u", "<p>a"), (2, "u", "<p>b"), (3, "u", None)])
    state = str(tmp_path / "state")
    INC.stream_convert(spark, str(src), PAGES, _convert, "page_id", state_dir=state, retry_pass=False)
    want = {1: ("ok", "a\n"), 2: ("ok", "b\n"), 3: ("error", None)}
    assert _states(spark, state) == want
    commits = tmp_path / "state" / "checkpoint" / "commits"
    for f in [*commits.glob("0"), *commits.glob(".0.crc")]:
        f.unlink()  # the driver was lost before the commit
    INC.stream_convert(spark, str(src), PAGES, _convert, "page_id", state_dir=state, retry_pass=False)
    assert _states(spark, state) == want
    assert spark.read.parquet(f"{state}/results").count() == 3


def test_newest_version_of_a_key_in_one_batch(spark, tmp_path):
    state = str(tmp_path / "state")
    rows = spark.createDataFrame([(1, "<p>old", 1), (1, "<p>new", 2), (2, "<p>b", 1), (None, "<p>x", 1)],
                                 "page_id BIGINT, html STRING, version INT")
    INC.run_batch(spark, rows, _convert, "page_id", state, 1, version="version")
    assert _states(spark, state) == {1: ("ok", "new\n"), 2: ("ok", "b\n")}
    assert spark.read.parquet(f"{state}/results").count() == 2


def test_state_is_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(INC, "COMPACT_EVERY", 3)
    state = str(tmp_path / "state")
    for seq in range(1, 6):
        rows = spark.createDataFrame([(k, None if k == 2 else f"<p>{k}") for k in range(1, seq + 1)],
                                     "page_id BIGINT, html STRING")
        INC.run_batch(spark, rows, _convert, "page_id", state, seq)
    assert INC._numbers(spark, f"{state}/base")
    got = {r.page_id: (r.done, r.attempts) for r in INC.key_state(spark, state, "page_id", 99).collect()}
    assert got == {1: (True, 1), 2: (False, 4), 3: (True, 1), 4: (True, 1), 5: (True, 1)}
    assert INC.failed_keys(spark, state, "page_id", 99).count() == 0
    assert INC.failed_keys(spark, state, "page_id", 99, max_attempts=5).count() == 1


def test_write_citations_only_nonempty(spark, tmp_path):
    df = spark.createDataFrame([(1, '[{"id":"a"}]'), (2, "[]")], "d INT, response STRING")
    cits, _ = CI.parse_citation_array("response")
    out = str(tmp_path / "cit")
    CI.write_citations(df.select("d", cits.alias("citations")), "citations", out, ["d"])
    assert [r.d for r in spark.read.json(out).collect()] == [1]


def test_jobs_end_to_end(spark, tmp_path, tree):
    from corpusmill.plans import jobs
    from corpusmill.sources import manifest as M
    root, _ = tree
    m = M.list_files(spark, str(root))
    out = str(tmp_path / "labels")
    first = jobs.label_job(spark, m, out)
    assert first.rows is None and first.spec.max_depth == 3   # config written, stop
    assert spark.read.parquet(f"{out}/sample_tree").where("folder = 'A'").first().images == [".h.jpg", "_u.jpg", "a1.png"]
    second = jobs.label_job(spark, m, out)
    assert second.rows is not None
    widths = {r.header: r.width for r in spark.read.parquet(f"{out}/dataset_widths").collect()}
    assert widths["filename"] == len("deeper.gif") + 4 and widths["level_3"] == len("level_3") + 4
    back = spark.read.option("header", True).csv(f"{out}/dataset_summary")
    assert back.where("breakdown = 'Total images'").first()["n"] == str(second.rows.count())
    pages = spark.createDataFrame([(1, "<html><h1>References</h1><p>[1] A. B. T. V, 2001.</p></html>"),
                                   (2, None)], "id BIGINT, html STRING")
    state = str(tmp_path / "conv")
    r1 = jobs.convert_job(spark, pages, "id", state, with_citations=True)
    assert r1["report"].first()["n_ok"] == 1 and r1["citations"].count() == 1
    assert {r.id: r.citations for r in r1["run"].collect()} == {1: 1, 2: None}
    r2 = jobs.convert_job(spark, pages, "id", state)
    t = r2["report"].first()
    assert (t.n_ok, t.n_skipped, t.n_error) == (0, 1, 1)
    docs = spark.createDataFrame([("A/p.pdf", "<html><p>x</p></html>")], "path STRING, html STRING")
    r3 = jobs.convert_job(spark, docs, "path", str(tmp_path / "conv2"), target="nested")
    assert [(r.path, r.target_path, r.status) for r in r3["run"].collect()] == [("A/p.pdf", "A/Converted/p.md", "ok")]


def test_new_version_of_failed_input_wins(spark, tmp_path):
    state = str(tmp_path / "state")
    bad = spark.createDataFrame([(7, None)], "page_id BIGINT, html STRING")
    INC.convert_run(spark, bad, _convert, "page_id", state)
    fixed = spark.createDataFrame([(7, "<html><p>whole</p></html>")], "page_id BIGINT, html STRING")
    run = {r.page_id: (r.status, r.md) for r in INC.convert_run(spark, fixed, _convert, "page_id", state).collect()}
    assert run == {7: ("ok", "whole\n")}


def test_tables_get_a_delimiter_row(spark):
    html = ("<html><body><p>before</p><TABLE class='t'><tr><th>h1</th><th>h2</th></tr>"
            "<tr><td>a</td><td>b</td></tr></TABLE><p>mid</p><table><tr><td>x</td></tr></table></body></html>")
    df = spark.createDataFrame([(1, html)], "id INT, html STRING")
    md = CV.convert_html(df, "html", ["id"]).first().md
    assert md == "before\n\n| h1 | h2 |\n| --- | --- |\n| a | b |\n\nmid\n\n| x |\n| --- |\n"


def test_stream_with_processing_time_trigger(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    _add(src, "a.parquet", [(1, "u", "<html><p>a</p></html>")])
    state = str(tmp_path / "state")
    q = INC.stream_convert(spark, str(src), PAGES, _convert, "page_id", state_dir=state, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert _states(spark, state) == {1: ("ok", "a\n")}


def test_jobs_write_nothing_for_empty_input(spark, tmp_path):
    from corpusmill.plans import jobs
    empty = spark.createDataFrame([], "path STRING, length BIGINT")
    jobs.acquisition_job(spark, empty, empty, str(tmp_path / "acq"))
    jobs.label_job(spark, empty, str(tmp_path / "lab"), spec=jobs.L.LabelSpec.default(2))
    jobs.label_job_fixed(spark, empty, str(tmp_path / "fix"))
    run = jobs.convert_job(spark, spark.createDataFrame([], "id BIGINT, html STRING"), "id", str(tmp_path / "conv"))
    assert run["run"].count() == 0 and run["report"].first().n_total == 0
    assert list(tmp_path.iterdir()) == []
