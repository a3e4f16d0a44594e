"""Whole texts: every text rule over multi-megabyte inputs (a repeated group
in a Java regex recurses per iteration and overflows the stack)."""

from pyspark.sql import functions as F

from corpusmill.functions import html as H
from corpusmill.functions import text as T
from corpusmill.operators import citations as CI


def test_text_rules_on_long_texts(spark):
    long_body = "[1] " + "word " * 200_000 + ". Title. Venue 2001."
    many_lines = "## References\n[1] start\n" + "continued line\n" * 50_000 + "# end"
    blanks = ("para  \n\n\n\n" * 100_000) + "## References\n[2] B. Tail.\n"
    html = "<html><body>" + "<p>x &amp; y<br>z</p><!-- c -->" * 100_000 + "</body></html>"
    fenced = "```json\n[" + ",".join(['{"id":"[%d]"}' % i for i in range(50_000)]) + "]\n```"
    df = spark.createDataFrame([(1, long_body), (2, many_lines), (3, blanks), (4, html), (5, fenced)],
                               "d INT, t STRING")
    out = df.select(
        "d",
        F.length(T.clean_markdown("t")).alias("clean"),
        F.length(T.references_section(T.clean_markdown("t"))).alias("refs"),
        F.size(CI.citation_array(T.references_section(T.clean_markdown("t")))).alias("cits"),
        F.size(CI.citation_array("t")).alias("cits_raw"),
        F.length(H.html_to_markdown("t")).alias("md"),
        F.size(CI.parse_citation_array("t")[0]).alias("json"),
        F.length(T.py_strip("t")).alias("strip"),
    ).orderBy("d").collect()
    by = {r.d: r for r in out}
    assert by[1].cits_raw == 1
    assert by[2].cits == 1 and by[3].cits == 1
    assert by[3].clean < len(blanks)
    assert by[5].json == 50_000
    assert all(r.strip > 0 for r in out)
