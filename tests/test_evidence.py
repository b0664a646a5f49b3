"""Page evidence: what finds a page's text runs once a page."""

import pytest
from pyspark.sql import functions as F

from larkspar.functions import text, web
from larkspar.operators import evidence

PAGES = [(1, None), (2, ""), (3, "plain"), (4, "<body>a &amp; b<br>c@d.org</body>"), (5, "<!-- x --><main>one &lt;two&#62; <script>&</script> 12 34 56 78 90</main><body>no</body>"),
         (6, "<div role='main'>x\n y &#10; z</div>"), (7, "<article> +33 (0)1 23 45 67 89 and 12 34</article>"), (8, "<main>&</main>@ 1234")]
TEXTS = [None, "", "plain", "a & b\n[EMAIL]", "one <two> [PHONE]", "x\ny\nz", "[PHONE] and 12 34", "&"]


def test_differencing_finds_texts_once(spark):
    n = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def found(i):
        n.add(1)
        return f"menu\nline {i}\nfoot" if i else None

    pages = spark.range(0, 40, 1, 4).select("id", F.lit("h").alias("host"), found("id").alias("text"))
    got = {r.id: (r.main_text, r.method, r.truncated) for r in evidence.differenced(pages, "host", "text", "id").collect()}
    assert got == {0: (None, "BOILERPLATE_DIFFERENCED", None)} | {i: (f"line {i}", "BOILERPLATE_DIFFERENCED", False) for i in range(1, 40)}
    assert n.value == 40


@pytest.mark.parametrize("column", [web.page_text, web.main_html, web.main_method])
def test_content_tags_are_taken_out_once(spark, column):
    plan = spark.createDataFrame(PAGES, "id int, html string").select(column(F.col("html")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<noscript") == 1


def test_patterns_that_are_left_out_change_nothing(spark):
    rows = spark.createDataFrame(PAGES, "id int, html string").orderBy("id").select(web.page_text(F.col("html")).alias("text"), web.main_method(F.col("html")).alias("method")).collect()
    assert [r.text for r in rows] == TEXTS
    assert [r.method for r in rows] == ["FULL_BODY"] * 4 + ["MAIN_ELEMENT"] * 4
    strings = spark.createDataFrame([(s,) for s in [None, "", "@", "a@b", "a@b.c, x@y", "12", "+33 1 23", "+33 1 23 45 67 89."]], "s string")
    got = [tuple(r) for r in strings.select(text.redact(F.col("s")), web.entities(F.col("s"))).collect()]
    assert got == [(None, None), ("", ""), ("@", "@"), ("a@b", "a@b"), ("[EMAIL], x@y", "a@b.c, x@y"), ("12", "12"), ("+33 1 23", "+33 1 23"), ("[PHONE].", "+33 1 23 45 67 89.")]


def test_text_and_method_together(spark):
    h = F.col("html")
    rows = spark.createDataFrame(PAGES, "id int, html string").select(web.page_text_and_method(h).alias("p"), web.page_text(h).alias("text"), web.main_method(h).alias("method")).collect()
    assert [(r.p.text, r.p.method) for r in rows] == [(r.text, r.method) for r in rows]
