"""Literal cases for functions and operators that have no SQL form."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspar.functions import text, web
from larkspar.operators import evaluation, graph, reconcile, scoring, store
from larkspar.sources import readers


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("raw, status, reason", [
    (None, "ABSENT", "blank"), ("  ", "ABSENT", "blank"), ("a b.fr", "MALFORMED", "interior_whitespace"), ("http//www.x.fr", "MALFORMED", "broken_scheme"),
    ("a@x.fr", "NOT_A_WEBSITE", "userinfo_present"), ("ftp://x.fr", "NOT_A_WEBSITE", "non_http_scheme"), ("localhost", "MALFORMED", "host_without_dot"),
    ("x.invalid", "NOT_A_WEBSITE", "no_icann_public_suffix"), ("WWW.Uva.NL/en", "STRUCTURALLY_VALID", None)])
def test_website_ladder(spark, raw, status, reason):
    got = spark.createDataFrame([(raw,)], "u string").select(web.website(F.col("u")).alias("x")).first()["x"]
    assert (got.status, got.reason) == (status, reason)


def test_domains(spark):
    d = lambda h: one(spark, web.registrable_domain(F.col("h")), h=h)
    assert d("www.subdomain-test.co.uk") == "subdomain-test.co.uk" and d("a.b.uva.nl") == "uva.nl"


def test_codes(spark):
    assert one(spark, text.code(F.col("c")), c=" x  whitespace01 ") == "X WHITESPACE01"
    assert one(spark, text.digits_only(F.col("c")), c=" 111 ") == "111" and one(spark, text.digits_only(F.col("c")), c="9;9") is None
    assert one(spark, text.row_key(F.col("c"), F.col("p")), c="A|B", p="1") is None
    assert one(spark, text.match_form(F.col("c")), c="Étudiants--Entrants!") == "etudiants entrants"


def test_redaction(spark):
    assert one(spark, text.redact(F.col("c")), c="call +33 1 44 07 80 00 or a.b@c.fr, room 12") == "call [PHONE] or [EMAIL], room 12"


def test_reconciliation_verdicts(spark):
    left = spark.createDataFrame([("agree", "1", "A"), ("conflict", "1", "B"), ("first", "1", None), ("second", None, "B"), ("many", "3", "C"), ("none", "9", "Z")], "k string, p string, e string")
    right = spark.createDataFrame([("x", ["1"], ["A"]), ("y", ["2"], ["B"]), ("u", ["3"], ["C"]), ("v", ["3"], ["C"])], "id string, ps array<string>, es array<string>")
    rows = reconcile.reconcile(left, "p", "e", right, "id", "ps", "es")
    assert {r.k: (r.verdict, r.grade) for r in rows.collect()} == {
        "agree": ("MATCH_BOTH_AGREE", "UNIQUE"), "conflict": ("MATCH_BOTH_CONFLICT", "CONFLICT"), "first": ("MATCH_FIRST_ONLY", "UNIQUE"),
        "second": ("MATCH_SECOND_ONLY", "UNIQUE"), "many": ("MATCH_BOTH_AMBIGUOUS", "AMBIGUOUS"), "none": ("NO_MATCH", "NO_MATCH")}
    s = reconcile.summary(rows, 1).first()
    assert s.either == s.by_first + s.by_second - s.by_both and s.either + s.neither == s.comparable
    assert s.grade_unique + s.grade_ambiguous + s.grade_conflict + s.grade_no_match + s.unusable == s.total
    assert sorted((r.k, r.hit) for r in reconcile.hits(rows.where("grade = 'AMBIGUOUS'"), "p", right, "id", "ps").collect()) == [("many", "u"), ("many", "v")]
    assert reconcile.reverse_coverage(left, "p", "e", right, "id", "ps", "es").first()[:] == (4, 0)


def test_reconciliation_of_repeated_and_null_entities(spark):
    left = spark.createDataFrame([("split", "1", "A"), ("apart", "2", "B"), ("nulls", None, None)], "k string, p string, e string")
    right = spark.createDataFrame([("x", ["1", "1", None], []), ("x", [], ["A"]), ("y", ["2"], None), ("z", None, ["B"]), (None, ["1"], ["B"])], "id string, ps array<string>, es array<string>")
    rows = {r.k: (r.first_n, r.second_n, r.verdict) for r in reconcile.reconcile(left, "p", "e", right, "id", "ps", "es").collect()}
    assert rows == {"split": (1, 1, "MATCH_BOTH_AGREE"), "apart": (1, 1, "MATCH_BOTH_CONFLICT"), "nulls": (0, 0, "NO_MATCH")}
    plan = reconcile.reconcile(left, "p", "e", right, "id", "ps", "es")._jdf.queryExecution().toString()
    assert "collect_set" not in plan and "collect_list" not in plan


def test_rule_pack(spark):
    pages = spark.createDataFrame([(1, "relations internationales", "International Office"), (2, "login", "MSc research")], "id long, path string, title string")
    found = scoring.matches(pages, "id", {"urlPath": "path", "title": "title"}, scoring.rule_table(spark))
    got = {(r.id, r.track): r.score for r in scoring.scores(pages, "id", found).collect()}
    assert got == {(1, "A"): 11, (1, "B"): 0, (2, "A"): -7, (2, "B"): -7}


def test_page_functions(spark):
    html = '<html lang="fr"><head><title>A &amp; B</title></head><body><!-- <h1>no</h1> --><script>x</script><main><h2>Un<b> deux</b></h2><p>a<br>b</p><a href="/x">y</a><a href="mailto:z">m</a></main></body></html>'
    h = F.col("h")
    row = spark.createDataFrame([(html,)], "h string").select(web.title(h).alias("t"), web.declared_language(h).alias("l"), web.headings(h).alias("hs"), web.page_text(h).alias("p"), web.anchors(h).alias("a")).first()
    assert (row.t, row.l, [(x.level, x.text) for x in row.hs], row.p, [(x.href, x.text) for x in row.a]) == ("A & B", "fr", [(2, "Un deux")], "Un deux\na\nb\ny m", [("/x", "y")])
    assert one(spark, web.entities(F.col("c")), c="a&#233;&#x41;") == "aéA"


def test_robots():
    g = web.parse_robots("User-agent: *\nDisallow: /a\nAllow: /a/b$\n\nUser-agent: x\nDisallow:\n")
    assert [r["pattern"] for r in g[0]["rules"]] == ["/a", "/a/b$"] and g[1]["rules"] == []


def test_charset_sitemap_address(spark):
    assert web.resolve_charset(b"\xef\xbb\xbfx", None) == ("utf-8", "BOM") and web.resolve_charset(b"\xe9", None) == ("windows-1252", "FALLBACK")
    assert web.resolve_charset(b'<meta charset="iso-8859-1">', None)[1] == "META"
    assert web.parse_sitemap("<urlset><url><loc> a </loc></url></urlset>") == ("urlset", ["a"]) and web.parse_sitemap("<x") == ("unsupported", [])
    rows = spark.createDataFrame([("8.8.8.8",), ("10.0.0.1",), ("::1",), ("::ffff:10.0.0.1",), ("x",)], "a string").select(web.is_public_address("a").alias("p"), web.is_public_v4(F.col("a")).alias("v")).collect()
    assert [r.p for r in rows] == [True, False, False, False, None] and [r.v for r in rows] == [True, False, None, None, None]


def test_append_is_idempotent(spark, tmp_path):
    df, path = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string"), str(tmp_path / "t")
    assert store.append_if_absent(df, path, ["k"], dry_run=True)["inserted"] == 2
    assert store.append_if_absent(df, path, ["k"])["inserted"] == 2 and store.append_if_absent(df, path, ["k"])["inserted"] == 0


def test_breaker(spark):
    rows = spark.createDataFrame([(i, "h", f) for i, f in enumerate([True, True, False, True, True, True, False])], "t int, h string, f boolean")
    assert [r.open for r in graph.breaker(rows, "h", ["t"], "f").orderBy("t").collect()] == [False] * 6 + [True]


def test_quota(spark):
    rows = spark.createDataFrame([("a", "o1", 1), ("a", "o1", 2), ("a", "o2", 3), ("b", "o1", 4), ("b", "o3", 5)], "c string, o string, k int")
    assert [r.k for r in evaluation.quota_sample(rows, "c", "o", "k", {"a": 2, "b": 1}, 1).orderBy("k").collect()] == [1, 3, 5]


def test_workbook_and_strict_json(spark, tmp_path):
    sheet = '<worksheet xmlns="m"><sheetData><row r="2"><c r="A2" t="inlineStr"><is><t>Code</t></is></c><c r="C2" t="inlineStr"><is><t>Name</t></is></c></row><row r="3"><c r="A3"><v>7</v></c><c r="C3" t="s"><v>0</v></c></row></sheetData></worksheet>'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns="m" xmlns:r="r"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/s.xml"/></Relationships>')
        z.writestr("xl/worksheets/s.xml", sheet)
        z.writestr("xl/sharedStrings.xml", '<sst xmlns="m"><si><t>Uni</t></si></sst>')
    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.xlsx").write_bytes(buf.getvalue())
    found = readers.artifacts(spark, str(tmp_path / "w"))
    assert [(r.Code, r.Name) for r in readers.workbook(found, ["Code", "Name"]).collect()] == [("7", "Uni")] and found.first()["kind"] == "zip"
    (tmp_path / "j.json").write_text('[{"a": "1"}, {"a": "2", "b": null}]')
    schema = T.StructType().add("a", "string").add("b", "string")
    assert sorted(r.a for r in readers.strict_json(spark, str(tmp_path / "j.json"), schema).collect()) == ["1", "2"]
    with pytest.raises(ValueError):
        readers.strict_json(spark, str(tmp_path / "j.json"), T.StructType().add("a", "string"))


def test_stream_appends_once(spark, sf, tmp_path):
    from larkspar.streaming import incremental

    spark.read.parquet(f"{sf}/events.parquet").limit(50).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    for k in range(2):
        incremental.ingest(incremental.event_stream(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), ["event_id"], str(tmp_path / f"c{k}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_pages_with_numeric_entities(spark):
    html = ("<html><title>L&#39;&#xC9;cole &amp;#39; &#38;lt;</title><body><h1>Caf&#233; &#X1F600;</h1><p>&#x41;&lt;&#66;&#0067; &#xD800; &#99999999999;</p>"
            "<a href='/a&#63;b=1&amp;c'>it&#x27;s</a></body></html>")
    row = spark.createDataFrame([(html,)], "h string").select(
        web.title(F.col("h")).alias("title"), web.headings(F.col("h")).alias("headings"), web.html_text(web.main_html(F.col("h"))).alias("text"), web.anchors(F.col("h")).alias("anchors")).first()
    assert row.title == "L'École &#39; &lt;" and [tuple(h) for h in row.headings] == [(1, "Café \U0001f600")]
    assert row.text.split("\n")[1] == "A<B" + "C &#xD800; &#99999999999;"
    assert [tuple(a) for a in row.anchors] == [("/a?b=1&c", "it's")]


def test_redaction_is_match_by_match(spark):
    """A run without plus or separator is no phone number, and a match never reaches beyond its place."""
    phones = lambda t: one(spark, text.redact_phones(F.col("c")), c=t)
    assert phones("12345678 and AB12345678") == "12345678 and AB12345678"
    assert phones("01 23 45 67 89 or (030) 123 4567, years 2019-2020") == "[PHONE] or [PHONE], years 2019-2020"
    assert phones("+49 (0)30 1234567; x01 23 45 67 89") == "[PHONE]; x01 [PHONE]"
    assert phones("in 2019, page 12") == "in 2019, page 12" and phones("") == ""
    emails = lambda t: one(spark, text.redact_emails(F.col("c")), c=t)
    assert emails("a.b@c-d.fr, .x@y.z and q@-r.fr") == "[EMAIL], .[EMAIL] and q@-r.fr"


def test_folding_covers_every_precomposed_letter(spark):
    fold = lambda t: one(spark, text.accent_folded(F.col("c")), c=t)
    assert fold("řičný łódź škola ő ș Ňạẫ ή ё") == "ricny łodz skola o s Naa η е"
    import unicodedata

    for c in ("é", "Ǖ", "ệ", "ǘ", "ΐ", "й"):
        want = unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", c) if not "\u0300" <= x <= "\u036f"))
        assert fold(c) == want == fold(unicodedata.normalize("NFD", c))


def test_service_hosts_and_containers(spark):
    service = lambda h: one(spark, web.is_service_host(F.col("c")), c=h)
    assert [service(f"{x}.uni.fr") for x in ("ent", "smtp", "vpn", "espace-achat", "library", "portal", "espace", "mon-espace-x")] == [True] * 4 + [False] * 4
    page = """<body><nav>n</nav><div role="main">one</div><p>two</p></body>"""
    assert one(spark, web.main_html(F.col("c")), c=page) == "one" and one(spark, web.main_method(F.col("c")), c=page) == "MAIN_ELEMENT"
    assert one(spark, web.main_html(F.col("c")), c='<body><p role="main">open') == "open"
    assert one(spark, web.main_method(F.col("c")), c="<body>x</body>") == "FULL_BODY"
    links = one(spark, web.anchors(F.col("c")), c='<a href="file:///etc/x">f</a><a href="/a">a</a>')
    assert [x["href"] for x in links] == ["/a"]
