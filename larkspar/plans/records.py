"""Ingestion, handoff, request addresses and stored-row rules bound to the driver's tables, each with its SQL.

Faults are planted by a row's number, and the SQL says what each must lead to.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import requests, web
from ..operators import handoff, ingest, quality
from .catalog import query, table

_n = lambda c, m: F.col(c) % m


def _cases(column: str, m: int, cases: dict, otherwise):
    """cases by the column's remainder."""
    out = F.when(F.lit(False), None)
    for k, v in cases.items():
        out = out.when(_n(column, m) == k, v)
    return out.otherwise(otherwise)


# --- request addresses ---------------------------------------------------------------------------


_BAD_URLS = {0: (None, "blank"), 1: ("https://a b.example.com/", "interior_whitespace"), 2: ("www.example.com/x", "scheme_missing"), 3: ("http://exa<mple.com/", "unparsable"),
             4: ("mailto:office@example.com", "scheme_not_http"), 5: ("https://me:pw@example.com/", "userinfo_present"), 6: ("https://example.com/x#top", "fragment_present"),
             7: ("https://./x", "host_empty"), 8: ("https://www..example.com/", "host_empty_label"), 9: ("http://0x7f.1/", "host_is_ip_literal"), 10: ("http://localhost/x", "host_without_dot"),
             11: ("http://host.internal/", "no_icann_public_suffix"), 12: ("https://example.com:443/", "explicit_port")}
_PLAIN = r"regexp_replace(url, '#.*$', '')"


@query("request_urls", "SELECT page_id, " + "CASE page_id % 17 " + " ".join(f"WHEN {k} THEN '{r}'" for k, (_, r) in _BAD_URLS.items()) + " ELSE '' END AS reason, "
       + rf"CASE WHEN page_id % 17 > 12 THEN {_PLAIN} END AS url, CASE WHEN page_id % 17 > 12 THEN regexp_extract(url, '://[^/]*?([^./]+\.[^./]+)/', 1) END AS domain, "
       + rf"CASE WHEN page_id % 17 > 12 THEN regexp_extract({_PLAIN}, '://[^/]*(/.*)$', 1) END AS path FROM pages")
def request_urls(spark, d):
    raw = _cases("page_id", 17, {k: F.lit(v) for k, (v, _) in _BAD_URLS.items()}, F.regexp_replace("url", "#.*$", ""))
    rows = requests.with_request(table(spark, d, "pages").select("page_id", raw.alias("raw")), "raw")
    return rows.select("page_id", F.coalesce("request.reason", F.lit("")).alias("reason"), "request.url", "request.domain", "request.path")


@query("resolved_links", r"""WITH p AS (SELECT page_id, regexp_extract(url, '^([a-z]+):', 1) AS s, regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS o, regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1) AS path, regexp_extract(url, '(\?[^#]*)', 1) AS q FROM pages)
SELECT page_id, CASE page_id % 8 WHEN 0 THEN o || '/a/c?d=1' WHEN 1 THEN s || '://other.example.org/x/' WHEN 2 THEN o || path || '?page=9' WHEN 3 THEN o || path || q WHEN 4 THEN 'mailto:a@example.com'
WHEN 5 THEN o || regexp_replace(path, '[^/]*$', '') || 'next%20page.html' WHEN 6 THEN o || '/' WHEN 7 THEN 'https://sub.example.com/deep/' END AS resolved FROM p""")
def resolved_links(spark, d):
    href = _cases("page_id", 8, {0: F.lit("/a/./b/../c?d=1#x"), 1: F.lit("//OTHER.example.org/x/y/.."), 2: F.lit("?page=9"), 3: F.lit("#part"), 4: F.lit("mailto:a@example.com"),
                                 5: F.lit(" next page.html "), 6: F.lit("../../../../.."), 7: F.lit("HTTPS://sub.example.com:443/deep/x/../")}, F.lit(None))
    return requests.with_resolved(table(spark, d, "pages").select("page_id", "url", href.alias("href")), "url", "href").select("page_id", "resolved")


@query("robots_component", "SELECT page_id, '/caf%C3%A9/~' || page_id || '%2A*%24$%20%25x' AS path FROM pages")
def robots_component(spark, d):
    raw = F.concat(F.lit("/caf%c3%a9/%7e"), F.col("page_id").cast("string"), F.lit("%2a*%24$ %x"))
    return table(spark, d, "pages").select("page_id", requests.canonical_component(raw).alias("path"))


@query("redacted_targets", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN '[EMAIL]' WHEN 1 THEN '[PHONE]' END AS target FROM pages")
def redacted_targets(spark, d):
    href = _cases("page_id", 3, {0: F.lit(" MailTo:a@b.org"), 1: F.lit("tel:+33 1")}, F.col("url"))
    return table(spark, d, "pages").select("page_id", requests.redacted_target(href).alias("target"))


# --- rows on their way in ------------------------------------------------------------------------


@query("row_refusals", """SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN 'no_code' WHEN 1 THEN 'no_name' WHEN 2 THEN 'bad_country' WHEN 3 THEN 'delimiter_in_code' WHEN 4 THEN 'delimiter_in_number' WHEN 5 THEN 'no_code' ELSE '' END AS reason FROM customer""")
def row_refusals(spark, d):
    code = _cases("c_custkey", 9, {0: F.lit(" \t"), 3: F.lit("a|b"), 5: F.lit(None)}, F.col("c_name"))
    name = _cases("c_custkey", 9, {1: F.lit(" "), 5: F.lit(None)}, F.col("c_name"))
    number = _cases("c_custkey", 9, {4: F.lit("9|1")}, F.lit("91"))
    return table(spark, d, "customer").select("c_custkey", F.coalesce(ingest.refusal(code, name, _cases("c_custkey", 9, {2: F.lit("FRA")}, F.lit(" fr")), number), F.lit("")).alias("reason"))


@query("country_filter", "SELECT c_custkey FROM customer WHERE c_custkey % 4 = 1")
def country_filter(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", _cases("c_custkey", 4, {0: F.lit("de"), 1: F.lit(" fr "), 2: F.lit("FRA")}, F.lit(None)).alias("country"))
    return ingest.of_country(rows, "country", "FR").select("c_custkey")


def _register(spark, d):
    keys = ingest.keys_by_number(table(spark, d, "supplier").select(F.col("s_name").alias("code"), _cases("s_suppkey", 5, {0: F.lit(" ")}, F.col("s_nationkey").cast("string")).alias("number")), "code", "number")
    records = table(spark, d, "customer").select("c_custkey", F.when(_n("c_custkey", 6) != 0, (F.col("c_nationkey") + F.when(_n("c_custkey", 10) == 1, 100).otherwise(0)).cast("string")).alias("number"))
    return records, keys


_REGISTER = """WITH k AS (SELECT DISTINCT s_nationkey::VARCHAR AS number, upper(trim(s_name)) || '|' || s_nationkey AS row_key FROM supplier WHERE s_suppkey % 5 <> 0),
r AS (SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN (c_nationkey + CASE WHEN c_custkey % 10 = 1 THEN 100 ELSE 0 END)::VARCHAR END AS number FROM customer) """


@query("register_claims", _REGISTER + "SELECT c_custkey, row_key FROM r JOIN k USING (number)")
def register_claims(spark, d):
    return ingest.register_claims(*_register(spark, d)).select("c_custkey", "row_key")


@query("register_counts", _REGISTER + "SELECT count(*) FILTER (number IN (SELECT number FROM k)) AS matched, count(*) FILTER (number IS NOT NULL AND number NOT IN (SELECT number FROM k)) AS unmatched, count(*) FILTER (number IS NULL) AS uncomparable FROM r")
def register_counts(spark, d):
    return ingest.register_counts(*_register(spark, d))


@query("claim_insert", "SELECT count(*) AS offered, count(*) FILTER (o_orderkey % 3 <> 0) AS inserted, count(*) FILTER (o_orderkey % 3 = 0) AS already_present, count(c_custkey) AS linked FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_nationkey < 12) ON o_custkey = c_custkey")
def claim_insert(spark, d):
    claims = table(spark, d, "orders").select(F.lit("register").alias("kind"), "o_orderkey", F.col("o_custkey").alias("key"))
    organisations = table(spark, d, "customer").where("c_nationkey < 12").select(F.col("c_custkey").alias("key"), F.col("c_custkey").alias("org_id"))
    return ingest.insert_counts(ingest.bound(claims, organisations, "key", "org_id"), claims.where("o_orderkey % 3 = 0"), ["kind", "o_orderkey"], "org_id")


@query("claim_tallies", "SELECT count(*) FILTER (page_id % 3 = 0) AS structurally_valid, count(*) FILTER (page_id % 3 = 1) AS malformed, 0::BIGINT AS not_a_website, count(*) FILTER (page_id % 3 = 2) AS absent FROM pages")
def claim_tallies(spark, d):
    rows = table(spark, d, "pages").select(web.website(_cases("page_id", 3, {0: F.col("url"), 1: F.lit("two sites")}, F.lit(" "))).alias("claim"))
    return ingest.claim_tallies(rows.select("claim.status"), "status")


@query("entry_roots", "SELECT c_nationkey AS org_id, 'claim:' || c_custkey AS root FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT s_nationkey, 'promotion:' || s_suppkey FROM supplier")
def entry_roots(spark, d):
    claims = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("org_id"), F.when(_n("c_custkey", 3) == 0, "STRUCTURALLY_VALID").otherwise("ABSENT").alias("status"), F.lit("u").alias("url"))
    promotions = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("org_id"), F.lit("u").alias("url"))
    return ingest.entry_roots(claims, promotions).select("org_id", "root")


@query("first_seen", "SELECT event_id, CASE WHEN event_id <> min(event_id) OVER (PARTITION BY user_id, event_type) THEN 'ALREADY_SEEN' WHEN event_type = 'error' THEN 'BINARY_EXTENSION' ELSE 'ADMITTED' END AS outcome FROM events")
def first_seen(spark, d):
    url = F.concat(F.lit("https://a.example.com/"), "event_type", F.when(F.col("event_type") == "error", ".pdf").otherwise(""))
    return ingest.first_seen(table(spark, d, "events").select("event_id", F.col("user_id").alias("root"), url.alias("url")), "root", "url", "event_id").select("event_id", "outcome")


@query("ordinals", "SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1)::INTEGER - 1 AS ordinal, sha256(unnest(string_split(text, chr(10)))) AS entry FROM documents")
def ordinals(spark, d):
    return ingest.ordinals(table(spark, d, "documents").select("doc_id", F.split("text", "\n").alias("lines")), "doc_id", "lines").select("doc_id", "ordinal", F.sha2("entry", 256).alias("entry"))


@query("asserted_origins", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'one_without_the_other' WHEN 1 THEN 'not_a_time' ELSE '' END AS problem FROM orders")
def asserted_origins(spark, d):
    url = _cases("o_orderkey", 4, {0: F.lit(None), 3: F.lit(None)}, F.lit("https://a.example.com/"))
    at = _cases("o_orderkey", 4, {0: F.lit("2024-01-02T03:04:05Z"), 1: F.lit("soon"), 2: F.lit("2024-01-02T03:04:05Z")}, F.lit(None))
    return table(spark, d, "orders").select("o_orderkey", ingest.asserted_origin(url, at).alias("o")).select("o_orderkey", F.coalesce("o.problem", F.lit("")).alias("problem"))


@query("lookup_by_id_or_code", "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey = 7 OR upper(s_name) = '7'")
def lookup_by_id_or_code(spark, d):
    return ingest.by_id_or_code(table(spark, d, "supplier"), "s_suppkey", "s_name", "7", ["s_suppkey"]).select("s_suppkey", "s_name")


@query("of_artifacts", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_returnflag = 'R' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O')")
def of_artifacts(spark, d):
    latest = spark.createDataFrame([("R", "F"), ("N", "O")], "kind string, sha string")
    return ingest.of_artifacts(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("sha")), latest).select("l_orderkey", "l_linenumber")


@query("keys_with_code", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def keys_with_code(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.concat_ws("|", "c_mktsegment", F.col("c_custkey").cast("string")).alias("key"))
    return ingest.with_code(rows, "key", " building ").select("c_custkey")


# --- handoff -------------------------------------------------------------------------------------


@query("eligible_candidates", "SELECT l_orderkey, l_linenumber, c_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_returnflag = 'R' AND l_linenumber <= 3")
def eligible_candidates(spark, d):
    candidates = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("evidence_id"), F.col("l_returnflag").alias("run_id"), F.col("l_suppkey").alias("root"),
                                                    F.col("l_linestatus").alias("track"), F.col("l_linenumber").alias("rank"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("candidate_id"))
    evidence = table(spark, d, "orders").select(F.col("o_orderkey").alias("evidence_id"), F.col("o_custkey").alias("fetch_id"))
    fetches = table(spark, d, "customer").select(F.col("c_custkey").alias("fetch_id"), "c_name")
    return handoff.eligible(candidates, evidence, fetches, F.lit("R"), 3).select(F.col("evidence_id").alias("l_orderkey"), F.col("rank").alias("l_linenumber"), "c_name")


@query("latest_runs", """SELECT org_id, run_id FROM (SELECT l_suppkey AS org_id, o_orderkey AS run_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k
FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem) JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 5 <> 0 AND o_orderstatus = 'F') WHERE k = 1""")
def latest_runs(spark, d):
    orders = table(spark, d, "orders")
    runs = orders.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started_at"), (_n("o_orderkey", 5) == 0).alias("dry_run"))
    completions = orders.select(F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("FAILED").alias("state"))
    return handoff.latest_run(runs, completions, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run_id"), F.col("l_suppkey").alias("org_id")))


@query("reusable_calls", "SELECT o_orderkey AS call_id, o_custkey AS input, o_orderdate AS model FROM orders WHERE o_orderstatus = 'F'")
def reusable_calls(spark, d):
    orders = table(spark, d, "orders")
    calls = orders.select(F.col("o_orderkey").alias("call_id"), F.col("o_custkey").alias("input"), F.col("o_orderdate").alias("model"))
    return handoff.reusable(calls, orders.select(F.col("o_orderkey").alias("call_id"), F.when(F.col("o_orderstatus") == "F", "COMPLETED").otherwise("PARTIAL").alias("state")), ["input", "model"])


def _checked(spark, d):
    """Every conversation a batch; answers are left out, repeated, invented, too long or wrongly quoted by (conv_id + turn) % 7."""
    talk = table(spark, d, "conversations").withColumn("k", (F.col("conv_id") + F.col("turn")) % 7).where("conv_id % 5 < 4 OR turn = 0")
    documents = talk.select(F.col("conv_id").alias("batch"), F.col("turn").alias("doc_index"), F.lit("Office of Études").alias("title"), F.array(F.lit("First  heading"), F.lit("Second")).alias("headings"),
                            F.col("role").alias("excerpt"), F.lit("/office").alias("url_path"))
    span = lambda s, q: F.struct(F.lit(s).alias("source"), q.alias("quote"))
    quote = F.when(F.col("k") == 4, "not there").when(F.col("k") == 3, F.repeat(F.lit("x"), 201)).otherwise(F.col("role"))
    answer = talk.select(F.col("conv_id").alias("batch"), F.when(F.col("k") == 2, F.col("turn") + 1000).otherwise(F.col("turn")).alias("doc_index"), F.when(F.col("k") == 5, "Office of  Etudes").when(F.col("k") == 6, "office of etudes").alias("unit_name"),
                         F.when(F.col("k") == 5, F.repeat(F.lit("é"), 500)).otherwise("why").alias("rationale"), F.array(span("EXCERPT", quote), span("HEADING", F.lit("heading"))).alias("spans"), "k")
    results = answer.where("k <> 0").unionByName(answer.where("k = 1")).drop("k")
    return handoff.checked(documents, results)


_CHECKED = """WITH t AS (SELECT conv_id AS batch, turn, (conv_id + turn) % 7 AS k FROM conversations WHERE conv_id % 5 < 4 OR turn = 0), c AS (
SELECT batch, turn AS doc_index, CASE WHEN k < 3 THEN 'DOC_INDEX' WHEN k = 3 THEN 'LENGTH' WHEN k IN (4, 6) THEN 'EVIDENCE' ELSE '' END AS category, true AS sent FROM t
UNION ALL SELECT batch, turn + 1000, 'DOC_INDEX', false FROM t WHERE k = 2) """


@query("response_check", _CHECKED + "SELECT * FROM c")
def response_check(spark, d):
    return _checked(spark, d).withColumn("category", F.coalesce("category", F.lit("")))


@query("batch_terminal", _CHECKED + """, n AS (SELECT batch, count(*) FILTER (sent) AS n_documents, count(*) FILTER (category = '') AS n_accepted, count(*) FILTER (category = 'EVIDENCE') AS e, count(*) FILTER (category <> '') AS b FROM c GROUP BY 1)
SELECT batch, n_documents, n_accepted, CASE WHEN n_accepted = n_documents THEN 'COMPLETED' WHEN n_accepted > 0 THEN 'PARTIAL' ELSE 'FAILED' END AS state, CASE WHEN e > 0 THEN 'EVIDENCE_SPAN_UNVERIFIED' WHEN b > 0 THEN 'SCHEMA_INVALID' ELSE '' END AS error_kind FROM n""")
def batch_terminal(spark, d):
    return handoff.terminal(_checked(spark, d)).withColumn("error_kind", F.coalesce("error_kind", F.lit("")))


#: (message, subtype, is_error, stop reason, has output, kind that must come of it)
_ENDS = [("", "success", False, None, True, "OK"), ("", "success", False, "refusal", True, "PROVIDER_REFUSAL"), ("", "success", False, None, False, "STRUCTURED_OUTPUT_FAILED"),
         ("Limit reached: wait", "success", True, None, False, "USAGE_LIMIT_EXHAUSTED"), ("HTTP 401 here", "error_during_execution", True, None, False, "AUTH_FAILURE"),
         ("stopped", "error_during_execution", True, "refusal", False, "PROVIDER_REFUSAL"), ("it timed out", "error_max_structured_output_retries", True, None, False, "STRUCTURED_OUTPUT_FAILED"),
         ("it Timed Out", "error_max_turns", True, None, False, "TIMEOUT"), ("", "error_max_turns", True, None, False, "STRUCTURED_OUTPUT_FAILED"),
         ("API Error: 400 input_schema", "error_during_execution", True, None, False, "STRUCTURED_OUTPUT_FAILED"), ("odd", "error_during_execution", True, None, False, "PROVIDER_TRANSIENT"),
         ("Limit reached after timeout", None, None, None, None, "TIMEOUT"), ("Unauthorized", None, None, None, None, "AUTH_FAILURE"), ("reset", None, None, None, None, "PROVIDER_TRANSIENT")]


@query("attempt_kinds", "SELECT event_id, [" + ", ".join(f"'{e[5]}'" for e in _ENDS) + f"][(event_id % {len(_ENDS)} + 1)::INTEGER] AS kind FROM events")
def attempt_kinds(spark, d):
    pick = lambda i, t: _cases("event_id", len(_ENDS), {k: F.lit(e[i]).cast(t) for k, e in enumerate(_ENDS)}, F.lit(None))
    kind = handoff.attempt_kind(pick(0, "string"), pick(1, "string"), pick(2, "boolean"), pick(3, "string"), pick(4, "boolean"), ["Limit reached"])
    return table(spark, d, "events").select("event_id", kind.alias("kind"))


@query("retry_delays", "SELECT event_id, (500 * 2 ** (event_id % 4))::BIGINT AS delay_ms FROM events")
def retry_delays(spark, d):
    return table(spark, d, "events").select("event_id", handoff.retry_delay_ms(_n("event_id", 4)).alias("delay_ms"))


@query("category_labels", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'UNIT:' || lang WHEN 1 THEN 'NEG:' || source ELSE 'REVIEW' END AS label FROM documents")
def category_labels(spark, d):
    verdict = _cases("doc_id", 3, {0: F.lit("UNIT_PAGE"), 1: F.lit("NOT_A_UNIT")}, F.lit("NEEDS_REVIEW"))
    return table(spark, d, "documents").select("doc_id", handoff.category_label(verdict, F.col("lang"), F.col("source")).alias("label"))


@query("bounded_headings", "SELECT doc_id, least(len(string_split(text, chr(10))), 12)::BIGINT AS n, list_sum([least(length(x), 200) FOR x IN string_split(text, chr(10))[1:12]])::BIGINT AS chars FROM documents")
def bounded_headings(spark, d):
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(F.lit(2).alias("level"), x.alias("text")))
    h = table(spark, d, "documents").select("doc_id", handoff.bounded_headings(lines).alias("h"))
    return h.select("doc_id", F.size("h").cast("long").alias("n"), F.aggregate("h", F.lit(0).cast("long"), lambda a, x: a + F.char_length(x["text"])).alias("chars"))


@query("parsed_signals", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'not_an_array' WHEN 1 THEN 'no_id' WHEN 2 THEN 'unknown_kind' WHEN 3 THEN 'no_field' ELSE '' END AS problem, CASE WHEN event_id % 5 = 4 THEN 2 ELSE 0 END AS n FROM events")
def parsed_signals(spark, d):
    ok = '{"id":"a","kind":"veto","field":"title"}'
    raw = _cases("event_id", 5, {0: F.lit(ok), 1: F.lit(f'[{ok},{{"id":"","kind":"veto","field":"x"}}]'), 2: F.lit('[{"id":"a","kind":"new","field":"x"}]'), 3: F.lit('[{"id":"a","kind":"veto"}]')}, F.lit(f"[{ok},{ok}]"))
    rows = table(spark, d, "events").select("event_id", handoff.parsed_signals(raw).alias("s"))
    return rows.select("event_id", F.coalesce("s.problem", F.lit("")).alias("problem"), F.when(F.col("s.signals").isNotNull(), F.size("s.signals")).otherwise(0).alias("n"))


# --- rules of stored rows ------------------------------------------------------------------------


def _broken(name: str, source: str, key: str, rows, rules, expected: dict[str, str]):
    """Register a query of rule counts; expected gives each rule's broken rows as a condition on the key."""
    sql = " UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) FILTER ({condition}) AS n FROM {source}" for r, condition in expected.items())
    query(name, sql)(lambda spark, d: quality.violations(rows(table(spark, d, source)), rules()))


_SHA = "ab" * 32


def _snapshots(df):
    k = "o_orderkey"
    return df.select(_cases(k, 11, {0: F.lit("AB" * 32)}, F.lit(_SHA)).alias("sha"), _cases(k, 11, {1: F.lit(0)}, F.lit(9)).alias("byte_count"), _cases(k, 11, {2: F.lit(-1)}, F.lit(0)).alias("host_count"), F.lit(1).alias("entity_count"),
                     F.lit(None).cast("int").alias("id_count"), F.lit(0).alias("api_count"), _cases(k, 11, {3: F.lit("found"), 5: F.lit("operator_file"), 7: F.lit("operator_file")}, F.lit("official_endpoint")).alias("kind"),
                     _cases(k, 11, {4: F.lit("https://elsewhere.example.org/x.xml"), 5: F.lit(None), 6: F.lit(None), 7: F.lit(None)}, F.lit("https://registry.example.org/x.xml")).alias("origin_url"), _cases(k, 11, {5: F.lit("t"), 6: F.lit("t")}, F.lit(None)).alias("origin_at"))


_broken("dq_snapshots", "orders", "o_orderkey", _snapshots, lambda: quality.snapshot_rules(r"^https://registry\.example\.org/[^ ]*\.xml$"),
        {"sha_shape": "o_orderkey % 11 = 0", "bytes_positive": "o_orderkey % 11 = 1", "counts": "o_orderkey % 11 = 2", "kind_known": "o_orderkey % 11 = 3", "origin_shape": "o_orderkey % 11 = 4",
         "origin_pair": "o_orderkey % 11 IN (5, 6)", "fetched_has_origin": "o_orderkey % 11 = 6"})


def _completions(df):
    k = "o_orderkey"
    return df.select(_cases(k, 9, {0: F.lit("DONE"), 1: F.lit("COMPLETED"), 2: F.lit("COMPLETED"), 3: F.lit("PARTIAL")}, F.lit("FAILED")).alias("state"), _cases(k, 9, {1: F.lit("OTHER"), 2: F.lit(None), 3: F.lit(None), 4: F.repeat(F.lit("x"), 65)}, F.lit("TIMEOUT")).alias("error_kind"),
                     _cases(k, 9, {5: F.repeat(F.lit("y"), 2001)}, F.lit(None)).alias("error_summary"), _cases(k, 9, {6: F.lit(-1)}, F.lit(None)).alias("input_tokens"), F.lit(3).alias("output_tokens"))


_broken("dq_run_completions", "orders", "o_orderkey", _completions, lambda: quality.completion_rules(["COMPLETED", "FAILED", "ABORTED"]),
        {"state_known": "o_orderkey % 9 IN (0, 3)", "completed_is_clean": "o_orderkey % 9 = 1", "summary_bounded": "o_orderkey % 9 = 5", "kind_bounded": "o_orderkey % 9 = 4"})
_broken("dq_call_completions", "orders", "o_orderkey", _completions, lambda: quality.completion_rules(["COMPLETED", "PARTIAL", "FAILED"], quality.CALL_ERRORS),
        {"state_known": "o_orderkey % 9 = 0", "completed_is_clean": "o_orderkey % 9 = 1", "summary_bounded": "o_orderkey % 9 = 5", "kind_known": "o_orderkey % 9 = 4", "incomplete_has_error": "o_orderkey % 9 = 3", "tokens": "o_orderkey % 9 = 6"})


def _fetches(df):
    k = "event_id"
    some = lambda at, v, other=None: _cases(k, 13, {i: F.lit(v) for i in at}, F.lit(other))
    return df.select(some([0], None, 1).alias("claim_id"), some([1], 2).cast("int").alias("promotion_id"), some([2], "ROOT", "LINK").alias("discovery"), some([3], None, "https://a.example.com/").alias("parent_url"),
                     some([4, 5], None, 200).alias("http_status"), some([5], "TLS_FAILURE").alias("error_kind0"), some([6], "ODD").alias("e6"), some([7], "xyz", "ab" * 32).alias("sha"), some([8], None, 10).alias("byte_count"),
                     some([9], True, False).alias("truncated"), some([10], "utf-8").alias("charset"), some([], "BOM").cast("string").alias("charset_source"), some([10], "DECLARED").alias("charset_confidence"),
                     some([11], "IPV4").alias("ip_family"), some([], True).cast("boolean").alias("ip_public"), some([12], 99).alias("s12")).select(
        "*", F.coalesce("error_kind0", "e6").alias("error_kind")).withColumn("http_status", F.coalesce("s12", "http_status"))


_broken("dq_fetches", "events", "event_id", _fetches, lambda: quality.fetch_rules(),
        {"one_root": "event_id % 13 IN (0, 1)", "root_has_no_parent": "event_id % 13 = 2", "link_has_parent": "event_id % 13 = 3", "status_or_error": "event_id % 13 = 4", "status_range": "event_id % 13 = 12", "error_known": "event_id % 13 = 6",
         "sha_shape": "event_id % 13 = 7", "body_pair": "event_id % 13 = 8", "truncated_has_body": "false", "charset_triple": "event_id % 13 = 10", "ip_pair": "event_id % 13 = 11"})


def _redirects(df):
    k = "page_id"
    return df.select(_cases(k, 7, {0: F.lit(200)}, F.lit(301)).alias("http_status"), _cases(k, 7, {1: F.lit(True), 2: F.lit(True)}, F.lit(False)).alias("malformed"), _cases(k, 7, {2: F.lit(None), 3: F.lit(None)}, F.col("url")).alias("to_url"),
                     _cases(k, 7, {2: F.lit(None), 4: F.lit(None), 5: F.lit(None)}, F.lit(False)).alias("downgraded"), _cases(k, 7, {2: F.lit(None), 5: F.lit(None), 6: F.lit(False)}, F.lit(True)).alias("host_changed"),
                     _cases(k, 7, {2: F.lit(None), 5: F.lit(None)}, F.lit(True)).alias("domain_changed"))


_broken("dq_redirects", "pages", "page_id", _redirects, lambda: quality.redirect_rules(),
        {"status_range": "page_id % 7 = 0", "malformed_iff_unresolved": "page_id % 7 IN (1, 3)", "facts_iff_resolved": "page_id % 7 IN (3, 5)", "facts_complete": "page_id % 7 IN (4, 5)", "domain_implies_host": "page_id % 7 = 6"})


def _calls(df):
    k = "o_orderkey"
    return df.select(_cases(k, 7, {0: F.lit("[1]"), 1: F.lit('{"max":1,"apiKey":"x"}'), 2: F.concat(F.lit('{"a":"'), F.repeat(F.lit("z"), 2000), F.lit('"}'))}, F.lit('{"tokens":5}')).alias("request_config"),
                     _cases(k, 7, {3: F.lit("ab")}, F.lit(_SHA)).alias("input_sha"), _cases(k, 7, {4: F.lit(0)}, F.lit(1)).alias("n_documents"), _cases(k, 7, {5: F.lit(0)}, F.lit(1)).alias("attempt_no"))


_broken("dq_calls", "orders", "o_orderkey", _calls, lambda: quality.call_rules(),
        {"config_object": "o_orderkey % 7 = 0", "no_secrets": "o_orderkey % 7 = 1", "config_bounded": "o_orderkey % 7 = 2", "sha_shape": "o_orderkey % 7 = 3", "documents": "o_orderkey % 7 = 4", "attempt": "o_orderkey % 7 = 5"})


def _classifications(df):
    k = "doc_id"
    span = lambda **f: F.create_map(*[F.lit(x) for kv in f.items() for x in kv])
    good = span(source="TITLE", quote="q")
    spans = _cases(k, 12, {0: F.array().cast("array<map<string,string>>"), 1: F.array(*[good] * 5), 2: F.array(good, span(source="TITLE", quote="q", more="x")), 3: F.array(span(source="BODY", quote="q")), 4: F.array(good, span(source="TITLE", quote=""))}, F.array(good))
    return df.select(_cases(k, 12, {5: F.lit("NOT_A_UNIT"), 6: F.lit("MAYBE")}, F.lit("UNIT_PAGE")).alias("verdict"), _cases(k, 12, {5: F.lit(None), 6: F.lit(None)}, F.lit("OTHER_UNIT")).alias("unit_type"), F.lit(None).cast("string").alias("page_kind"),
                     _cases(k, 12, {5: F.lit(None), 6: F.lit(None), 7: F.lit("PERHAPS"), 8: F.lit(None)}, F.lit("YES")).alias("incoming"), _cases(k, 12, {9: F.lit("")}, F.lit("Office")).alias("unit_name"),
                     _cases(k, 12, {10: F.repeat(F.lit("é"), 501)}, F.repeat(F.lit("é"), 500)).alias("rationale"), _cases(k, 12, {11: F.lit("SURE")}, F.lit("HIGH")).alias("confidence"), spans.alias("spans"))


_broken("dq_classifications", "documents", "doc_id", _classifications, lambda: quality.classification_rules(["incoming"]),
        {"spans_count": "doc_id % 12 IN (0, 1)", "span_keys": "doc_id % 12 = 2", "span_source": "doc_id % 12 = 3", "span_quote": "doc_id % 12 = 4", "kind_iff_not": "doc_id % 12 = 5", "verdict_known": "doc_id % 12 = 6",
         "type_iff_unit": "false", "axes_known": "doc_id % 12 = 7", "axes_iff_unit": "doc_id % 12 = 8", "name_bounded": "doc_id % 12 = 9", "rationale_bounded": "doc_id % 12 = 10", "confidence_known": "doc_id % 12 = 11"})


@query("duplicate_ranks", "SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_ranks(spark, d):
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_suppkey", "l_linenumber"])
