"""The operators bound to the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, web
from ..operators import batching, claims, evaluation, evidence, graph, quality, reconcile, scoring, store
from . import records  # noqa: F401
from .catalog import QUERIES, SQL, query, table  # noqa: F401


# --- reconciliation: customers publish (key, nation), suppliers publish the same -----------------


def _published(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("id1"), F.when(F.col("c_custkey") % 11 != 0, F.col("c_nationkey")).alias("id2"))


def _reconciled(spark, d):
    return reconcile.reconcile(_published(spark, d), "id1", "id2", _entities(spark, d), "s_suppkey", "ids1", "ids2")


def _entities(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", F.array("s_suppkey").alias("ids1"), F.array("s_nationkey").alias("ids2"))


_RECONCILED = """
WITH l AS (SELECT c_custkey, c_custkey AS id1, CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END AS id2 FROM customer),
a AS (SELECT s_suppkey AS v, list_sort(list(DISTINCT s_suppkey)) AS hits FROM supplier GROUP BY 1),
b AS (SELECT s_nationkey AS v, list_sort(list(DISTINCT s_suppkey)) AS hits FROM supplier GROUP BY 1),
j AS (SELECT c_custkey, id1, id2, coalesce(a.hits, []) AS p, coalesce(b.hits, []) AS e FROM l LEFT JOIN a ON id1 = a.v LEFT JOIN b ON id2 = b.v),
r AS (SELECT *, CASE WHEN len(p) > 0 AND len(e) > 0 AND NOT list_has_any(p, e) THEN 'MATCH_BOTH_CONFLICT'
  WHEN len(p) = 1 AND len(e) = 1 THEN 'MATCH_BOTH_AGREE' WHEN len(p) > 0 AND len(e) > 0 THEN 'MATCH_BOTH_AMBIGUOUS'
  WHEN len(p) = 1 THEN 'MATCH_FIRST_ONLY' WHEN len(p) > 1 THEN 'MATCH_FIRST_ONLY_AMBIGUOUS'
  WHEN len(e) = 1 THEN 'MATCH_SECOND_ONLY' WHEN len(e) > 1 THEN 'MATCH_SECOND_ONLY_AMBIGUOUS' ELSE 'NO_MATCH' END AS verdict FROM j),
g AS (SELECT *, CASE WHEN verdict = 'MATCH_BOTH_CONFLICT' THEN 'CONFLICT' WHEN verdict LIKE '%AMBIGUOUS' THEN 'AMBIGUOUS'
  WHEN verdict = 'NO_MATCH' THEN 'NO_MATCH' ELSE 'UNIQUE' END AS grade FROM r)
"""


def _verdict(v, h):
    return f"CASE WHEN {v} IS NULL THEN 'UNKNOWN' WHEN len({h}) = 0 THEN 'NO_MATCH' WHEN len({h}) = 1 THEN 'MATCH' ELSE 'MATCH_MULTI' END"


@query("reconcile_rows", _RECONCILED + f"SELECT c_custkey, {_verdict('id1', 'p')} AS first_verdict, {_verdict('id2', 'e')} AS second_verdict, len(e)::BIGINT AS n_second, verdict, grade FROM g")
def reconcile_rows(spark, d):
    return _reconciled(spark, d).select("c_custkey", "first_verdict", "second_verdict", F.col("second_n").alias("n_second"), "verdict", "grade")


@query("reconcile_summary", _RECONCILED + """
SELECT count(*) AS total, count(*) AS comparable, 0::BIGINT AS unusable, count(*) FILTER (len(p) > 0) AS by_first, count(*) FILTER (len(e) > 0) AS by_second,
count(*) FILTER (len(p) > 0 AND len(e) > 0) AS by_both, count(*) FILTER (len(p) > 0 AND len(e) = 0) AS first_only, count(*) FILTER (len(p) = 0 AND len(e) > 0) AS second_only,
count(*) FILTER (len(p) > 0 OR len(e) > 0) AS either, count(*) FILTER (len(p) = 0 AND len(e) = 0) AS neither, count(*) FILTER (verdict = 'MATCH_BOTH_AGREE') AS agree,
count(*) FILTER (verdict = 'MATCH_BOTH_CONFLICT') AS conflict, count(*) FILTER (verdict = 'MATCH_BOTH_AMBIGUOUS') AS ambiguous_both, count(*) FILTER (grade = 'UNIQUE') AS grade_unique,
count(*) FILTER (grade = 'AMBIGUOUS') AS grade_ambiguous, count(*) FILTER (grade = 'CONFLICT') AS grade_conflict, count(*) FILTER (grade = 'NO_MATCH') AS grade_no_match FROM g""")
def reconcile_summary(spark, d):
    return reconcile.summary(_reconciled(spark, d))


@query("reconcile_grades", _RECONCILED + "SELECT grade, count(*) AS n FROM g GROUP BY 1")
def reconcile_grades(spark, d):
    return reconcile.grades(_reconciled(spark, d))


@query("reverse_coverage", _RECONCILED + """, x AS (SELECT DISTINCT unnest(list_concat(p, e)) AS s FROM g)
SELECT count(*) FILTER (s IS NOT NULL) AS reached, count(*) FILTER (s IS NULL) AS unreached FROM supplier LEFT JOIN x ON s_suppkey = s""")
def reverse_coverage(spark, d):
    return reconcile.reverse_coverage(_published(spark, d), "id1", "id2", _entities(spark, d), "s_suppkey", "ids1", "ids2")


@query("shared_identifiers", "SELECT s_nationkey AS value, count(DISTINCT s_suppkey) AS n_entities, min(s_suppkey) AS least, max(s_suppkey) AS greatest FROM supplier GROUP BY 1 HAVING count(DISTINCT s_suppkey) > 1")
def shared_identifiers(spark, d):
    return reconcile.shared_identifiers(table(spark, d, "supplier"), "s_nationkey", "s_suppkey")


@query("multi_valued", "SELECT l_orderkey, count(DISTINCT l_suppkey) AS n_values FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def multi_valued(spark, d):
    return reconcile.multi_valued(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


_LONG = "SELECT 'c_nationkey' AS field, c_nationkey::VARCHAR AS value FROM customer UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM customer UNION ALL SELECT 'c_name', c_name FROM customer"
_DUPLICATE_FIELDS = ["c_nationkey", "c_mktsegment", "c_name"]


@query("identifier_duplicates", f"SELECT * FROM (SELECT field, value, n, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS rank FROM (SELECT field, value, count(*) AS n FROM ({_LONG}) WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)) WHERE rank <= 20")
def identifier_duplicates(spark, d):
    return reconcile.duplicates(table(spark, d, "customer"), _DUPLICATE_FIELDS)


@query("identifier_surplus", f"SELECT field, count(DISTINCT value) AS n_distinct, count(value) AS n_values, count(value) - count(DISTINCT value) AS surplus FROM ({_LONG}) GROUP BY 1")
def identifier_surplus(spark, d):
    return reconcile.surplus(table(spark, d, "customer"), _DUPLICATE_FIELDS)


_HOST = "lower(regexp_extract({0}, '^[a-z]+://([^/?#:]+)', 1))"


@query("value_tally", f"WITH n AS (SELECT {_HOST.format('url')} AS h, count(*) AS n FROM pages GROUP BY 1) SELECT count(*) AS n_distinct, count(*) FILTER (n > 1) AS n_shared, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows_on_shared FROM n")
def value_tally(spark, d):
    return reconcile.tally(table(spark, d, "pages").select(web.host(F.col("url")).alias("h")), "h")


@query("domain_shape_overlap", _RECONCILED + """SELECT count(dom) AS with_domain, count(s) AS equals_entity, count(*) FILTER (list_contains(p, s) OR list_contains(e, s)) AS corroborated
FROM (SELECT *, CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 13)::VARCHAR END AS dom FROM g)
LEFT JOIN (SELECT lower(s_suppkey::VARCHAR) AS f, min(s_suppkey) AS s FROM supplier GROUP BY 1) ON lower(dom) = f""")
def domain_shape_overlap(spark, d):
    left = _published(spark, d).withColumn("dom", F.when(F.col("c_custkey") % 5 != 0, (F.col("c_custkey") % 13).cast("string")))
    return reconcile.domain_overlap(left, "dom", "id1", "id2", _entities(spark, d), "s_suppkey", "s_suppkey", "ids1", "ids2")


# --- website claims ------------------------------------------------------------------------------


def _claims(spark, d):
    """A page's own address, and a rewritten one as the second source's claim."""
    pages = table(spark, d, "pages").select("page_id", "url")
    other = F.when(F.col("page_id") % 7 == 0, F.lit(None)).when(F.col("page_id") % 7 == 1, F.concat(F.lit("http//"), F.split_part("url", F.lit("://"), F.lit(2)))) \
        .when(F.col("page_id") % 7 == 2, F.lit("office@example.com")).when(F.col("page_id") % 7 == 3, F.lit("ftp://example.com/x")) \
        .when(F.col("page_id") % 7 == 4, F.lit("localhost")).when(F.col("page_id") % 7 == 5, F.regexp_replace("url", "example", "sample")) \
        .otherwise(F.regexp_replace("url", r"://(www|m|blog)\.", "://"))
    return pages.select("page_id", web.website(F.col("url")).alias("claim")), pages.select("page_id", web.website(other).alias("claim"))


_CLAIMS = r"""
WITH raw AS (SELECT page_id, 'l' AS side, url AS v FROM pages UNION ALL
  SELECT page_id, 'r', CASE page_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'http//' || split_part(url, '://', 2) WHEN 2 THEN 'office@example.com' WHEN 3 THEN 'ftp://example.com/x'
    WHEN 4 THEN 'localhost' WHEN 5 THEN replace(url, 'example', 'sample') ELSE regexp_replace(url, '://(www|m|blog)\.', '://') END FROM pages),
f AS (SELECT *, CASE WHEN regexp_matches(v, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN v ELSE 'https://' || v END AS u FROM raw),
h AS (SELECT *, lower(regexp_extract(u, '^[A-Za-z]+://([^/?#:]+)', 1)) AS host FROM f),
c AS (SELECT *, CASE WHEN v IS NULL THEN 'blank' WHEN regexp_matches(v, '^(https?|ftps?)//') THEN 'broken_scheme' WHEN contains(regexp_extract(u, '://([^/?#]*)', 1), '@') THEN 'userinfo_present'
  WHEN NOT regexp_matches(u, '^https?:') THEN 'non_http_scheme' WHEN NOT contains(host, '.') THEN 'host_without_dot' WHEN NOT regexp_matches(host, '\.(com|org|net)$') THEN 'no_icann_public_suffix' END AS reason FROM h),
s AS (SELECT page_id, side, coalesce(reason, '') AS reason, CASE WHEN reason IS NULL THEN 'STRUCTURALLY_VALID' WHEN reason = 'blank' THEN 'ABSENT'
  WHEN reason IN ('userinfo_present', 'non_http_scheme', 'no_icann_public_suffix') THEN 'NOT_A_WEBSITE' ELSE 'MALFORMED' END AS status,
  CASE WHEN reason IS NULL THEN host END AS hostname, CASE WHEN reason IS NULL THEN regexp_extract(host, '([^.]+\.[^.]+)$', 1) END AS domain FROM c),
p AS (SELECT l.page_id, l.hostname = r.hostname AND l.status = 'STRUCTURALLY_VALID' AND r.status = 'STRUCTURALLY_VALID' AS hosts_equal,
  CASE WHEN l.status = 'STRUCTURALLY_VALID' AND r.status = 'STRUCTURALLY_VALID' THEN CASE WHEN l.domain = r.domain THEN 'DOMAIN_AGREE' ELSE 'DOMAIN_DISAGREE' END
  WHEN l.status = 'STRUCTURALLY_VALID' OR r.status = 'STRUCTURALLY_VALID' THEN 'ONE_SIDE_MISSING' ELSE 'NOT_COMPARABLE' END AS verdict
  FROM s l JOIN s r USING (page_id) WHERE l.side = 'l' AND r.side = 'r')
"""


@query("url_classify", _CLAIMS + "SELECT page_id, status, reason, hostname, domain FROM s WHERE side = 'r'")
def url_classify(spark, d):
    _, right = _claims(spark, d)
    return right.select("page_id", "claim.status", F.coalesce("claim.reason", F.lit("")).alias("reason"), "claim.hostname", "claim.domain")


@query("claim_pairs", _CLAIMS + "SELECT page_id, verdict, coalesce(hosts_equal, false) AS hosts_equal FROM p")
def claim_pairs(spark, d):
    return claims.compare(*_claims(spark, d), "page_id").select("page_id", "verdict", "hosts_equal")


@query("claim_summary", _CLAIMS + "SELECT count(*) FILTER (verdict = 'DOMAIN_AGREE') AS domain_agree, count(*) FILTER (verdict = 'DOMAIN_DISAGREE') AS domain_disagree, count(*) FILTER (verdict = 'ONE_SIDE_MISSING') AS one_side_missing, count(*) FILTER (verdict = 'NOT_COMPARABLE') AS not_comparable, count(*) FILTER (hosts_equal) AS hosts_equal FROM p")
def claim_summary(spark, d):
    return claims.summary(claims.compare(*_claims(spark, d), "page_id"))


@query("structure_summary", _CLAIMS + "SELECT status, reason, count(*) AS n FROM s WHERE side = 'r' GROUP BY 1, 2")
def structure_summary(spark, d):
    return claims.structure(_claims(spark, d)[1])


# --- reads and stores ----------------------------------------------------------------------------


@query("latest_artifact", "SELECT event_type, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def latest_artifact(spark, d):
    return store.latest(table(spark, d, "events").select("event_type", "ts", "event_id"), "event_type", "ts", "event_id")


@query("distinct_on_first", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def distinct_on_first(spark, d):
    return store.first_per_key(table(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("append_if_absent", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def append_if_absent(spark, d):
    new = table(spark, d, "customer").select("c_custkey", "c_name")
    return store.absent(new.unionByName(new), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("upsert_counts", "SELECT CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders) THEN 'inserted' WHEN c_mktsegment = 'BUILDING' THEN 'updated' ELSE 'unchanged' END AS action, count(*) AS n FROM customer GROUP BY 1")
def upsert_counts(spark, d):
    """The store holds the customers with orders, one segment's balances out of date."""
    now = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    held = now.join(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    old = held.withColumn("c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return store.action_counts(store.upsert_actions(old, now, "c_custkey", ["c_name", "c_acctbal"]))


@query("anti_revocation", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def anti_revocation(spark, d):
    gone = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey").join(gone, "o_orderkey", "left_anti")


@query("left_completion", "SELECT o_orderstatus, count(*) AS n, count(l) AS completed FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem WHERE l_linestatus = 'F') ON o_orderkey = l GROUP BY 1")
def left_completion(spark, d):
    done = table(spark, d, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(1).alias("done")).distinct()
    return store.with_completion(table(spark, d, "orders"), done, "o_orderkey").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count("done").alias("completed"))


@query("scalar_subquery_count", "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders FROM customer")
def scalar_subquery_count(spark, d):
    n = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, d, "customer").select("c_custkey").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0).cast("long")).alias("n_orders"))


@query("provenance_join", "SELECT n_name, count(*) AS n, count(DISTINCT o_orderkey) AS n_orders FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def provenance_join(spark, d):
    rows = (table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")))
    return rows.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("n_orders"))


@query("group_counts", "SELECT l_returnflag, count(*) AS n, count(CASE WHEN l_discount > 0 THEN l_discount END) AS n_discounted FROM lineitem GROUP BY 1")
def group_counts(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("l_discount") > 0, F.col("l_discount"))).alias("n_discounted"))


@query("multi_distinct_topn", "SELECT p_brand, count(DISTINCT p_type) AS n_types, count(DISTINCT p_size) AS n_sizes FROM part GROUP BY 1 ORDER BY n_sizes DESC, p_brand LIMIT 10")
def multi_distinct_topn(spark, d):
    return (table(spark, d, "part").groupBy("p_brand").agg(F.countDistinct("p_type").alias("n_types"), F.countDistinct("p_size").alias("n_sizes"))
            .orderBy(F.desc("n_sizes"), "p_brand").limit(10))


@query("filtered_list", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 7 ORDER BY c_name, c_custkey LIMIT 50")
def filtered_list(spark, d):
    return table(spark, d, "customer").where("c_nationkey = 7").orderBy("c_name", "c_custkey").select("c_custkey", "c_name").limit(50)


# --- pages ---------------------------------------------------------------------------------------


_STRIPPED = r"regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g')"


def _clean(x):
    """Tags to spaces, named entities, white space collapsed."""
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for name, to in [*((k, v) for k, v in web.ENTITIES.items() if k != "amp"), ("amp", "&")]:
        quoted = to.replace("'", "''")
        x = f"replace({x}, '&{name};', '{quoted}')"
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


@query("page_title_lang", rf"""SELECT page_id, {_clean("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title, regexp_extract(nullif(trim(regexp_extract(html, '(?is)<html\b[^>]*\blang\s*=\s*["'']([^"'']+)["'']', 1)), ''), '^[A-Za-z0-9-]+$') AS lang FROM pages""")
def page_title_lang(spark, d):
    h = F.col("html")
    return table(spark, d, "pages").select("page_id", web.title(h).alias("title"), web.declared_language(h).alias("lang"))


@query("page_headings", rf"""SELECT page_id, sum(n)::BIGINT AS n_headings FROM (SELECT page_id, len(regexp_extract_all({_STRIPPED}, '(?is)<h1\b[^>]*>.*?</h1\s*>')) + len(regexp_extract_all({_STRIPPED}, '(?is)<h2\b[^>]*>.*?</h2\s*>')) + len(regexp_extract_all({_STRIPPED}, '(?is)<h3\b[^>]*>.*?</h3\s*>')) AS n FROM pages) GROUP BY 1""")
def page_headings(spark, d):
    return table(spark, d, "pages").select("page_id", F.size(web.headings(F.col("html"))).cast("long").alias("n_headings"))


@query("anchors", rf"""SELECT page_id, least(len(list_filter(regexp_extract_all({_STRIPPED}, '(?is)<a\b[^>]*?\bhref=["'']([^"'']*)["''][^>]*>.*?</a\s*>', 1), lambda h: trim(h) <> '' AND NOT regexp_matches(trim(h), '(?i)^(mailto|tel|javascript|data|ftp):|^#|[<>]'))), 200)::BIGINT AS n_links FROM pages""")
def anchors(spark, d):
    return table(spark, d, "pages").select("page_id", F.size(web.anchors(F.col("html"))).cast("long").alias("n_links"))


@query("page_text")
def page_text(spark, d):
    return evidence.extract(table(spark, d, "pages")).select("page_id", "title", F.char_length("main_text").alias("main_text_chars"), F.sha2("main_text", 256).alias("main_text_sha256"))


@query("chrome_lines", """WITH p AS (SELECT source AS g, doc_id, list_distinct(string_split(text, chr(10))) AS ls FROM documents), n AS (SELECT g, count(*) AS c FROM p GROUP BY 1 HAVING count(*) >= 3),
l AS (SELECT g, unnest(ls) AS line FROM p) SELECT l.g AS source, line, count(*) AS n_pages FROM l JOIN n USING (g) WHERE line <> '' GROUP BY l.g, line, c HAVING count(*) >= 0.02 * c""")
def chrome_lines(spark, d):
    return evidence.chrome_lines(table(spark, d, "documents"), "source", "text", "doc_id", share=0.02)


@query("page_differencing")
def page_differencing(spark, d):
    pages = table(spark, d, "pages").select("page_id", web.host(F.col("url")).alias("host"), web.page_text_and_method(F.col("html")).alias("p")).select("page_id", "host", "p.text", F.col("p.method").alias("found"))
    return evidence.differenced(pages, "host", "text", "page_id", "found").select("page_id", "method", "truncated", F.char_length("main_text").alias("main_text_chars"))


@query("redact_emails", rf"SELECT doc_id, sha256(regexp_replace(text, '{text.EMAIL}', '[EMAIL]', 'g')) AS redacted_sha256 FROM documents")
def redact_emails(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(text.redact_emails(F.col("text")), 256).alias("redacted_sha256"))


@query("redact_contacts")
def redact_contacts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(text.redact(F.col("text")), 256).alias("redacted_sha256"))


@query("path_segments", r"SELECT page_id, len(list_filter(string_split(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/'), lambda s: s <> ''))::BIGINT AS depth FROM pages")
def path_segments(spark, d):
    return table(spark, d, "pages").select("page_id", F.size(web.path_segments(F.col("url"))).cast("long").alias("depth"))


# --- scoring -------------------------------------------------------------------------------------

_LEXICON = [("the", 3), ("le", 3), ("der", 2), ("que", 2), ("is", -2), ("la", 1)]


def _scored(spark, d):
    form = text.match_form(F.col("text"))
    return table(spark, d, "documents").select("doc_id", "source", scoring.lexicon_score(form, _LEXICON).cast("long").alias("score"))


_FORM = f"' ' || trim(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(text)), '[-_]+', ' ', 'g'), '[^\\p{{L}}\\p{{N}}\\s]+', ' ', 'g'), '\\s+', ' ', 'g')) || ' '"
_SCORED = f"SELECT doc_id, source, ({' + '.join(f'CASE WHEN contains(f, {chr(39)} {p} {chr(39)}) THEN {w} ELSE 0 END' for p, w in _LEXICON)})::BIGINT AS score FROM (SELECT doc_id, source, {_FORM} AS f FROM documents)"


@query("phrase_score", _SCORED)
def phrase_score(spark, d):
    return _scored(spark, d)


@query("rank_pages", f"SELECT doc_id, source, score, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rank FROM ({_SCORED})")
def rank_pages(spark, d):
    return scoring.ranked(_scored(spark, d), ["source"], "doc_id")


@query("top_8", f"SELECT * FROM (SELECT doc_id, source, score, row_number() OVER (PARTITION BY source ORDER BY score DESC, doc_id) AS rank FROM ({_SCORED})) WHERE rank <= 8")
def top_8(spark, d):
    return scoring.ranked(_scored(spark, d), ["source"], "doc_id", top=8)


@query("rule_pack_scores")
def rule_pack_scores(spark, d):
    """The fixed pack over page paths, titles and headings; synthetic words score zero, extensions and the like do not."""
    pages = evidence.extract(table(spark, d, "pages")).select("page_id", "url", "title", F.array_join(web.path_segments(F.col("url")), " ").alias("path"),
                                                              F.array_join(F.transform("headings", lambda h: h["text"]), " \n ").alias("heads"))
    found = scoring.matches(pages, "page_id", {"urlPath": "path", "title": "title", "heading": "heads"}, scoring.rule_table(spark)).unionByName(scoring.structural(pages, "page_id", "url"))
    return scoring.scores(pages, "page_id", found).select("page_id", "track", "score", "veto", F.size("signals").cast("long").alias("n_signals"))


@query("frontier_inheritance")
def frontier_inheritance(spark, d):
    pages = table(spark, d, "pages").select("page_id", "url", web.path_segments(F.col("url")).alias("s"))
    pages = pages.select("page_id", F.when(F.col("page_id") % 10 == 0, F.slice("s", 1, 1)).otherwise(F.col("s")).alias("segments"))  # some are section roots
    scored = pages.select("page_id", "segments", F.explode(F.array(F.lit("A"), F.lit("B"))).alias("track"), (F.col("page_id") % 9 - 2).alias("score"), (F.col("page_id") % 13 == 0).alias("veto"))
    return scoring.inherited(scored, "page_id", "segments")


@query("frontier_order", """WITH p AS (SELECT page_id, url, page_id % 9 - 2 AS a, page_id % 5 - 1 AS b, CASE WHEN page_id % 3 = 0 THEN 0 ELSE 1 END AS m FROM pages),
k AS (SELECT *, greatest(a, b) AS best, CASE WHEN (CASE WHEN a >= b THEN a ELSE b END) > 0 THEN 1 ELSE 0 END AS own FROM p),
r AS (SELECT *, row_number() OVER (ORDER BY b DESC, best DESC, own DESC, m, url, page_id) AS rb FROM k), f AS (SELECT *, CASE WHEN b > 0 AND rb <= 8 THEN 0 ELSE 1 END AS phase FROM r)
SELECT page_id, row_number() OVER (ORDER BY phase, CASE WHEN phase = 0 THEN rb END, best DESC, own DESC, m, url, page_id) AS pick FROM f""")
def frontier_order(spark, d):
    pages = table(spark, d, "pages").select("page_id", F.concat("url", F.lit(" "), F.lpad(F.col("page_id").cast("string"), 12, "0")).alias("key"), (F.col("page_id") % 9 - 2).alias("a"), (F.col("page_id") % 5 - 1).alias("b"),
                                            F.when(F.col("page_id") % 3 == 0, "SITEMAP").otherwise("LINK").alias("m"))
    return scoring.frontier_order(pages, "a", "b", "m", "key").select("page_id", "pick")


# --- batches -------------------------------------------------------------------------------------


@query("content_dedupe", "SELECT sha256(text) AS sha, arg_min(doc_id, (n_chars, doc_id)) AS representative, count(*) AS n, min(doc_id) AS least, max(doc_id) AS greatest FROM documents GROUP BY 1")
def content_dedupe(spark, d):
    return batching.by_content(table(spark, d, "documents"), "text", "n_chars", "doc_id")


@query("signal_merge", "SELECT user_id, count(DISTINCT (event_type, event_id % 10)) AS n_signals, min(event_type) AS first_type FROM events GROUP BY 1")
def signal_merge(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", (F.col("event_id") % 10).alias("k"))
    return batching.merged_signals(rows, "user_id", ["event_type", "k"]).select("user_id", F.size("signals").cast("long").alias("n_signals"), F.col("signals")[0]["event_type"].alias("first_type"))


@query("batch_pack", """WITH RECURSIVE o AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
w AS (SELECT source, doc_id, k, 0 AS batch, 1 AS n, n_chars AS used FROM o WHERE k = 1 UNION ALL
SELECT o.source, o.doc_id, o.k, w.batch + CASE WHEN w.n + 1 > 24 OR w.used + o.n_chars > 64000 THEN 1 ELSE 0 END, CASE WHEN w.n + 1 > 24 OR w.used + o.n_chars > 64000 THEN 1 ELSE w.n + 1 END,
CASE WHEN w.n + 1 > 24 OR w.used + o.n_chars > 64000 THEN o.n_chars ELSE w.used + o.n_chars END FROM w JOIN o ON o.source = w.source AND o.k = w.k + 1)
SELECT source, doc_id::VARCHAR AS doc_id, batch::INTEGER AS batch FROM w""")
def batch_pack(spark, d):
    return batching.packed(table(spark, d, "documents"), "source", "doc_id", "n_chars")


@query("document_index", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS doc_index FROM conversations")
def document_index(spark, d):
    return batching.with_index(table(spark, d, "conversations").select("conv_id", "turn"), ["conv_id"], "turn")


@query("canonical_hash", """SELECT conv_id, turn, sha256('{"conv_id":' || conv_id || ',"role":"' || role || '","turn":' || turn || '}') AS hash FROM conversations""")
def canonical_hash(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", batching.record_hash(conv_id=F.col("conv_id"), role=F.col("role"), turn=F.col("turn")).alias("hash"))


# --- evaluation ----------------------------------------------------------------------------------


@query("org_cap", "SELECT doc_id, source, rank, rank > 20 AS overflow FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents)")
def org_cap(spark, d):
    return evaluation.capped(table(spark, d, "documents").select("doc_id", "source", "n_chars"), "source", [F.desc("n_chars"), "doc_id"], 20).drop("n_chars")


@query("round_robin_split", "SELECT doc_id, ['dev', 'dev', 'holdout', 'dev', 'holdout'][((row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) % 5 + 1)::INTEGER] AS split FROM documents")
def round_robin_split(spark, d):
    return evaluation.round_robin(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id").select("doc_id", "split")


@query("hash_sample", "SELECT doc_id, lang, rank FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) AS rank FROM documents) WHERE rank <= 25")
def hash_sample(spark, d):
    return evaluation.hash_sample(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", 25)


@query("quota_sample")
def quota_sample(spark, d):
    return evaluation.quota_sample(table(spark, d, "documents").select("lang", "source", "doc_id"), "lang", "source", "doc_id", {"de": 10, "en": 20, "fr": 10}, 3)


@query("strata", "SELECT lang AS stratum, CASE WHEN s > 0 THEN 'positive' WHEN s < 0 THEN 'negative' ELSE 'zero' END AS bucket, count(*) AS n FROM (SELECT lang, quality - 2 * toxic AS s FROM documents JOIN labels USING (doc_id)) GROUP BY 1, 2")
def strata(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    return rows.groupBy(text.language_stratum(F.col("lang")).alias("stratum"), text.sign_bucket(F.col("quality") - 2 * F.col("toxic")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _predicted(spark, d, rule):
    return table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang", "n_chars"), "doc_id").withColumn("predicted", rule.cast("int"))


def _by_chars():
    return F.col("n_chars") > 300


def _by_more_chars():
    return F.col("n_chars") > 400


def _metrics_sql(rule, group=""):
    g, by = (f"{group}, ", f"GROUP BY {group}") if group else ("", "")
    return f"""SELECT {g}n, tp, fp, fn, tn, round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall, round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision, round((tp + tn) / nullif(n, 0)::DOUBLE, 6) AS accuracy, fn * 5 + fp * 2 AS severity
FROM (SELECT {g}count(*) AS n, count(*) FILTER (quality = 1 AND p) AS tp, count(*) FILTER (quality <> 1 AND p) AS fp, count(*) FILTER (quality = 1 AND NOT p) AS fn, count(*) FILTER (quality <> 1 AND NOT p) AS tn
FROM (SELECT *, {rule} AS p FROM labels JOIN documents USING (doc_id)) {by})"""


@query("model_metrics", _metrics_sql("n_chars > 300"))
def model_metrics(spark, d):
    return evaluation.metrics(_predicted(spark, d, _by_chars()), "quality", "predicted")


@query("model_metrics_by_language", _metrics_sql("n_chars > 300", "lang"))
def model_metrics_by_language(spark, d):
    return evaluation.metrics(_predicted(spark, d, _by_chars()), "quality", "predicted", "lang")


@query("gates", f"WITH m AS ({_metrics_sql('n_chars > 300')}) SELECT 'recall' AS metric, recall AS value, 0.95::DOUBLE AS bound, coalesce(recall >= 0.95::DOUBLE, true) AS passed FROM m UNION ALL SELECT 'precision', precision, 0.9::DOUBLE, coalesce(precision >= 0.9::DOUBLE, true) FROM m")
def gates(spark, d):
    return evaluation.gates(model_metrics(spark, d))


@query("noninferiority", f"""WITH r AS ({_metrics_sql('n_chars > 300')}), c AS ({_metrics_sql('n_chars > 400')})
{' UNION ALL '.join(f"SELECT '{m}' AS metric, r.{m} AS reference, c.{m} AS challenger, NOT (r.{m} - c.{m} >= 0.05::DOUBLE AND (c.fp + c.fn) - (r.fp + r.fn) >= 2) AS non_inferior FROM r, c" for m in evaluation.MARGINS)}""")
def noninferiority(spark, d):
    return evaluation.non_inferior(model_metrics(spark, d), evaluation.metrics(_predicted(spark, d, _by_more_chars()), "quality", "predicted"))


@query("attempt_integrity", "SELECT doc_id, 'MISSING' AS problem FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def attempt_integrity(spark, d):
    return evaluation.exactly_one(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


# --- graph and recorded attempts -----------------------------------------------------------------

_EDGES = "SELECT page_id AS src, (page_id * 2 + 1) % (SELECT count(*) FROM pages) AS dst FROM pages UNION SELECT page_id, (page_id * 3 + 2) % (SELECT count(*) FROM pages) FROM pages"


@query("bfs_depth", f"""WITH RECURSIVE e AS ({_EDGES}), w AS (SELECT 0::BIGINT AS node, 0 AS depth UNION SELECT e.dst, w.depth + 1 FROM w JOIN e ON e.src = w.node WHERE w.depth < 3) SELECT node, min(depth)::INTEGER AS depth FROM w GROUP BY 1""")
def bfs_depth(spark, d):
    pages = table(spark, d, "pages").select("page_id")
    n = pages.agg(F.count(F.lit(1)).alias("n"))
    both = pages.crossJoin(F.broadcast(n))  # one row
    edges = both.select(F.col("page_id").alias("src"), F.explode(F.array((F.col("page_id") * 2 + 1) % F.col("n"), (F.col("page_id") * 3 + 2) % F.col("n"))).alias("dst")).distinct()
    return graph.bfs(edges, spark.createDataFrame([(0,)], "node long"), 3)


@query("redirect_chain", """WITH e AS (SELECT page_id AS src, page_id // 2 AS dst FROM pages WHERE page_id % 2 = 0 AND page_id > 0), c0 AS (SELECT page_id AS start, page_id AS node, 0 AS hops FROM pages),
c1 AS (SELECT start, coalesce(dst, node) AS node, hops + (dst IS NOT NULL)::INT AS hops FROM c0 LEFT JOIN e ON src = node), c2 AS (SELECT start, coalesce(dst, node) AS node, hops + (dst IS NOT NULL)::INT AS hops FROM c1 LEFT JOIN e ON src = node),
c3 AS (SELECT start, coalesce(dst, node) AS node, hops + (dst IS NOT NULL)::INT AS hops FROM c2 LEFT JOIN e ON src = node), c4 AS (SELECT start, coalesce(dst, node) AS node, hops + (dst IS NOT NULL)::INT AS hops FROM c3 LEFT JOIN e ON src = node)
SELECT start, coalesce(dst, node) AS node, (hops + (dst IS NOT NULL)::INT)::INTEGER AS hops FROM c4 LEFT JOIN e ON src = node""")
def redirect_chain(spark, d):
    pages = table(spark, d, "pages").select(F.col("page_id").alias("node"))
    edges = pages.where("node % 2 = 0 AND node > 0").select(F.col("node").alias("src"), F.floor(F.col("node") / 2).alias("dst"))
    return graph.chain(edges, pages)


@query("circuit_breaker", """WITH o AS (SELECT *, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM events),
r AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, g ORDER BY ts, event_id) AS run FROM o)
SELECT event_id, run::BIGINT AS run, coalesce(max(CASE WHEN run >= 3 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS open FROM r""")
def circuit_breaker(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "ts", (F.col("event_type") == "error").alias("failed"))
    return graph.breaker(rows, "user_id", ["ts", "event_id"], "failed").select("event_id", "run", "open")


@query("budget_running", "SELECT event_id, used, used <= 60 AS allowed FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS used FROM events)")
def budget_running(spark, d):
    return graph.within_budget(table(spark, d, "events").select("event_id", "user_id", "ts"), "user_id", ["ts", "event_id"], 60).select("event_id", "used", "allowed")


@query("robots_match")
def robots_match(spark, d):
    """A fixed robots file against every page's path."""
    body = "User-agent: *\nDisallow: /en/1\nAllow: /en/1*5$\nDisallow: /*/7\nCrawl-delay: 9\n\nUser-agent: probe\nDisallow: /fr/"
    pages = table(spark, d, "pages").select("page_id", F.coalesce(F.nullif(F.try_parse_url("url", F.lit("PATH")), F.lit("")), F.lit("/")).alias("path"))
    groups = F.from_json(F.lit(_robots_json(body)), web.ROBOTS)
    return pages.select("page_id", web.robots_allows(groups, "crawler", F.col("path")).alias("allowed"), web.robots_allows(groups, "probe", F.col("path")).alias("probe_allowed"))


def _robots_json(body):
    import json

    return json.dumps(web.parse_robots(body))


@query("ip_classify", r"""WITH a AS (SELECT doc_id, unnest(regexp_extract_all(text, '\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b')) AS ip FROM documents), p AS (SELECT doc_id, ip, [x::BIGINT FOR x IN string_split(ip, '.')] AS o FROM a)
SELECT doc_id, ip, NOT (o[1] IN (0, 10, 127) OR o[1] >= 224 OR (o[1] = 100 AND o[2] BETWEEN 64 AND 127) OR (o[1] = 169 AND o[2] = 254) OR (o[1] = 172 AND o[2] BETWEEN 16 AND 31) OR (o[1] = 192 AND o[2] = 0 AND o[3] IN (0, 2))
OR (o[1] = 192 AND o[2] = 88 AND o[3] = 99) OR (o[1] = 192 AND o[2] = 168) OR (o[1] = 198 AND o[2] IN (18, 19)) OR (o[1] = 198 AND o[2] = 51 AND o[3] = 100) OR (o[1] = 203 AND o[2] = 0 AND o[3] = 113)) AS public
FROM p WHERE o[1] <= 255 AND o[2] <= 255 AND o[3] <= 255 AND o[4] <= 255""")
def ip_classify(spark, d):
    found = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"), F.lit(0))).alias("ip"))
    return found.select("doc_id", "ip", web.is_public_v4(F.col("ip")).alias("public")).where("public is not null")


@query("dq_claims", "SELECT unnest(['derived_iff_valid', 'reason_iff_invalid', 'status_known']) AS rule, 0::BIGINT AS n")
def dq_claims(spark, d):
    return quality.violations(_claims(spark, d)[1], quality.claim_rules())


@query("dq_orphans", "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1")
def dq_orphans(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.orphans(lines, table(spark, d, "orders"), ["o_orderkey"]).groupBy(F.col("o_orderkey").alias("l_orderkey")).agg(F.count(F.lit(1)).alias("n"))


@query("event_windows", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    rows = table(spark, d, "events")
    return rows.groupBy(F.date_trunc("hour", "ts").alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
