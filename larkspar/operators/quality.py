"""Data-quality rules: each gives the rows that break it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHA = "^[0-9a-f]{64}$"


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, n) over all rules in one pass; a rule that is null counts as broken."""
    broken = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()])
    return broken.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("n")) for k in rules])).alias("x")).select("x.*")


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(child: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    return child.join(parent.select(*key), key, "left_anti")


def implies(a: Column, b: Column) -> Column:
    return ~a | b


def claim_rules(c: str = "claim") -> dict[str, Column]:
    f = lambda x: F.col(f"{c}.{x}")
    valid = f("status") == "STRUCTURALLY_VALID"
    return {"derived_iff_valid": valid == (f("hostname").isNotNull() & f("domain").isNotNull()), "reason_iff_invalid": valid == f("reason").isNull(),
            "status_known": f("status").isin("STRUCTURALLY_VALID", "NOT_A_WEBSITE", "MALFORMED", "ABSENT")}


def page_rules(most: int = 40_000) -> dict[str, Column]:
    return {"text_bounded": F.char_length("main_text") <= most}


def _check(c: Column) -> Column:
    """A rule that holds where it cannot be decided, as a database's check does."""
    return F.coalesce(c, F.lit(True))


def _same(*c: Column) -> Column:
    """All null or none."""
    out = F.lit(True)
    for x in c[1:]:
        out = out & (c[0].isNull() == x.isNull())
    return out


def _at_most(c: str, n: int, least: int = 0) -> Column:
    return _check(F.char_length(c).between(least, n))


def snapshot_rules(origin: str) -> dict[str, Column]:
    """origin is the pattern of addresses that a fetched snapshot may come from."""
    counts = F.lit(True)
    for c in ("host_count", "entity_count", "id_count", "api_count"):
        counts = counts & (F.col(c) >= 0)
    return {"sha_shape": _check(F.col("sha").rlike(SHA)), "bytes_positive": _check(F.col("byte_count") > 0), "counts": _check(counts),
            "kind_known": _check(F.col("kind").isin("official_endpoint", "operator_url", "operator_file")), "origin_shape": _check(F.col("origin_url").rlike(origin)),
            "origin_pair": F.col("origin_at").isNull() | F.col("origin_url").isNotNull(), "fetched_has_origin": _check((F.col("kind") == "operator_file") | F.col("origin_url").isNotNull())}


#: Kinds of errors of fetches and of calls; the last two of calls came later.
FETCH_ERRORS = ["DNS_FAILURE", "CONNECT_TIMEOUT", "READ_TIMEOUT", "TLS_FAILURE", "CONNECTION_REFUSED", "CONNECTION_RESET", "BLOCKED_BY_POLICY", "MALFORMED_URL",
                "RESPONSE_TOO_LARGE", "UNSUPPORTED_CONTENT_TYPE", "TOO_MANY_REDIRECTS", "OTHER"]
CALL_ERRORS = ["PROVIDER_TRANSIENT", "PROVIDER_REFUSAL", "SCHEMA_INVALID", "EVIDENCE_SPAN_UNVERIFIED", "TIMEOUT", "OTHER", "USAGE_LIMIT_EXHAUSTED", "AUTH_FAILURE"]


def completion_rules(states: list[str], errors: list[str] | None = None) -> dict[str, Column]:
    """Ends of runs (no errors given) or of calls; a completed one has no error, and a call that isn't has one."""
    clean = F.col("error_kind").isNull() & F.col("error_summary").isNull()
    rules = {"state_known": _check(F.col("state").isin(*states)), "completed_is_clean": _check((F.col("state") != "COMPLETED") | clean), "summary_bounded": _at_most("error_summary", 2000)}
    if errors is None:
        return rules | {"kind_bounded": _at_most("error_kind", 64)}
    return rules | {"kind_known": _check(F.col("error_kind").isin(*errors)), "incomplete_has_error": _check((F.col("state") == "COMPLETED") | F.col("error_kind").isNotNull()),
                    "tokens": _check(F.col("input_tokens") >= 0) & _check(F.col("output_tokens") >= 0)}


def fetch_rules() -> dict[str, Column]:
    c = F.col
    return {"one_root": c("claim_id").isNull() != c("promotion_id").isNull(), "root_has_no_parent": _check((c("discovery") != "ROOT") | c("parent_url").isNull()),
            "link_has_parent": _check((c("discovery") != "LINK") | c("parent_url").isNotNull()), "status_or_error": c("http_status").isNotNull() | c("error_kind").isNotNull(),
            "status_range": _check(c("http_status").between(100, 599)), "error_known": _check(c("error_kind").isin(*FETCH_ERRORS)), "sha_shape": _check(c("sha").rlike(SHA)),
            "body_pair": _same(c("sha"), c("byte_count")), "truncated_has_body": ~F.coalesce(c("truncated"), F.lit(False)) | c("sha").isNotNull(),
            "charset_triple": _same(c("charset"), c("charset_source"), c("charset_confidence")), "ip_pair": _same(c("ip_family"), c("ip_public"))}


def redirect_rules() -> dict[str, Column]:
    c = F.col
    facts = [c("downgraded"), c("host_changed"), c("domain_changed")]
    none, every = facts[0].isNull() & facts[1].isNull() & facts[2].isNull(), facts[0].isNotNull() & facts[1].isNotNull() & facts[2].isNotNull()
    return {"status_range": _check(c("http_status").between(300, 399)), "malformed_iff_unresolved": _check(c("malformed") == c("to_url").isNull()), "facts_iff_resolved": c("to_url").isNull() == none,
            "facts_complete": c("to_url").isNull() | every, "domain_implies_host": implies(F.coalesce(c("domain_changed"), F.lit(False)), _check(c("host_changed")))}


#: Keys that a stored request may not have.
SECRET_KEYS = ["api_key", "apiKey", "credential", "credentials", "authorization", "secret", "token"]


def call_rules() -> dict[str, Column]:
    keys = F.json_object_keys(F.col("request_config"))
    return {"config_object": F.col("request_config").isNull() | keys.isNotNull(), "config_bounded": _at_most("request_config", 2000),
            "no_secrets": _check(~F.arrays_overlap(keys, F.array(*[F.lit(k) for k in SECRET_KEYS]))), "sha_shape": _check(F.col("input_sha").rlike(SHA)),
            "documents": _check(F.col("n_documents") >= 1), "attempt": _check(F.col("attempt_no") >= 1)}


#: What a classification may say, and the parts of a page that may be quoted.
VERDICTS = ["UNIT_PAGE", "NOT_A_UNIT", "NEEDS_REVIEW"]
SOURCES = ["TITLE", "HEADING", "EXCERPT", "URL_PATH"]


def classification_rules(axes: list[str]) -> dict[str, Column]:
    """spans is an array of maps, so that keys too many show."""
    c, unit = F.col, F.col("verdict") == "UNIT_PAGE"
    each, given = F.lit(True), F.lit(True)
    for a in axes:
        each, given = each & _check(c(a).isin("YES", "NO", "UNKNOWN")), given & (unit == c(a).isNotNull())
    every = lambda f: _check(F.forall("spans", lambda s: F.coalesce(f(s), F.lit(False))))
    return {"verdict_known": _check(c("verdict").isin(*VERDICTS)), "type_iff_unit": _check(unit == c("unit_type").isNotNull()), "kind_iff_not": _check((c("verdict") == "NOT_A_UNIT") == c("page_kind").isNotNull()),
            "axes_known": each, "axes_iff_unit": _check(given), "name_bounded": _at_most("unit_name", 200, 1), "rationale_bounded": _at_most("rationale", 500, 1),
            "confidence_known": _check(c("confidence").isin("HIGH", "MEDIUM", "LOW")), "spans_count": _check(F.size("spans").between(1, 4)),
            "span_keys": every(lambda s: F.size(F.array_except(F.map_keys(s), F.array(F.lit("source"), F.lit("quote")))) == 0),
            "span_source": every(lambda s: s["source"].isin(*SOURCES)), "span_quote": every(lambda s: F.char_length(s["quote"]).between(1, 200))}
