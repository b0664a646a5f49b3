"""Classifier handoff: eligible candidates, reusable calls, responses checked against what was sent, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

#: Bounds in code points and entries.
MOST_NAME, MOST_RATIONALE, MOST_QUOTE, MOST_HEADINGS, MOST_HEADING = 200, 500, 200, 12, 200
#: Marks of refused credentials and of timeouts, in lower case.
AUTH_MARKS = ["authentication_error", "authentication failed", "invalid api key", "oauth token has expired", "oauth token is invalid", "oauth token revoked", "please run /login", "unauthorized"]
TIMEOUT_MARKS = ["timed out", "timeout"]


def eligible(candidates: DataFrame, evidence: DataFrame, fetches: DataFrame, run: Column, most: int) -> DataFrame:
    """A run's candidates up to rank `most` with their page and fetch, by root, track, rank and id."""
    mine = candidates.where((F.col("run_id") == run) & (F.col("rank") <= most))
    return mine.join(evidence, "evidence_id").join(fetches, "fetch_id").orderBy("root", "track", "rank", "candidate_id")


def latest_run(runs: DataFrame, completions: DataFrame, attempts: DataFrame) -> DataFrame:
    """Per organisation its latest completed run that was no dry run: by start, then id."""
    done = runs.where(~F.col("dry_run")).join(completions.where("state = 'COMPLETED'").select("run_id"), "run_id", "left_semi")
    owned = attempts.where("org_id IS NOT NULL").select("run_id", "org_id").distinct()
    return done.join(owned, "run_id").groupBy("org_id").agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))


def reusable(calls: DataFrame, completions: DataFrame, identity: list[str]) -> DataFrame:
    """Calls that were completed, by their identity; partial and failed ones are not used again."""
    return calls.join(completions.where("state = 'COMPLETED'").select("call_id"), "call_id").select(*identity, "call_id")


def bounded_headings(headings: Column) -> Column:
    """The first headings (structs level, text), each cut."""
    return F.transform(F.slice(headings, 1, MOST_HEADINGS), lambda h: F.struct(h["level"].alias("level"), text.cut(h["text"], MOST_HEADING).alias("text")))


def parsed_headings(raw: Column) -> Column:
    """Headings of a JSON array, entries without a text left out; no array gives none."""
    found = F.from_json(F.when(raw.rlike(r"^\s*\["), raw), "array<struct<level:int,text:string>>")
    return F.coalesce(F.filter(found, lambda h: h["text"].isNotNull()), F.array().cast("array<struct<level:int,text:string>>"))


def parsed_signals(raw: Column) -> Column:
    """Struct signals, problem: typed entries of a JSON array, or the first thing wrong with it."""
    found = F.from_json(F.when(raw.rlike(r"^\s*\["), raw), "array<struct<id:string,kind:string,field:string>>")
    some = lambda f: F.exists(found, lambda s: F.coalesce(f(s), F.lit(True)))
    problem = (F.when(found.isNull(), "not_an_array").when(some(lambda s: s["id"] == ""), "no_id")
               .when(some(lambda s: ~s["kind"].isin("positive", "negative", "veto")), "unknown_kind").when(some(lambda s: s["field"] == ""), "no_field"))
    return F.struct(F.when(problem.isNull(), found).alias("signals"), problem.alias("problem"))


def checked(documents: DataFrame, results: DataFrame) -> DataFrame:
    """(batch, doc_index, category): every document sent and every index answered, once.

    documents has batch, doc_index (unique together), title, headings (strings), excerpt, url_path; results has batch,
    doc_index, unit_name, rationale, spans (structs source, quote). category is null where the answer is accepted;
    else DOC_INDEX (unknown, repeated or missing), LENGTH or EVIDENCE, the first that holds. Answers are counted
    before they are joined, so a much repeated index is one row there.
    """
    answers = results.groupBy("batch", "doc_index").agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct("unit_name", "rationale", "spans")).alias("_r"))
    rows = documents.withColumn("_sent", F.lit(True)).join(answers, ["batch", "doc_index"], "full_outer")
    has = lambda f, v: F.coalesce(f(v), F.lit(False))
    name, spans = F.col("_r.unit_name"), F.coalesce("_r.spans", F.array().cast("array<struct<source:string,quote:string>>"))
    long = (F.coalesce(F.char_length(name), F.lit(0)) > MOST_NAME) | (F.char_length("_r.rationale") > MOST_RATIONALE) | F.exists(spans, lambda s: F.char_length(s["quote"]) > MOST_QUOTE)

    def held(s: Column) -> Column:
        q = s["quote"]
        return (F.when(s["source"] == "TITLE", has(lambda v: text.quotes(v, q), F.col("title"))).when(s["source"] == "EXCERPT", has(lambda v: text.quotes(v, q), F.col("excerpt")))
                .when(s["source"] == "URL_PATH", has(lambda v: text.quotes(v, q), F.col("url_path")))
                .when(s["source"] == "HEADING", F.coalesce(F.exists("headings", lambda h: text.quotes(h, q)), F.lit(False))).otherwise(False))

    named = F.coalesce(F.exists("headings", lambda h: text.supports_name(h, name)), F.lit(False))
    for field in ("title", "excerpt"):
        named = named | has(lambda v: text.supports_name(v, name), F.col(field))
    category = (F.when(F.col("_sent").isNull() | F.col("_n").isNull() | (F.col("_n") > 1), "DOC_INDEX").when(F.coalesce(long, F.lit(False)), "LENGTH")
                .when(~F.forall(spans, held) | (name.isNotNull() & ~named), "EVIDENCE"))
    return rows.select("batch", "doc_index", category.alias("category"), F.coalesce("_sent", F.lit(False)).alias("sent"))


def terminal(outcomes: DataFrame) -> DataFrame:
    """Per batch of `checked` rows: documents, accepted, terminal state and the error that outranks the others."""
    n = outcomes.groupBy("batch").agg(F.count_if("sent").alias("n_documents"), F.count_if(F.col("category").isNull()).alias("n_accepted"),
                                      F.count("category").alias("_bad"), F.coalesce(F.bool_or(F.col("category") == "EVIDENCE"), F.lit(False)).alias("_evidence"))
    state = F.when(F.col("n_accepted") == F.col("n_documents"), "COMPLETED").when(F.col("n_accepted") > 0, "PARTIAL").otherwise("FAILED")
    error = F.when(F.col("_evidence"), "EVIDENCE_SPAN_UNVERIFIED").when(F.col("_bad") > 0, "SCHEMA_INVALID")
    return n.select("batch", "n_documents", "n_accepted", state.alias("state"), error.alias("error_kind"))


def attempt_kind(message: Column, subtype: Column, is_error: Column, stop: Column, has_output: Column, limit_marks: list[str]) -> Column:
    """Kind of an attempt's end. subtype is null for one that was thrown, and then is_error, stop and has_output don't count.

    limit_marks are the provider's own openings of messages on used-up limits, in their own case.
    """
    body = F.coalesce(message, F.lit(""))
    lower = F.lower(body)
    any_of = lambda x, marks: F.exists(F.array(*[F.lit(m) for m in marks]), lambda m: F.instr(x, m) > 0)
    returned, refused = subtype.isNotNull(), F.coalesce(stop == "refusal", F.lit(False))
    fine = F.coalesce((subtype == "success") & ~is_error, F.lit(False))
    limit, auth, late = any_of(body, limit_marks), any_of(lower, AUTH_MARKS) | lower.rlike(r"\b401\b"), any_of(lower, TIMEOUT_MARKS)
    schema = lower.rlike(r"\bapi error:\s*4\d\d\b") & (F.instr(lower, "input_schema") > 0)
    return (F.when(fine & refused, "PROVIDER_REFUSAL").when(fine & has_output, "OK").when(fine, "STRUCTURED_OUTPUT_FAILED")
            .when(~returned & late, "TIMEOUT").when(limit, "USAGE_LIMIT_EXHAUSTED").when(auth, "AUTH_FAILURE").when(returned & refused, "PROVIDER_REFUSAL")
            .when(F.coalesce(subtype == "error_max_structured_output_retries", F.lit(False)), "STRUCTURED_OUTPUT_FAILED").when(late, "TIMEOUT")
            .when(F.coalesce(subtype.isin("error_max_turns", "error_max_budget_usd"), F.lit(False)) | schema, "STRUCTURED_OUTPUT_FAILED").otherwise("PROVIDER_TRANSIENT"))


def retry_delay_ms(retries: Column, base: int = 500) -> Column:
    """Wait before a retry, doubled each time."""
    return (F.lit(base) * F.pow(F.lit(2.0), retries)).cast("long")


def category_label(verdict: Column, unit_type: Column, page_kind: Column) -> Column:
    return F.when(verdict == "UNIT_PAGE", F.concat(F.lit("UNIT:"), unit_type)).when(verdict == "NOT_A_UNIT", F.concat(F.lit("NEG:"), page_kind)).otherwise("REVIEW")
