"""Personal data: base patterns plus information-theoretic sanitisation, in DataFrame operations only.

Base kinds (email, ip, card, phone) are found by pattern, leftmost and non-overlapping per kind, with
code-point spans. The method then learns from the whole corpus which *terms* give away a protected
entity (a base value): with p(c|t) estimated from co-occurrence, a term t discloses an entity c when

    PMI(c; t) = log2 p(c|t) / p(c)  >=  IC(c) - slack_bits,   i.e.  p(c|t) >= 2 ** -slack_bits,

provided t was seen beside c in at least `min_contexts` different contexts (identical windows count
once, so copies of one text never make a term look revealing). Such terms are added spans of kind
"term"; `sanitise` removes those that all but determine the entity and generalises the rest.

Scale: terms are counted with partial aggregation only; a term's or an entity's rows never meet in one
task. Only terms near an entity are ever counted over the corpus; they are broadcast below a checked
count and joined by shuffle beyond it.

Defined results: a null text is empty and has no spans; an empty table gives an empty result; rows that
share an id are separate rows, and rows equal in id and text count as one document in the statistics and each
get their spans; other columns pass through, whatever their names. Patterns are possessive, so very long texts
neither backtrack nor recurse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import bounded, fresh, quoted, written

# Fixed patterns; possessive forms match the same as greedy ones where nothing can follow, and the
# look-behind only spares attempts inside a run from whose start the match has failed already.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
HINT = {"email": "@", "ip": ".", "card": "", "phone": "+"}
WHITE = r"[\x20\x09-\x0D]+"
EDGES = r"^[^\p{L}\p{M}\p{N}]++|(?<=[\p{L}\p{M}\p{N}])[^\p{L}\p{M}\p{N}]++$"  # of a word: no part of a term

CONTEXT_WORDS = 4
MIN_CONTEXTS = 3
SLACK_BITS = 1.0
REMOVE_AT = 0.9  # p(entity | term) from which a term is removed rather than generalised
BROADCAST_TERMS = 100_000

_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _spans(text: Column, pattern: Column, kind: int) -> Column:
    """Code-point spans of every match: the pieces between matches give the positions."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    pair = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("hit"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["hit"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.aggregate(pair, empty, step, lambda acc: acc["spans"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(F.split(digits, ""))  # the last digit first
    weighed = F.transform(back, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        bare = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(value, r"\."), lambda p: (F.char_length(bare(p)) <= 3) & (
            F.concat(F.lit("0"), F.substring(bare(p), 1, 3)).cast("int") <= 255))
    digits = _digits(value)
    n = F.char_length(digits)
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _keeper(kind: str):
    return lambda s: _valid(kind, s["value"])


def _of_kind(i: int):
    return lambda s: s["kind"] == i


def base_spans(text: Column) -> Column:
    """All valid base spans of a text, by start, then kind."""
    parts = []
    for i, kind in enumerate(KINDS):
        pattern = F.lit(PATTERNS[kind])
        has = text.rlike("[0-9]") if kind != "email" else F.instr(text, "@") > 0
        if HINT[kind]:
            has = has & (F.instr(text, HINT[kind]) > 0)
        found = F.filter(_spans(text, pattern, i), _keeper(kind))
        parts.append(F.when(has, found).otherwise(F.array().cast(_SPAN)))
    return F.array_sort(F.concat(*parts))


def _named(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in [*KINDS, "term"]])
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.element_at(names, s["kind"] + 1), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def _terms(words: Column) -> Column:
    """Words as terms: lower case, without punctuation at their edges, each once."""
    return F.filter(F.array_distinct(F.transform(words, lambda w: F.lower(F.regexp_replace(w, EDGES, "")))), lambda w: w != "")


def _last(words: Column, n: int) -> Column:
    return F.reverse(F.slice(F.reverse(words), 1, n))


def _beside(mention: DataFrame, n: int) -> DataFrame:
    """mention(text, s, ...) plus window: the n words on either side of s, however long they are.

    A short stretch of text is looked at first; where it does not hold n whole words, the rest of the text is.
    """
    reach = 40 * n
    start, end = F.col("s.start"), F.col("s.end")
    near = mention.withColumns({
        "_before": F.substring("text", F.greatest(start - reach, F.lit(0)) + 1, F.least(start, F.lit(reach))),
        "_after": F.substring("text", end + 1, F.lit(reach))})
    kept = lambda pieces: F.filter(pieces, lambda w: w != "")
    pieces = F.split("_after", WHITE)
    near = near.withColumns({  # without the word that the stretch may cut
        "_left": kept(F.slice(F.split("_before", WHITE), F.lit(2), F.lit(reach))),
        "_right": kept(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))))})
    left = (F.when(start <= reach, _last(_words(F.col("_before")), n)).when(F.size("_left") >= n, _last(F.col("_left"), n))
            .otherwise(_last(_words(F.substring(F.col("text"), F.lit(1), start)), n)))
    right = (F.when(F.char_length("_after") < reach, F.slice(_words(F.col("_after")), 1, n)).when(F.size("_right") >= n, F.slice("_right", 1, n))
             .otherwise(F.slice(_words(F.substring(F.col("text"), end + 1, F.char_length("text"))), 1, n)))
    return near.withColumn("window", F.concat(left, right)).drop("_before", "_after", "_left", "_right")


def term_table(rows: DataFrame, near: DataFrame, min_contexts: int = MIN_CONTEXTS, slack_bits: float = SLACK_BITS,
               context_words: int = CONTEXT_WORDS) -> DataFrame:
    """(term, posterior, pmi, ic): the corpus's disclosing terms.

    rows: _lk_row, text of every document; near: the same and spans, of those that mention an entity.
    A term is a white-space word in lower case without punctuation at its edges; a context is the `context_words` words on either side of a mention.
    """
    mention = near.select("_lk_row", "text", F.explode("spans").alias("s"))
    entity = F.xxhash64(F.col("s.kind"), F.lower(F.when(F.col("s.kind") >= 2, _digits(F.col("s.value"))).otherwise(F.col("s.value"))))
    seen = _beside(mention, context_words).select("_lk_row", entity.alias("entity"), "window")
    seen = (seen.withColumn("context", F.xxhash64("window"))
            .select("_lk_row", "entity", "context", F.explode(_terms(F.col("window"))).alias("term"))
            # a term must carry information itself: a base value or punctuation is no term
            .where(F.col("term").rlike(r"\p{L}") & (F.instr("term", "@") == 0)))
    # distinct contexts first, so that no group is gathered whole
    pairs = (seen.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts"))
             .where(F.col("contexts") >= min_contexts))
    entities = near.select("_lk_row", F.explode("spans").alias("s")).select("_lk_row", entity.alias("entity")).distinct()
    entity_docs = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    # n_both <= n_entity and n_term >= the term's documents beside any mention: what can't reach the
    # threshold by these bounds is left out before anything is counted over the corpus.
    beside = seen.select("_lk_row", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_beside"))
    pairs = written(pairs.join(entity_docs, "entity").join(beside, "term")
                    .where(F.log2(F.col("n_entity") / F.col("n_beside")) >= -slack_bits)
                    .select("entity", "term"))
    terms = pairs.select("term").distinct()
    few = terms.limit(BROADCAST_TERMS + 1).count()
    if not few:
        return pairs.select("term", F.lit(0.0).alias("posterior"), F.lit(0.0).alias("pmi"), F.lit(0.0).alias("ic")).limit(0)
    side = F.broadcast(terms) if few <= BROADCAST_TERMS else terms
    words = rows.select("_lk_row", F.explode(_terms(_words(F.col("text")))).alias("term"))
    held = words.join(side, "term").distinct()  # rows equal in id and text are one document
    term_docs = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    entities = entities.join(bounded(pairs.select("entity").distinct(), BROADCAST_TERMS), "entity")
    both = (held.join(entities, "_lk_row").join(pairs.select("entity", "term"), ["entity", "term"])
            .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")))
    total = rows.agg(F.count(F.lit(1)).alias("n_all"))
    scored = both.join(term_docs, "term").join(entity_docs, "entity").crossJoin(F.broadcast(total))  # one row
    posterior = F.col("n_both") / F.col("n_term")
    ic = F.log2(F.col("n_all") / F.col("n_entity"))
    pmi = F.log2(posterior) + ic
    return (scored.select("term", posterior.alias("posterior"), pmi.alias("pmi"), ic.alias("ic"))
            .where(F.col("pmi") >= F.col("ic") - slack_bits)
            .groupBy("term").agg(F.max("posterior").alias("posterior"), F.max("pmi").alias("pmi"), F.max("ic").alias("ic")))


_ADDED = "array<struct<start:int,kind:int,end:int,value:string,posterior:double>>"


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> tuple[DataFrame, str, str]:
    """df plus two arrays, and their names: base spans, and added ones (terms, value = the text itself)."""
    text, row, base, added, terms_of = fresh(df, "text", "row", "base", "added", "terms")
    data = df.withColumns({text: F.coalesce(F.col(quoted(text_col)), F.lit(""))})
    data = data.withColumns({base: base_spans(F.col(text)), row: F.xxhash64(F.col(quoted(id_col)), F.col(text))})
    lean = data.select(F.col(row).alias("_lk_row"), F.col(text).alias("text"))
    near = written(data.select(F.col(row).alias("_lk_row"), F.col(text).alias("text"), F.col(base).alias("spans")).where(F.size("spans") > 0))
    terms = written(term_table(lean, near, **limits))
    out, none = [*[quoted(c) for c in df.columns], base], F.array().cast(_ADDED)
    if not terms.limit(1).count():
        return data.select(*out, none.alias(added)), base, added
    hits = (lean.select("_lk_row", F.explode(_terms(_words(F.col("text")))).alias("term")).join(bounded(terms, BROADCAST_TERMS), "term")
            .select("_lk_row", "term", "posterior").distinct()
            .groupBy(F.col("_lk_row").alias(row)).agg(F.map_from_entries(F.collect_list(F.struct("term", "posterior"))).alias(terms_of)))
    joined, held = data.join(hits, row, "left"), F.col(terms_of)
    quote = F.transform(F.sort_array(F.map_keys(held), False), lambda w: F.replace(F.concat(
        F.lit("\\Q"), F.regexp_replace(w, r"\\E", r"\\E\\\\E\\Q"), F.lit("\\E")), F.lit("i\u0307"), F.lit("\\E(?:i\u0307|\u0130)\\Q")))  # the one letter whose lower case is two
    mark = r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]*+"
    pattern = F.concat(F.lit(rf"(?iu)(?<![^\x20\x09-\x0D]){mark}(?:"), F.array_join(quote, "|"), F.lit(rf")(?={mark}(?![^\x20\x09-\x0D]))"))
    bare = F.transform(_spans(F.col(text), pattern, len(KINDS)), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.regexp_replace(s["value"], EDGES, "").alias("value")))
    found = F.transform(F.filter(bare, lambda s: F.map_contains_key(held, F.lower(s["value"]))), lambda s: F.struct(
        (s["end"] - F.char_length(s["value"])).alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"),
        F.element_at(held, F.lower(s["value"])).alias("posterior")))
    return joined.select(*out, F.when(held.isNotNull(), found).otherwise(none).alias(added)), base, added


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term per row."""
    found, base, added = find(df.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text")), **limits)
    base = F.col(base)
    bare = F.transform(F.col(added), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    counts = [F.size(F.filter(base, _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_named(base), 256).alias("base_sha256"),
                        _named(F.array_sort(F.concat(base, bare))).alias("spans"),
                        F.size(added).cast("long").alias("n_term"))


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """df with every base span replaced by its kind, revealing terms removed or generalised.

    Where spans overlap, the one that starts first covers the others. A null text stays null, and a text
    without spans is returned as it was.
    """
    found, bases, added = find(df, id_col, text_col, **limits)
    text = F.col(quoted(text_col))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    base = F.transform(F.col(bases), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                             F.element_at(tags, s["kind"] + 1).alias("tag")))
    more = F.transform(F.col(added), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                              F.when(s["posterior"] >= REMOVE_AT, F.lit("")).otherwise(F.lit("[TERM]")).alias("tag")))
    every = F.array_sort(F.concat(base, more))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        fresh_span = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh_span, F.concat(acc["parts"], F.array(between, s["tag"]))).otherwise(acc["parts"]).alias("parts"))

    clean = F.aggregate(every, start, step, lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))))
    out = F.when(F.size(every) > 0, clean).otherwise(text)
    return found.withColumn(text_col, out).select(*[quoted(c) for c in df.columns])
