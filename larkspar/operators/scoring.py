"""Rule scoring of pages: rules are rows, a rule counts once a (page, track, field)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text, web
from .ordering import numbered

RULE_VERSION = "pack-1"
ALL = ["urlPath", "anchorText", "title", "heading"]
BOTH = ["A", "B"]

# Fixed values: (rule, tracks, kind, weight, fields, phrases).
RULES = [
    ("NEG_LOGIN_AUTH", BOTH, "neg", 3, ["urlPath"], "login; signin; sign in; authentification; connexion"),
    ("NEG_SHOPPING_CART", BOTH, "neg", 3, ["urlPath"], "cart; panier; checkout"),
    ("NEG_SEARCH_RESULTS", BOTH, "neg", 2, ["urlPath"], "search results; search"),
    ("NEG_NEWS_ARCHIVE", BOTH, "neg", 2, ["urlPath"], "news; archive; archives; actualites"),
    ("NEG_UTILITY_SECTION", BOTH, "neg", 2, ["urlPath"], "sitemap; legal; privacy; mentions legales; cookies; accessibility"),
    ("NEG_PROGRAMME_SHAPE", BOTH, "neg", 4, ["urlPath", "title"], "msc; mba; bsc; llm; phd; master of; bachelor of; licence professionnelle; doctorat"),
    ("NEG_ACADEMIC_RESEARCH_SCOPE", BOTH, "veto", 6, ["urlPath"], "recherche; research"),
    ("A_FR_RELATIONS_INTERNATIONALES", ["A"], "pos", 5, ALL, "relations internationales; bureau des relations internationales"),
    ("A_FR_SERVICE_RELATIONS_INTERNATIONALES", ["A"], "pos", 5, ALL, "service des relations internationales"),
    ("A_FR_ETUDIANTS_INTERNATIONAUX", ["A"], "pos", 4, ALL, "etudiants internationaux"),
    ("A_FR_ETUDIANTS_ENTRANTS", ["A"], "pos", 4, ALL, "etudiants entrants"),
    ("A_FR_MOBILITE_INTERNATIONALE", ["A"], "pos", 4, ALL, "mobilite internationale; mobilite etudiante"),
    ("A_FR_ACCUEIL_INTERNATIONAL", ["A"], "pos", 3, ALL, "accueil international"),
    ("B_FR_CENTRE_DE_LANGUES", ["B"], "pos", 5, ALL, "centre de langues; centre des langues"),
    ("B_FR_DEPARTEMENT_LANGUES", ["B"], "pos", 5, ALL, "departement langues; departement de langues; departement des langues"),
    ("B_FR_UFR_LANGUES", ["B"], "pos", 4, ALL, "ufr langues; ufr de langues"),
    ("B_FR_FLE", ["B"], "pos", 4, ALL, "fle; francais langue etrangere"),
    ("B_FR_LANSAD", ["B"], "pos", 4, ALL, "lansad"),
    ("B_FR_CRL", ["B"], "pos", 3, ALL, "crl"),
    ("A_INTL_OFFICE", ["A"], "pos", 5, ALL, "international office"),
    ("A_INTL_STUDENT_SERVICES", ["A"], "pos", 5, ALL, "international student services"),
    ("A_INTL_RELATIONS_OFFICE", ["A"], "pos", 5, ALL, "international relations office; office of international relations"),
    ("A_INTL_STUDENTS", ["A"], "pos", 4, ALL, "international students"),
    ("A_INCOMING_STUDENTS", ["A"], "pos", 4, ALL, "incoming students"),
    ("A_EXCHANGE_STUDENTS", ["A"], "pos", 4, ALL, "exchange students; exchange programme; exchange program"),
    ("A_MOBILITY_OFFICE", ["A"], "pos", 4, ALL, "mobility office"),
    ("A_STUDY_ABROAD", ["A"], "pos", 3, ALL, "study abroad"),
    ("A_ERASMUS", ["A"], "pos", 3, ALL, "erasmus"),
    ("A_WELCOME_INTERNATIONAL", ["A"], "pos", 3, ALL, "welcome international; international welcome"),
    ("A_INTERNATIONAL_GENERIC", ["A"], "pos", 1, ALL, "international"),
    ("A_MOBILITY_GENERIC", ["A"], "pos", 1, ALL, "mobility"),
    ("B_LANGUAGE_CENTRE", ["B"], "pos", 5, ALL, "language centre; language center"),
    ("B_LANGUAGE_DEPARTMENT", ["B"], "pos", 4, ALL, "language department; languages department"),
    ("B_LANGUAGE_TEACHING", ["B"], "pos", 3, ALL, "language teaching"),
]


def rule_table(spark: SparkSession, rules=None) -> DataFrame:
    """One row a (rule, track, field), with its normalised phrases."""
    rows = [(r, t, k, w, f, [p.strip() for p in ps.split(";")]) for r, ts, k, w, fs, ps in (rules or RULES) for t in ts for f in fs]
    return spark.createDataFrame(rows, "rule string, track string, kind string, weight int, field string, phrases array<string>").withColumn("rule_version", F.lit(RULE_VERSION))


def matches(pages: DataFrame, key: str, fields: dict[str, str], rules: DataFrame) -> DataFrame:
    """(key, track, rule, field, kind, weight) for every rule that fires; the rule table is small and fixed."""
    long = pages.select(key, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), text.match_form(F.col(c)).alias("form")) for f, c in fields.items()])).alias("x")).select(key, "x.*")
    return (long.join(F.broadcast(rules), "field").where(F.exists("phrases", lambda p: text.has_phrase(F.col("form"), p)))
            .select(key, "track", "rule", "field", "kind", "weight"))


def structural(pages: DataFrame, key: str, url: str) -> DataFrame:
    """A negative for paths that end in a file's extension."""
    return (pages.where(web.is_binary(F.col(url))).select(key, F.explode(F.array(F.lit("A"), F.lit("B"))).alias("track"), F.lit("NEG_BINARY_FILE_EXTENSION").alias("rule"),
                                                          F.lit("urlPath").alias("field"), F.lit("neg").alias("kind"), F.lit(3).alias("weight")))


def scores(pages: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """One signed score per page and track, zero where nothing fired, with its signals in order."""
    every = pages.select(key, F.explode(F.array(F.lit("A"), F.lit("B"))).alias("track"))
    signed = F.when(F.col("kind") == "pos", F.col("weight")).otherwise(-F.col("weight"))
    sums = found.groupBy(key, "track").agg(F.sum(signed).alias("s"), F.count_if(F.col("kind") == "veto").alias("vetoes"), F.array_sort(F.collect_set(F.struct("rule", "field", "kind"))).alias("signals"))
    none = F.array().cast("array<struct<rule:string,field:string,kind:string>>")
    return every.join(sums, [key, "track"], "left").select(key, "track", F.coalesce("s", F.lit(0)).cast("long").alias("score"), (F.coalesce("vetoes", F.lit(0)) > 0).alias("veto"),
                                                          F.coalesce("signals", none).alias("signals"))


def ranked(scored: DataFrame, group: list[str], url: str, top: int | None = None) -> DataFrame:
    """Ranks by score; a top is cut early in every task, all ranks are numbered over ranges."""
    if top is None:
        return numbered(scored, group, [F.desc("score"), url])
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), url))).where(F.col("rank") <= top)


def inherited(scored: DataFrame, key: str, segments: str) -> DataFrame:
    """Contribution of the nearest section root among a path's strict prefixes, one and two steps up."""
    roots = scored.where((F.size(segments) <= 3) & (F.col("score") >= 4) & ~F.col("veto")).groupBy("track", F.array_join(segments, "/").alias("prefix")).agg(F.max("score").alias("root_score"))
    up = scored.select(key, "track", "veto", segments, F.explode(F.array(F.lit(1), F.lit(2))).alias("distance")).where((F.size(segments) - F.col("distance") >= 0) & ~F.col("veto"))
    up = up.withColumn("prefix", F.array_join(F.slice(segments, F.lit(1), F.size(segments) - F.col("distance")), "/"))
    near = up.join(roots, ["track", "prefix"]).groupBy(key, "track").agg(F.min_by("root_score", "distance").alias("root_score"), F.min("distance").alias("distance"))
    return near.select(key, "track", (F.col("root_score") * text.decay(F.col("distance"))).alias("inherited"), "distance")


def frontier_order(pages: DataFrame, score_a: str, score_b: str, method: str, url: str, floor: int = 8) -> DataFrame:
    """The order a static pool is picked in: the best track-B pages up to the floor, then best first."""
    best = F.greatest(score_a, score_b)
    own = F.when(F.col(score_a) >= F.col(score_b), F.col(score_a)).otherwise(F.col(score_b))
    keys = [F.desc(best), F.desc((own > 0).cast("int")), F.when(F.col(method) == "SITEMAP", 0).otherwise(1), F.col(url)]
    order = [F.desc(score_b), *keys]
    first = pages.where(F.col(score_b) > 0).orderBy(*order).limit(floor)  # the floor's few rows
    first = first.withColumn("_b", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))).select(url, "_b")
    rows = pages.join(F.broadcast(first), url, "left").withColumn("_phase", F.col("_b").isNull().cast("int"))
    return numbered(rows, [], ["_phase", "_b", *keys], "pick").select(*pages.columns, "pick")


def lexicon_score(form, phrases: list[tuple[str, int]]):
    """Sum of the weights of the phrases a normalised text has."""
    return reduce(lambda a, b: a + b, [F.when(text.has_phrase(form, F.lit(p)), F.lit(w)).otherwise(0) for p, w in phrases])
