"""Dual-identifier reconciliation and identifier quality.

The entities' identifiers become (entity, value) pairs. A row needs of a value only how many entities publish it,
and of its two values together whether one entity publishes both; so the sides that rows are joined with hold a
number or a flag for each value, never the list of a value's entities, and no join returns more rows than it got.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def publishers(entities: DataFrame, entity: str, values: str, out: str) -> DataFrame:
    """Distinct (_entity, value) pairs of an array column."""
    return entities.select(F.col(entity).alias("_entity"), F.explode(values).alias(out)).where(F.col(out).isNotNull() & F.col("_entity").isNotNull()).distinct()


def identifier_verdict(value: Column, n: Column) -> Column:
    return F.when(value.isNull(), "UNKNOWN").when(n == 0, "NO_MATCH").when(n == 1, "MATCH").otherwise("MATCH_MULTI")


def reconcile(left: DataFrame, first: str, second: str, right: DataFrame, entity: str, firsts: str, seconds: str) -> DataFrame:
    """left plus how many entities each identifier reaches, a verdict a identifier, the row's verdict and its grade.

    Whether both identifiers reach a common entity is looked up in the pairs of values that one entity publishes:
    the product of an entity's own two lists, not of the entities that share a value.
    """
    a, b = publishers(right, entity, firsts, "_a"), publishers(right, entity, seconds, "_b")
    both = a.join(b, "_entity").select(F.col("_a").alias("_both_a"), F.col("_b").alias("_both_b")).distinct().withColumn("_common", F.lit(True))
    n_a, n_b = (x.groupBy(c).agg(F.count(F.lit(1)).alias(f"{c}_n")) for x, c in ((a, "_a"), (b, "_b")))
    rows = (left.join(n_a, F.col(first) == F.col("_a"), "left").join(n_b, F.col(second) == F.col("_b"), "left")
            .join(both, (F.col(first) == F.col("_both_a")) & (F.col(second) == F.col("_both_b")), "left")
            .withColumns({"first_n": F.coalesce("_a_n", F.lit(0).cast("long")), "second_n": F.coalesce("_b_n", F.lit(0).cast("long")), "common": F.coalesce("_common", F.lit(False))})
            .drop("_a", "_b", "_a_n", "_b_n", "_both_a", "_both_b", "_common"))
    p, e = F.col("first_n"), F.col("second_n")
    verdict = (F.when((p > 0) & (e > 0) & ~F.col("common"), "MATCH_BOTH_CONFLICT").when((p == 1) & (e == 1), "MATCH_BOTH_AGREE")
               .when((p > 0) & (e > 0), "MATCH_BOTH_AMBIGUOUS").when(p == 1, "MATCH_FIRST_ONLY").when(p > 1, "MATCH_FIRST_ONLY_AMBIGUOUS")
               .when(e == 1, "MATCH_SECOND_ONLY").when(e > 1, "MATCH_SECOND_ONLY_AMBIGUOUS").otherwise("NO_MATCH"))
    rows = rows.withColumns({"first_verdict": identifier_verdict(F.col(first), p), "second_verdict": identifier_verdict(F.col(second), e), "verdict": verdict})
    v = F.col("verdict")
    return rows.withColumn("grade", F.when(v == "MATCH_BOTH_CONFLICT", "CONFLICT").when(v.endswith("AMBIGUOUS"), "AMBIGUOUS").when(v == "NO_MATCH", "NO_MATCH").otherwise("UNIQUE"))


def hits(rows: DataFrame, value: str, right: DataFrame, entity: str, values: str) -> DataFrame:
    """One row for each of rows and each entity that its value reaches, for the rows whose entities are asked for."""
    return rows.join(publishers(right, entity, values, "_v"), F.col(value) == F.col("_v")).drop("_v").withColumnRenamed("_entity", "hit")


def summary(rows: DataFrame, unusable: int = 0) -> DataFrame:
    """One row of counters over reconciled rows; unusable source rows stay in the denominator."""
    v, n = F.col("verdict"), lambda c, name: F.count_if(c).alias(name)
    p, e = F.col("first_n") > 0, F.col("second_n") > 0
    return rows.agg((F.count(F.lit(1)) + unusable).alias("total"), F.count(F.lit(1)).alias("comparable"), F.lit(unusable).cast("long").alias("unusable"),
                    n(p, "by_first"), n(e, "by_second"), n(p & e, "by_both"), n(p & ~e, "first_only"), n(e & ~p, "second_only"), n(p | e, "either"), n(~p & ~e, "neither"),
                    n(v == "MATCH_BOTH_AGREE", "agree"), n(v == "MATCH_BOTH_CONFLICT", "conflict"), n(v == "MATCH_BOTH_AMBIGUOUS", "ambiguous_both"),
                    n(F.col("grade") == "UNIQUE", "grade_unique"), n(F.col("grade") == "AMBIGUOUS", "grade_ambiguous"), n(F.col("grade") == "CONFLICT", "grade_conflict"),
                    n(F.col("grade") == "NO_MATCH", "grade_no_match"))


def grades(rows: DataFrame) -> DataFrame:
    return rows.groupBy("grade").agg(F.count(F.lit(1)).alias("n"))


def reverse_coverage(left: DataFrame, first: str, second: str, right: DataFrame, entity: str, firsts: str, seconds: str) -> DataFrame:
    """(reached, unreached) distinct entities: those that publish a value some row of left holds, and the others."""
    def reached(value: str, values: str) -> DataFrame:
        held = left.select(F.col(value).alias("_v")).distinct()
        return publishers(right, entity, values, "_v").join(held, "_v", "left_semi").select(F.col("_entity").alias(entity))

    found = reached(first, firsts).union(reached(second, seconds)).distinct()
    return (right.select(entity).distinct().join(found.withColumn("hit", F.lit(True)), entity, "left")
            .agg(F.count("hit").alias("reached"), F.count_if(F.col("hit").isNull()).alias("unreached")))


def shared_identifiers(rows: DataFrame, value: str, entity: str) -> DataFrame:
    """Values that more than one entity publishes, with how many and the least and greatest of them."""
    return (rows.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.countDistinct(entity).alias("n_entities"), F.min(entity).alias("least"), F.max(entity).alias("greatest"))
            .where("n_entities > 1"))


def multi_valued(rows: DataFrame, entity: str, value: str) -> DataFrame:
    return rows.groupBy(entity).agg(F.countDistinct(value).alias("n_values")).where("n_values > 1")


def duplicates(df: DataFrame, columns: list[str], top: int = 20) -> DataFrame:
    """For each column its most repeated values; one pass over df."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    n = long.where("value is not null").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value"))).where(F.col("rank") <= top)


def surplus(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: distinct values, values, surplus."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    by = long.where("value is not null").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    return by.groupBy("field").agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("n").alias("n_values"), (F.sum("n") - F.count(F.lit(1))).alias("surplus"))


def tally(df: DataFrame, value: str) -> DataFrame:
    """(distinct values, values on several rows, rows on such values)."""
    n = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.count(F.lit(1)).alias("n_distinct"), F.count_if(F.col("n") > 1).alias("n_shared"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_on_shared"))


def domain_overlap(left: DataFrame, domain: str, first: str, second: str, right: DataFrame, entity: str, order: str, firsts: str, seconds: str) -> DataFrame:
    """Left domains that equal a folded entity id (first document wins), and those where that entity also publishes one of the row's identifiers."""
    ids = right.groupBy(F.lower(F.col(entity).cast("string")).alias("_folded")).agg(F.min_by(entity, order).alias("_domain_entity"))
    joined = left.join(ids, F.lower(F.col(domain)) == F.col("_folded"), "left")
    for value, values, side in ((first, firsts, "_p"), (second, seconds, "_e")):
        pairs = publishers(right, entity, values, f"{side}_value").withColumnRenamed("_entity", f"{side}_entity")
        joined = joined.join(pairs, (F.col("_domain_entity") == F.col(f"{side}_entity")) & (F.col(value) == F.col(f"{side}_value")), "left")
    return joined.agg(F.count(domain).alias("with_domain"), F.count("_domain_entity").alias("equals_entity"),
                      F.count_if(F.col("_p_entity").isNotNull() | F.col("_e_entity").isNotNull()).alias("corroborated"))
