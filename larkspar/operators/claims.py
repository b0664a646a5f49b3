"""Published website claims: comparison at read time, never stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reconcile import tally


def compare(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every pair of the two kinds' claims within a key, with its verdict."""
    pick = lambda d, s: d.select(key, F.col("claim.status").alias(f"{s}_status"), F.col("claim.hostname").alias(f"{s}_host"), F.col("claim.domain").alias(f"{s}_domain"))
    pairs = pick(left, "left").join(pick(right, "right"), key)
    a, b = F.col("left_status") == "STRUCTURALLY_VALID", F.col("right_status") == "STRUCTURALLY_VALID"
    verdict = (F.when(a & b & (F.col("left_domain") == F.col("right_domain")), "DOMAIN_AGREE").when(a & b, "DOMAIN_DISAGREE")
               .when(a | b, "ONE_SIDE_MISSING").otherwise("NOT_COMPARABLE"))
    return pairs.withColumns({"verdict": verdict, "hosts_equal": F.coalesce(a & b & (F.col("left_host") == F.col("right_host")), F.lit(False))})


def summary(pairs: DataFrame) -> DataFrame:
    return pairs.agg(*[F.count_if(F.col("verdict") == v).alias(v.lower()) for v in ("DOMAIN_AGREE", "DOMAIN_DISAGREE", "ONE_SIDE_MISSING", "NOT_COMPARABLE")],
                     F.count_if("hosts_equal").alias("hosts_equal"))


def structure(claims: DataFrame) -> DataFrame:
    return claims.groupBy(F.col("claim.status").alias("status"), F.coalesce("claim.reason", F.lit("")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def domain_tally(claims: DataFrame) -> DataFrame:
    return tally(claims.where(F.col("claim.status") == "STRUCTURALLY_VALID").select(F.col("claim.domain").alias("domain")), "domain")
