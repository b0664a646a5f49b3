"""Corpus strata, caps, splits and quotas; model metrics, gates and non-inferiority."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import rate
from .ordering import numbered

# Gates (metric, bound, least or most) and margins.
GATES = [("schema_valid", 0.99, "min"), ("recall", 0.95, "min"), ("precision", 0.90, "min"), ("type_accuracy", 0.85, "min"), ("hard_negative", 0.90, "min"), ("needs_review", 0.15, "max"), ("isolation", 0.0, "max")]
MARGINS = {"recall": 0.05, "precision": 0.05, "accuracy": 0.05}
SPLIT = ["dev", "dev", "holdout", "dev", "holdout"]


def capped(df: DataFrame, group: str, order: list, most: int) -> DataFrame:
    """df with the rank in its group and whether it is over the cap."""
    return numbered(df, [group], order).withColumn("overflow", F.col("rank") > most)


def round_robin(df: DataFrame, group: str, order: str, pattern: list[str] = SPLIT) -> DataFrame:
    at = (F.col("_k") - 1) % len(pattern)
    return numbered(df, [group], [order], "_k").withColumn("split", F.element_at(F.array(*[F.lit(p) for p in pattern]), (at + 1).cast("int"))).drop("_k")


def hash_sample(df: DataFrame, stratum: str, key: str, n: int) -> DataFrame:
    w = Window.partitionBy(stratum).orderBy(F.md5(F.col(key).cast("string")), key)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def quota_sample(df: DataFrame, category: str, owner: str, key: str, quotas: dict[str, int], cap: int, priority: str | None = None) -> DataFrame:
    """Greedy quotas in key order under a cap an owner that all categories share.

    The cap's state crosses categories, so the candidates (at most quota x owners of the cap a category)
    are walked in one group; each category is cut beforehand to the rows that could be picked at all.
    """
    import pandas as pd

    per_owner = Window.partitionBy(category, owner).orderBy(key)
    pool = df.select(category, owner, key).where(F.col(category).isin(list(quotas))).withColumn("_n", F.row_number().over(per_owner)).where(F.col("_n") <= cap)
    need = sum(quotas.values())
    pool = pool.withColumn("_m", F.row_number().over(Window.partitionBy(category).orderBy((F.col(owner) != F.lit(priority)).cast("int") if priority is not None else F.lit(0), key)))
    pool = pool.where(F.col("_m") <= need * (need + 1)).drop("_n", "_m").withColumn("_all", F.lit(0))

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        used, out = {}, []
        for c in sorted(quotas):
            own = rows[rows[category] == c].assign(_p=lambda r: r[owner] != priority).sort_values(["_p", key])
            taken = 0
            for i, o in zip(own.index, own[owner]):
                if taken < quotas[c] and used.get(o, 0) < cap:
                    used[o] = used.get(o, 0) + 1
                    taken += 1
                    out.append(i)
        return rows.loc[out]

    return pool.groupBy("_all").applyInPandas(pick, pool.schema).drop("_all")


def metrics(rows: DataFrame, gold: str, predicted: str, group: str | None = None) -> DataFrame:
    """Counts and rates of a binary prediction, over all or by group."""
    g, p, n = F.col(gold) == 1, F.col(predicted) == 1, lambda c, name: F.count_if(c).alias(name)
    agg = [F.count(F.lit(1)).alias("n"), n(g & p, "tp"), n(~g & p, "fp"), n(g & ~p, "fn"), n(~g & ~p, "tn")]
    out = (rows.groupBy(group) if group else rows.groupBy()).agg(*agg)
    r = lambda a, b: F.round(rate(a, b), 6)
    tp, fp, fn, tn, total = (F.col(c) for c in ("tp", "fp", "fn", "tn", "n"))
    # severity: a miss costs five, a false alarm two
    return out.withColumns({"recall": r(tp, tp + fn), "precision": r(tp, tp + fp), "accuracy": r(tp + tn, total), "severity": fn * 5 + fp * 2})


def gates(values: DataFrame, table: list[tuple[str, float, str]] = GATES) -> DataFrame:
    """(metric, value, bound, passed) for a one-row frame of metrics; a missing value passes vacuously."""
    own = [(m, b, d) for m, b, d in table if m in values.columns]
    parts = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.lit(b).alias("bound"),
                               F.coalesce(F.col(m) >= b if d == "min" else F.col(m) <= b, F.lit(True)).alias("passed")) for m, b, d in own])
    return values.select(F.explode(parts).alias("x")).select("x.*")


def non_inferior(reference: DataFrame, challenger: DataFrame, margins: dict[str, float] = MARGINS) -> DataFrame:
    """A metric is inferior if the gap reaches the margin and the challenger errs on two rows more."""
    a = reference.select(*[F.col(m).alias(f"r_{m}") for m in margins], (F.col("fp") + F.col("fn")).alias("r_err"))
    b = challenger.select(*[F.col(m).alias(f"c_{m}") for m in margins], (F.col("fp") + F.col("fn")).alias("c_err"))
    both = a.crossJoin(F.broadcast(b))  # one row each
    parts = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"r_{m}").alias("reference"), F.col(f"c_{m}").alias("challenger"),
                               (~F.coalesce((F.col(f"r_{m}") - F.col(f"c_{m}") >= k) & (F.col("c_err") - F.col("r_err") >= 2), F.lit(False))).alias("non_inferior")) for m, k in margins.items()])
    return both.select(F.explode(parts).alias("x")).select("x.*")


def exactly_one(gold: DataFrame, attempts: DataFrame, key: str) -> DataFrame:
    """Keys that break one attempt a gold row: missing, duplicate or unknown."""
    n = attempts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rows = gold.select(key).withColumn("g", F.lit(True)).join(n, key, "full_outer")
    why = F.when(F.col("g").isNull(), "UNKNOWN").when(F.col("n").isNull(), "MISSING").when(F.col("n") > 1, "DUPLICATE")
    return rows.select(key, why.alias("problem")).where("problem is not null")
