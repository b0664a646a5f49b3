"""Bounded breadth-first search, redirect chains, circuit breakers and budgets over recorded data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import numbered


def bfs(edges: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """(node, depth) reached from roots(node) over edges(src, dst), level by level; `depth` joins at most."""
    seen = roots.select("node", F.lit(0).alias("depth"))
    level = seen
    for k in range(1, depth + 1):
        level = level.select("node").join(edges, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(k))
        seen = seen.unionByName(level)
    return seen


def chain(edges: DataFrame, starts: DataFrame, hops: int = 5) -> DataFrame:
    """(start, node, hops): where each start's single-successor chain ends within the limit."""
    rows = starts.select(F.col("node").alias("start"), "node", F.lit(0).alias("hops"))
    for _ in range(hops):
        rows = rows.join(edges, F.col("node") == F.col("src"), "left").select("start", F.coalesce("dst", "node").alias("node"), (F.col("hops") + F.col("dst").isNotNull().cast("int")).alias("hops"))
    return rows


def breaker(attempts: DataFrame, host: str, order: list[str], failed: str, limit: int = 3) -> DataFrame:
    """attempts with the failure run so far and whether the host's breaker was open before the attempt."""
    w = Window.partitionBy(host).orderBy(*order)
    rows = attempts.withColumn("_ok", F.sum((~F.col(failed)).cast("int")).over(w))
    run = F.sum(F.col(failed).cast("int")).over(Window.partitionBy(host, "_ok").orderBy(*order))
    rows = rows.withColumn("run", run).withColumn("_trip", (F.col("run") >= limit).cast("int"))
    before = F.coalesce(F.max("_trip").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("open", before == 1).drop("_ok", "_trip")


def within_budget(attempts: DataFrame, host: str, order: list[str], budget: int) -> DataFrame:
    return numbered(attempts, [host], order, "used").withColumn("allowed", F.col("used") <= budget)
