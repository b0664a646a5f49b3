"""Append-only, idempotent stores: admission by hash, append-if-absent, upsert with counts, latest and first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def absent(new: DataFrame, held: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new, once a key, that held doesn't have."""
    return new.dropDuplicates(key).join(held.select(*key), key, "left_anti")


def append_if_absent(new: DataFrame, path: str, key: list[str], dry_run: bool = False) -> dict:
    """Offered, inserted and already present; a dry run computes the same and writes nothing."""
    spark = new.sparkSession
    try:
        held = spark.read.schema(new.schema).parquet(path)
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        held = spark.createDataFrame([], new.schema)
    fresh = absent(new, held, key)
    offered, inserted = new.count(), fresh.count()
    if inserted and not dry_run:
        fresh.write.mode("append").parquet(path)
    return {"offered": offered, "inserted": inserted, "already_present": offered - inserted}


def upsert_actions(old: DataFrame, new: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """Rows after an upsert with an action each; of a key repeated in new the last by `order` wins."""
    if order:
        last = Window.partitionBy(key).orderBy(F.desc(order))
        new = new.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    a, b = old.select(key, F.struct(*columns).alias("o")), new.select(key, F.struct(*columns).alias("n"))
    rows = a.join(b, key, "full_outer")
    action = F.when(F.col("o").isNull(), "inserted").when(F.col("n").isNull(), "kept").when(F.col("o").eqNullSafe(F.col("n")), "unchanged").otherwise("updated")
    return rows.select(key, action.alias("action"), F.coalesce("n", "o").alias("row")).select(key, "action", "row.*")


def action_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def first_per_key(df: DataFrame, key: list[str], order: list) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def latest(df: DataFrame, group: str, stamp: str, tie: str) -> DataFrame:
    """The row of greatest stamp per group, by one aggregation; ties go to the greater tie-break."""
    rest = [c for c in df.columns if c != group]
    return df.groupBy(group).agg(F.max_by(F.struct(*rest), F.struct(stamp, tie)).alias("r")).select(group, "r.*")


def with_completion(runs: DataFrame, completions: DataFrame, key: str) -> DataFrame:
    return runs.join(completions, key, "left")


def run_row(spark: SparkSession, run_id: str, status: str, error: str | None = None) -> DataFrame:
    return spark.createDataFrame([(run_id, status, error[:2000] if error else None)], "run_id string, status string, error string")


def one_owner(df: DataFrame, key: str, owner: Column) -> DataFrame:
    """Keys of df that are not the owner's; empty if the claim of ownership holds."""
    return df.select(key).distinct().where(F.col(key) != owner)
