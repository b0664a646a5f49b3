"""Incremental forms: idempotent ingest of a growing folder, and windowed events (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import append_if_absent


def ingest(stream: DataFrame, path: str, key: list[str], checkpoint: str):
    """Append what is not held yet, batch by batch; a replayed batch adds nothing."""
    return (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(lambda df, _: append_if_absent(df, path, key)).start())


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    return (events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total"))


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return (events.withWatermark("ts", gap).groupBy("user_id", F.session_window("ts", gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n"))


def event_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)
