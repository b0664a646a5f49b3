"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._vec import roots


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``; only where that is unset (tests on
    one machine) does this make and set a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="larkspar-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def written(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: write to the shared folder, read back (survives lost executors)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/larkspar/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    with brief_plans(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with none of df's, whatever extra columns a caller brings."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"_lk_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


#: Bytes of an Arrow batch between the JVM and Python. Spark's own bound is 64 MB, and a task holds several copies of a batch.
BATCH_BYTES = 4 << 20


#: Characters of a plan's description. The driver keeps one for each of its last thousand executions, and makes one anew whenever a stage of a plan ends.
PLAN_CHARS = 4_096


@contextmanager
def brief_plans(spark: SparkSession) -> Iterator[None]:
    """Within, plan descriptions are bounded by PLAN_CHARS, unless the session names a bound itself; other queries of the session keep theirs whole."""
    key = "spark.sql.maxPlanStringLength"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(PLAN_CHARS))
    try:
        yield
    finally:
        spark.conf.unset(key)


def lean_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by BATCH_BYTES, unless it names a bound itself."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def id_text(df: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """Only the id and the text (null: empty), so a scan reads two columns; Arrow batches of texts are kept small."""
    lean_batches(df.sparkSession)
    return df.select(F.col(quoted(id_col)).cast("long").alias("doc_id"),
                     F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"), *more)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Rows of a broadcast side: about 32 MB. Beyond it the same join is a shuffled one.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, to be broadcast if it has at most `rows` rows. df should be cheap to count (a written table)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_key(text):
    """128 bits that tell texts apart."""
    return [F.xxhash64(text, F.lit(11)).alias("_lk_k1"), F.xxhash64(text, F.lit(12)).alias("_lk_k2")]


def with_first(rows: DataFrame) -> DataFrame:
    """rows(doc_id, text, ...) plus the text key, first (the least id with the same text) and copies (how many have it)."""
    groups = (rows.select("doc_id", *text_key("text")).groupBy("_lk_k1", "_lk_k2")
              .agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1"))
    groups = bounded(written(groups))
    held = rows.select("*", *text_key("text")).join(groups, ["_lk_k1", "_lk_k2"], "left")
    return held.withColumns({"first": F.coalesce("first", "doc_id"), "copies": F.coalesce("copies", F.lit(1).cast("long"))})


def hot_salted(rows: DataFrame, counts: DataFrame, key: str, n: str, spread: str, salts: int = 64) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column _lk_salt that deals rows of hot keys over `salts` tasks.

    A key is hot if it has over a thousandth of all counted rows, so at most 1000 keys are broadcast.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    hot = counts.where(F.col(n) > max(1_000, total // 1_000)).select(key)
    names = hot.select(F.col(key).alias("_lk_hot"))
    left = (rows.join(F.broadcast(names), F.col(key) == F.col("_lk_hot"), "left")
            .withColumn("_lk_salt", F.when(F.col("_lk_hot").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))).drop("_lk_hot"))
    right = (counts.join(F.broadcast(names), F.col(key) == F.col("_lk_hot"), "left")
             .withColumn("_lk_salt", F.explode(F.when(F.col("_lk_hot").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(salts - 1))))).drop("_lk_hot"))
    return left, right


def keyed_join(rows: DataFrame, side: DataFrame, key: str, n: str, spread: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """rows joined with side, a written table of one row a key that counts key's rows in column n.

    The side is broadcast up to `most` rows; beyond that the rows of hot keys are dealt over many tasks.
    """
    if side.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(side.drop(n)), key)
    left, right = hot_salted(rows, side, key, n, spread)
    return left.join(right.drop(n), [key, "_lk_salt"]).drop("_lk_salt")


#: Edges whose components the driver finds by itself: 8 MB, less than a broadcast side.
LOCAL_EDGES = BROADCAST_ROWS // 2


def forest(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """The vertices of the edges (a, b) that are not the least of their component, and that least one."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = roots(len(names), at[: len(a)], at[len(a) :])
    tied = np.flatnonzero(root != np.arange(len(names)))
    return [names[tied], names[root[tied]]]


def components(edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(id, root) of every vertex of edges (a, b) but the roots: root is the least id it is connected to.

    Alternating large-star and small-star rounds, each written to the shared folder, as long as there are more than
    `local_edges` edges; the driver ends what is left, since rounds over few rows cost it more in plans, stages
    and broadcasts than the rows take. Vertices are grouped with partial aggregation, and a star's centre,
    which a third of all edges may share, is joined by `keyed_join`.
    """
    links = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    state, seen = (links.count(),), None
    while state[0] > local_edges and state != seen:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = keyed_join(both.where("v > u"), written(least), "u", "n", "v").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = written(large)
        down = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        small = keyed_join(large, down, "u", "n", "v").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.unionByName(down.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        seen, state = state, tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    found = links.select(F.col("u").alias("id"), F.col("v").alias("root"))
    if not state[0] or state[0] > local_edges:
        return found
    held = links.toArrow()
    tied = pa.table(forest(*(held.column(c).to_numpy() for c in ("u", "v"))), names=["id", "root"])
    return written(links.sparkSession.createDataFrame(tied, found.schema))
