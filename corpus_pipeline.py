"""From raw documents to packed training sequences: toxicity, exact dedup, near dedup, privacy, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last
return the columns of documents. Every stage's rows are written as Parquet to the shared folder and read
again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspar.llm import exact_dedup, ngram_jaccard, packing, pii, toxicity
from larkspar.llm._common import documents, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the label table teaches, and clean documents stay."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays; rows go by id and text, a null id is never dropped."""
    return ngram_jaccard.deduplicate(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, revealing terms go; n_chars follows the text."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
          ("personal data", hide_personal_data), ("packing", pack)]

#: The stages with learned models, hashes and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
