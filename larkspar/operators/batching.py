"""Exact-content dedupe, signal merge, bounded batches and canonical hashes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical_json, digest
from .ordering import numbered, same, written

MOST_DOCS, MOST_CHARS = 24, 64_000
BLOCK = 8_192  # documents of a block


def by_content(df: DataFrame, body: str, rank: str, name: str) -> DataFrame:
    """(sha, representative, n, least and greatest name) per distinct body; the least (rank, name) represents."""
    return df.groupBy(digest(F.col(body)).alias("sha")).agg(F.min_by(name, F.struct(rank, name)).alias("representative"), F.count(F.lit(1)).alias("n"),
                                                            F.min(name).alias("least"), F.max(name).alias("greatest"))


def merged_signals(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    return df.groupBy(key).agg(F.array_sort(F.collect_set(F.struct(*fields))).alias("signals"))


def packed(df: DataFrame, group: str, name: str, size: str, most_docs: int = MOST_DOCS, most_size: int = MOST_CHARS, block: int = BLOCK) -> DataFrame:
    """A batch number per document: documents in name order, a new batch when the open one is full.

    Where a batch ends depends on its first document alone, and lies at most `most_docs` rows on. So a group
    is cut into blocks, each with the next block's first rows to look ahead; a block says, for each place its
    first batch may start at, where the next block's starts and how many batches it has. Only these short
    rows are folded a group; every block then numbers its own documents. A null size counts as 0; a document
    over the bound is a batch of its own.
    """
    own = df.select(F.col(group).alias("g"), F.col(name).cast("string").alias("name"), F.col(name).alias("key"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"))
    rows = numbered(own, ["g"], ["key"], "k").drop("key")
    at, width = F.col("k") - 1, max(block, most_docs)
    here = F.floor(at / width)
    into = F.when((at % width < most_docs) & (here > 0), F.array(here, here - 1)).otherwise(F.array(here))
    dealt = written(rows.select("g", "name", "size", "k", here.alias("home"), F.explode(into).alias("block")))

    def jumps(rows: pd.DataFrame) -> tuple[pd.DataFrame, int, np.ndarray]:
        rows = rows.sort_values("k", ignore_index=True)
        total = np.concatenate([[0], rows["size"].cumsum()])
        i = np.arange(len(rows))
        after = np.minimum(np.searchsorted(total, total[:-1] + most_size, "right") - 1, i + most_docs)
        return rows, int((rows["home"] == rows["block"]).sum()), np.maximum(after, i + 1)

    def outline(rows: pd.DataFrame) -> pd.DataFrame:
        rows, n, after = jumps(rows)
        leaves, batches = [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            j = int(after[i])
            leaves[i], batches[i] = (j - n, 1) if j >= n else (leaves[j], batches[j] + 1)
        return pd.DataFrame({"g": [rows["g"][0]], "block": [rows["block"][0]], "leaves": [leaves[:most_docs]], "batches": [batches[:most_docs]]})

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block", ignore_index=True)
        start, base, out = 0, 0, []
        for leaves, batches in zip(rows["leaves"], rows["batches"]):
            out.append((start, base))
            # a last block may end before a batch of the one before does
            start, base = (int(leaves[start]), base + int(batches[start])) if start < len(leaves) else (0, base)
        return rows[["g", "block"]].assign(start=[x for x, _ in out], base=[x for _, x in out])

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        rows, n, after = jumps(rows)
        first, i = np.zeros(n, np.int64), int(rows["start"][0])
        while i < n:
            first[i] = 1
            i = int(after[i])
        rows = rows.iloc[:n]
        return pd.DataFrame({"g": rows["g"], "name": rows["name"], "batch": rows["base"] + np.cumsum(first) - 1})

    kind = df.select(F.col(group).alias("g")).schema["g"].dataType.simpleString()
    outlines = dealt.groupBy("g", "block").applyInPandas(outline, f"g {kind}, block long, leaves array<long>, batches array<long>")
    starts = written(outlines.groupBy("g").applyInPandas(fold, f"g {kind}, block long, start long, base long"))
    joined = dealt.join(starts, same(dealt, starts, ["g", "block"])).select(*[dealt[c] for c in dealt.columns], "start", "base")
    out = joined.groupBy("g", "block").applyInPandas(number, f"g {kind}, name string, batch int")
    return out.select(F.col("g").alias(group), F.col("name").alias(name), "batch")


def with_index(df: DataFrame, group: list[str], order: str) -> DataFrame:
    return numbered(df, group, [order], "doc_index").withColumn("doc_index", F.col("doc_index") - 1)


def record_hash(**fields):
    return digest(canonical_json(**fields))
