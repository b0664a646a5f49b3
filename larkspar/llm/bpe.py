"""Byte-level BPE encoding and decoding by overlapping chunks.

Short texts are pre-tokenised whole. A text over CHUNK code points is cut into overlapping chunks that
are rows of their own, so its pre-tokens are found in parallel; neighbours are stitched at the first
boundary in their overlap that both found, from where both matchers must go on alike, since a match of
the pattern depends on nothing before its start. Where an overlap has no common boundary the two chunks
are matched again as one. The stitched pre-tokens are then encoded by rank, and decoding joins raw bytes.

Defined results: a null or empty text has no ids; rows that share an id stay separate rows; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _vec
from ._common import id_text
from .wavelet import held

CHUNK = 32_768
OVERLAP = 256
DOUBT = 4  # boundaries this near a chunk's end may move when more text follows
OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class RankCoder:
    """Encoder and decoder for a rank file."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        one = encoding._core_bpe.encode_single_piece
        self.pieces = _vec.PieceCoder(lambda found: [one(p.encode()) for p in found])
        size = max(ranks.values(), default=-1) + 1
        self.raw = [b""] * size
        for token, rank in ranks.items():
            self.raw[rank] = token
        self.decimal = [str(i) for i in range(size)]

    def encode(self, joined: str, cp: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.pieces(cp, starts, np.append(starts[1:], len(cp)), joined)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.raw[i] for i in ids])

    def digest(self, ids: list[int]) -> tuple[int, str, str]:
        text = ",".join([self.decimal[i] for i in ids])
        return len(ids), hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


def boundaries(text: str) -> np.ndarray:
    """Starts of a text's pre-tokens."""
    cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _vec.byte_level_starts(cp, np.array([0, len(cp)]))


def chunks(text: str, size: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, str]]:
    return [(at, text[at : at + size + overlap]) for at in range(0, max(1, len(text)), size)]


def stitch(parts: list[tuple[int, str, np.ndarray]]) -> tuple[str, np.ndarray]:
    """The whole text and its boundaries, from (offset, chunk, its boundaries within the chunk)."""
    parts = sorted(parts, key=lambda p: p[0])
    text, starts = parts[0][1], parts[0][2]
    for at, piece, own in parts[1:]:
        whole = text[:at] + piece
        mine = own + at
        sure = starts[(starts >= at) & (starts <= len(text) - DOUBT)]
        common = np.intersect1d(sure, mine)
        if len(common):
            starts = np.concatenate([starts[starts < common[0]], mine[mine >= common[0]]])
        else:  # one match spans the overlap: go on from the last boundary before it
            before = starts[starts <= min(at, max(0, len(text) - DOUBT))]
            last = int(before[-1]) if len(before) else 0
            starts = np.concatenate([starts[starts < last], boundaries(whole[last:]) + last])
        text = whole
    return text, starts


def _direct(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held(path, RankCoder)
        for batch in batches:
            for i, j, buf, offsets in _vec.slices(batch.column(1)):
                joined, at = _vec.decoded(buf, offsets)
                cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
                starts = _vec.byte_level_starts(cp, at)
                ids, each = coder.encode(joined, cp, starts)
                cut = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(starts, at)].tolist()
                found = [coder.digest(ids[a:b].tolist()) for a, b in zip(cut, cut[1:])]
                n, one, two = zip(*found)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(n, pa.int64()), pa.array(one), pa.array(two)],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _pre_tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [boundaries(t).astype("<i4").tobytes() for t in batch.column("chunk").to_pylist()]
        yield batch.append_column("starts", pa.array(found, pa.binary()))


def _stitched(path: str):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        coder = held(path, RankCoder)
        parts = [(int(a), c, np.frombuffer(s, "<i4").astype(np.int64)) for a, c, s in zip(group["at"], group["chunk"], group["starts"])]
        text, starts = stitch(parts)
        ids, _ = coder.encode(text, np.frombuffer(text.encode("utf-32-le"), np.uint32), starts)
        n, one, two = coder.digest(ids.tolist())
        return pd.DataFrame({"doc_id": group["doc_id"].iloc[:1], "n_tokens": [n], "ids_sha256": [one], "decoded_sha256": [two]})

    return run


def encode_digests(df: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    rows = id_text(df, id_col, text_col)
    size = F.char_length("text")
    short = rows.where(size <= CHUNK).mapInArrow(_direct(rank_path), OUT)
    long = rows.where(size > CHUNK).select("doc_id", F.xxhash64("doc_id", "text", F.monotonically_increasing_id()).alias("row"), "text")
    cut = long.select("doc_id", "row", F.explode(F.sequence(F.lit(0), ((F.char_length("text") - 1) / CHUNK).cast("int"))).alias("k"), "text")
    cut = cut.select("doc_id", "row", (F.col("k") * CHUNK).alias("at"), F.substring("text", F.col("k") * CHUNK + 1, F.lit(CHUNK + OVERLAP)).alias("chunk"))
    marked = (cut.repartition("row", "at")
              .mapInArrow(_pre_tokenise, "doc_id long, row long, at int, chunk string, starts binary"))
    stitched = marked.groupBy("row").applyInPandas(_stitched(rank_path), OUT)
    return short.unionByName(stitched)
