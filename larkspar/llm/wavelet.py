"""Token ids in binary shards: a wavelet matrix per block, read back by rank and select.

Documents are range-partitioned and sorted by id, encoded with a word-level BPE file, and stored block
by block: one row of the shard file holds a block's document table and its wavelet matrix (sixteen
bit-planes, each compressed, with rank samples). A block ends once it has BLOCK_TOKENS ids, so memory
follows the block and the longest document, never the partition.

Defined results: a null text is empty (its ids are just the end id); equal ids keep every row, in order
of their texts; null ids come first; an empty table writes no blocks and reads back no rows; other
columns are not stored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _vec
from ._common import id_text, shared_dir

BLOCK_TOKENS = 1 << 20
LEVELS = 16
END_ID = 1
MAGIC = b"LKWM1\0"
RANK_STEP = 4096
SHARD = "part int, block int, n_tokens long, doc_ids binary, lengths binary, matrix binary"


class WaveletMatrix:
    """Access, rank, select and occurrence lookup over a sequence of 16-bit symbols."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], samples: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.samples = n, zeros, planes, samples

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        """Stable partition by each bit, highest first."""
        seq = ids.astype(np.uint16)
        zeros, planes, samples = [], [], []
        for level in range(LEVELS - 1, -1, -1):
            bit = (seq >> np.uint16(level) & np.uint16(1)).astype(bool)
            low, high = seq[~bit], seq[bit]
            zeros.append(len(low))
            planes.append(np.packbits(bit))
            samples.append(cls._sample(planes[-1]))
            seq = np.concatenate([low, high])
        return cls(len(ids), zeros, planes, samples)

    @staticmethod
    def _sample(packed: np.ndarray) -> np.ndarray:
        """Ones before every RANK_STEP-th bit."""
        step = RANK_STEP // 8
        ones = np.bitwise_count(np.pad(packed, (0, -len(packed) % step))).reshape(-1, step).sum(1)
        return np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)

    def to_bytes(self) -> bytes:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        body = [pack(np.concatenate([s.view(np.uint8), p]).tobytes()) for s, p in zip(self.samples, self.planes)]
        head = struct.pack(f"<6sQ{LEVELS}Q{LEVELS}Q", MAGIC, self.n, *self.zeros, *map(len, body))
        return head + b"".join(body)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        import zstandard

        layout = f"<6sQ{LEVELS}Q{LEVELS}Q"
        magic, n, *rest = struct.unpack_from(layout, data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        at, planes, samples = struct.calcsize(layout), [], []
        width = (n + 7) // 8
        for size in rest[LEVELS:]:
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at : at + size]), np.uint8)
            planes.append(raw[len(raw) - width :])
            samples.append(raw[: len(raw) - width].view(np.uint32))
            at += size
        return cls(n, list(rest[:LEVELS]), planes, samples)

    def _rank1(self, level: int, i: int) -> int:
        start = i // RANK_STEP
        packed = self.planes[level][start * RANK_STEP // 8 : (i + 7) // 8]
        bits = np.unpackbits(packed)[: i - start * RANK_STEP]
        return int(self.samples[level][start]) + int(bits.sum())

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def access(self, i: int) -> int:
        value = 0
        for k in range(LEVELS):
            bit, ones = self._bit(k, i), self._rank1(k, i)
            value = value << 1 | bit
            i = self.zeros[k] + ones if bit else i - ones
        return value

    def _narrow(self, symbol: int, i: int) -> tuple[int, int]:
        low = 0
        for k in range(LEVELS):
            a, b = self._rank1(k, low), self._rank1(k, i)
            low, i = (self.zeros[k] + a, self.zeros[k] + b) if symbol >> (LEVELS - 1 - k) & 1 else (low - a, i - b)
        return low, i

    def rank(self, symbol: int, i: int) -> int:
        """How often the symbol stands before position i."""
        low, high = self._narrow(symbol, i)
        return high - low

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit."""
        ones = self.samples[level].astype(np.int64)
        held = ones if bit else np.arange(len(ones)) * RANK_STEP - ones
        block = int(np.searchsorted(held, k, "right")) - 1
        packed = self.planes[level][block * RANK_STEP // 8 : (block + 1) * RANK_STEP // 8]
        return block * RANK_STEP + int(np.flatnonzero(np.unpackbits(packed) == bit)[k - int(held[block])])

    def select(self, symbol: int, k: int) -> int:
        """Position of the symbol's k-th occurrence, from 0."""
        low, high = self._narrow(symbol, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i = low + k
        for level in range(LEVELS - 1, -1, -1):
            bit = symbol >> (LEVELS - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]

    def decode(self) -> np.ndarray:
        """The whole sequence: undo the partitions from the lowest bit up."""
        seq = np.zeros(self.n, np.uint16)
        for k in range(LEVELS - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n).astype(bool)
            back = np.empty(self.n, np.uint16)
            back[~bit] = seq[: self.zeros[k]]
            back[bit] = seq[self.zeros[k] :] | np.uint16(1 << (LEVELS - 1 - k))
            seq = back
        return seq


def lowered(joined: str, offsets: np.ndarray, normalise) -> tuple[str, np.ndarray]:
    """The file's normaliser over every row; below U+0300 it is just lower case."""
    if joined.isascii() or (max(joined) < "̀" and "İ" not in joined):
        return joined.lower(), offsets
    cut = offsets.tolist()
    texts = [joined[a:b] for a, b in zip(cut, cut[1:])]
    texts = [t.lower() if t.isascii() else normalise(t) for t in texts]
    return "".join(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _encoder(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, _vec.PieceCoder(_vec.model_ids(tokenizer))


_HELD: dict[str, tuple] = {}


def held(path: str, make=_encoder) -> tuple:
    """One tokenizer and one memory of pieces a worker, kept over its tasks."""
    if path not in _HELD:
        _HELD[path] = make(path)
    return _HELD[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, coder = held(path)
        part, block = TaskContext.get().partitionId(), 0
        docs, sizes, parts, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            row = [[part], [block], [total], [np.concatenate(docs).tobytes()], [np.concatenate(sizes).astype("<i8").tobytes()],
                   [WaveletMatrix.build(ids).to_bytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 3))],
                                              ["part", "block", "n_tokens", "doc_ids", "lengths", "matrix"])

        for batch in batches:
            doc_ids = batch.column(0)
            for i, j, buf, offsets in _vec.slices(batch.column(1)):
                text, text_at = _vec.decoded(buf, offsets)
                joined, at = lowered(text, text_at, tokenizer.normalizer.normalize_str)
                cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
                start, end = _vec.word_level_spans(cp, at)
                ids, each = coder(cp, start, end, joined)
                ends = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(start, at[1:])]
                ids, ends = _vec.with_added(tokenizer, text, text_at, ids, ends)
                ids = np.insert(ids, ends, END_ID)
                docs.append(np.array(doc_ids[i:j].fill_null(np.iinfo(np.int64).min), dtype="<i8"))
                sizes.append(np.diff(ends, prepend=0) + 1)
                parts.append(ids)
                total += len(ids)
                if total >= BLOCK_TOKENS:
                    yield flush()
                    docs, sizes, parts, total, block = [], [], [], 0, block + 1
        if docs:
            yield flush()

    return run


def write_shards(df: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every document and write the shard files, in ascending order of id."""
    rows = id_text(df, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_encode(tokenizer_path), SHARD).write.parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = WaveletMatrix.from_bytes(row["matrix"]).decode().astype("<u4")
            docs, sizes = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["lengths"], "<i8")
            ends = np.cumsum(sizes)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
            n = len(docs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()),
                 pa.array(docs, pa.int64(), mask=docs == np.iinfo(np.int64).min), pa.array(ends - sizes, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shard files."""
    shards = spark.read.schema(SHARD).parquet(path)
    blocks = shards.select("part", "block", "n_tokens")
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row a partition of the writing job
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    in_part = Window.partitionBy("part").orderBy("block")
    base = (blocks.withColumn("seen", F.sum("n_tokens").over(in_part) - F.col("n_tokens")).join(parts, "part")
            .select("part", "block", (F.col("seen") + F.col("before")).alias("base")))
    rows = shards.mapInArrow(_digests, "part int, block int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return (rows.join(base, ["part", "block"])
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"))


def encoded_digests(df: DataFrame, tokenizer_path: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/larkspar/shards-{uuid.uuid4().hex}"
    write_shards(df, tokenizer_path, path)
    return read_digests(spark, path)
