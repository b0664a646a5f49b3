"""Substring dedup: every window of words looked up in an index of the whole corpus.

A document's duplicate spans are the words covered by a window of WINDOW consecutive words whose sequence
also starts earlier (in a smaller id, or earlier in the same document). No document is parsed into factors:
a hash of each window is looked up instead of a greedy relative Lempel-Ziv parse. Greedy factors need not
start or end where windows do, so windows that straddle factors would have to be looked up anyway to cover
exactly these words. The index is dealt out by hash, so no task needs the reference's text.

The index stays small because only what can repeat enters it. Each window is represented by its least
gram of GRAM words (equal windows have equal least grams); grams that occur once in the corpus are dropped,
the others fill a Bloom filter of bounded size, and only windows whose gram it holds are indexed. A false
positive costs an entry and changes nothing. Exact copies are settled by text hash beforehand.

Defined results: a null text has no words; fewer words than a window are never removed; rows that share an
id do not remove each other's words; null ids come first; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _vec
from ._common import hot_salted, id_text, with_first, written

WINDOW = 20
GRAM = 10
MAX_FILTER_BITS = 1 << 28  # 32 MB
PAGE_BITS = 32_768
FLUSH = 400_000
OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _windows(buf: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Word bounds and rows; window hashes, their first words and their least grams."""
    start, end, rows = _vec.word_bounds(buf, offsets)
    h = _vec.span_hashes(buf, start, end)
    hashes, first = _vec.window_hashes(h, rows, window)
    if not len(first):
        return start, end, rows, hashes, first, hashes
    grams, _ = _vec.window_hashes(h, np.zeros(len(h), np.int8), gram)
    least = grams[: len(grams) - (window - gram)].copy()
    for k in range(1, window - gram + 1):
        np.minimum(least, grams[k : k + len(least)], out=least)
    return start, end, rows, hashes, first, least[first]


def _grams(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int32))], ["gram", "n"])

        for batch in batches:
            for _, _, buf, offsets in _vec.slices(batch.column(1)):
                *_, rows, _, first, least = _windows(buf, offsets, window, gram)
                if not len(first):
                    continue
                owner = rows[first]
                new = np.ones(len(first), bool)  # neighbours that share their least gram are one occurrence,
                new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
                at = np.arange(len(first))  # which reaches over so many windows at most
                new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % (window - gram + 1) == 0
                held.append(least[new])
                total += len(held[-1])
                if total >= FLUSH:
                    yield flush()
                    held, total = [], 0
        if held:
            yield flush()

    return run


def _filter(grams: DataFrame) -> np.ndarray:
    """Bloom filter, as bits in bytes, of the grams that occur more than once."""
    repeated = written(grams.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"))
    count, bits = repeated.count(), PAGE_BITS
    while bits < 16 * count and bits < MAX_FILTER_BITS:
        bits *= 2
    low = F.lit(bits - 1)  # bitmap functions count bits from 1
    places = F.array(F.col("gram").bitwiseAND(low) + 1, F.shiftrightunsigned("gram", 36).bitwiseAND(low) + 1)
    pages = (repeated.select(F.explode(places).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("page"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap")))
    out = np.zeros(bits // 8, np.uint8)
    for row in pages.toLocalIterator():  # MAX_FILTER_BITS / 8 bytes at most
        at = (row["page"] - 1) * PAGE_BITS // 8
        out[at : at + len(row["bitmap"])] = np.frombuffer(row["bitmap"], np.uint8)
    return out


def _maybe(filled: np.ndarray, grams: np.ndarray) -> np.ndarray:
    low = np.uint64(len(filled) * 8 - 1)
    found = np.ones(len(grams), bool)
    for place in (grams & low, (grams >> np.uint64(36)) & low):
        found &= (filled[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)
    return found


def _indexed(filled, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filled.value
        for batch in batches:
            ids = np.array(batch.column(0).fill_null(np.iinfo(np.int64).min))
            for i, _, buf, offsets in _vec.slices(batch.column(1)):
                *_, rows, hashes, first, least = _windows(buf, offsets, window, gram)
                hit = _maybe(bits, least)
                hashes, owner = hashes[hit], rows[first[hit]]
                if len(hashes):
                    _, once = np.unique(_vec.mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
                    once.sort()
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[once].view(np.int64)), pa.array(ids[i + owner[once]])], ["hash", "doc_id"])

    return run


def covered(n: int, first: np.ndarray, window: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of `first`."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, np.minimum(first + window, n), -1)
    return np.cumsum(depth[:-1]) > 0


def _settled(text: str, copy: bool, window: int) -> tuple[int, int, str]:
    words = text.encode().split()
    gone = copy and len(words) >= window
    return len(words), len(words) if gone else 0, hashlib.sha256(b"" if gone else b" ".join(words)).hexdigest()


def _first_pass(filled, window: int, gram: int):
    """Rows without a window that may repeat are done; the others go on with their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filled.value
        for batch in batches:
            copies = batch.column(2).to_pylist()
            for i, j, buf, offsets in _vec.slices(batch.column(1)):
                *_, rows, hashes, first, least = _windows(buf, offsets, window, gram)
                busy = np.zeros(j - i, bool)
                owner = rows[first]
                busy[owner[_maybe(bits, least)]] = True
                for d in range(1, min(window - gram + 1, len(first))):  # repeats so near that they share a least gram
                    busy[owner[d:][(hashes[d:] == hashes[:-d]) & (owner[d:] == owner[:-d])]] = True
                texts = batch.column(1)[i:j].to_pylist()
                done = [None if b and not c else _settled(t, c, window) for t, c, b in zip(texts, copies[i:j], busy.tolist())]
                pick = lambda k: [None if d is None else d[k] for d in done]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array([t if d is None else None for t, d in zip(texts, done)], pa.string()),
                     pa.array(pick(0), pa.int64()), pa.array(pick(1), pa.int64()), pa.array(pick(2), pa.string())],
                    ["doc_id", "text", "n_words", "n_removed", "kept_sha256"])

    return run


def _second_pass(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, known in zip(batch.column("text").to_pylist(), batch.column("hashes").to_pylist()):
                buf = np.frombuffer(text.encode(), np.uint8)
                start, end, rows = _vec.word_bounds(buf, np.array([0, len(buf)]))
                hashes, first = _vec.window_hashes(_vec.span_hashes(buf, start, end), rows, window)
                again = np.ones(len(hashes), bool)
                again[np.unique(hashes, return_index=True)[1]] = False  # not the first of its kind in this document
                if known:
                    again |= np.isin(hashes.view(np.int64), np.array(known, np.int64))
                gone = covered(len(start), first[again], window)
                words = text.encode().split()
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                out.append((len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            n, removed, digest = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def duplicate_words(df: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    spark = df.sparkSession
    rows = with_first(id_text(df, id_col, text_col)).select("doc_id", "text", (~F.col("doc_id").eqNullSafe(F.col("first"))).alias("copy"))
    own = rows.where("not copy").select("doc_id", "text")
    filled = spark.sparkContext.broadcast(_filter(own.mapInArrow(_grams(window, gram), "gram long, n int")))
    index = own.mapInArrow(_indexed(filled, window, gram), "hash long, doc_id long")
    firsts = written(index.groupBy("hash").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    left, right = hot_salted(index, firsts, "hash", "n", "doc_id")
    later = left.join(right, ["hash", "_lk_salt"]).where("doc_id > least")
    known = later.groupBy("doc_id").agg(F.collect_list("hash").alias("hashes"))  # at most a document's own windows
    passed = rows.mapInArrow(_first_pass(filled, window, gram), "doc_id long, text string, n_words long, n_removed long, kept_sha256 string")
    done = passed.where("text is null").drop("text")
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    open_ = passed.where("text is not null").select("doc_id", "text", key.alias("key"))
    rest = open_.join(known.withColumnRenamed("doc_id", "key"), "key", "left").select("doc_id", "text", "hashes").mapInArrow(_second_pass(window), OUT)
    return done.unionByName(rest)
