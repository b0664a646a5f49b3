"""Packing documents into sequences by cutting-stock column generation.

Every document's ids (with the end id) are cut into whole sequences and one remainder. The remainders
are a cutting-stock problem over their length histogram, in steps of GRAIN ids (with a step of 1 the
program has a thousand rows and its duals need minutes to settle; a step of 8 takes seconds and wastes
about 0.7 % of the sequences that hold remainders): a linear program over patterns, whose columns a
knapsack dynamic program prices until no pattern improves it by more than GAP. Patterns are rounded
down; what is left is packed first-fit-decreasing into further patterns. A pattern's slots are then dealt
to the documents ranked within their length, so the plan is a table of patterns whose size depends on the
sequence length and not on the number of documents.

Only the histogram (at most SEQUENCE counts) reaches the driver. Ranks come from counts per partition and
length, so a length that a third of all documents share is ranked by all tasks, not by one.

Defined results: a null text is empty and is just the end id; rows that share an id are separate
documents; null ids are kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _vec
from ._common import id_text, written
from .wavelet import held

SEQUENCE = 1024
END_ID = 0
GRAIN = 8
GAP = 0.001
MOST_PIVOTS = 50_000  # stops a cycling program; its plan is valid at any pivot, only looser
BROADCAST_ROWS = 400_000
IDS = "part int, doc_id long, n long, r int, rank long, whole_at long, ids binary"
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long"


def _encoder(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, _vec.PieceCoder(_vec.model_ids(tokenizer))


def _tokens(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, coder = held(path + "#pack", lambda _: _encoder(path))
        part, ranks, whole = TaskContext.get().partitionId(), np.zeros(size // GRAIN + 1, np.int64), 0
        for batch in batches:
            for i, j, buf, offsets in _vec.slices(batch.column(1)):
                joined, at = _vec.decoded(buf, offsets)
                cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
                starts = _vec.byte_level_starts(cp, at)
                ids, each = coder(cp, starts, np.append(starts[1:], len(cp)), joined)
                ends = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(starts, at[1:])]
                ids, ends = _vec.with_added(tokenizer, joined, at, ids, ends)
                raw = np.insert(ids, ends, END_ID).astype("<u2").tobytes()
                n = np.diff(ends, prepend=0) + 1
                ends = np.cumsum(n)
                r, rank, base = -(-(n % size) // GRAIN), [], []
                for length, full in zip(r.tolist(), (n // size).tolist()):
                    rank.append(int(ranks[length]))
                    ranks[length] += 1
                    base.append(whole)
                    whole += full
                blobs = [raw[2 * a : 2 * b] for a, b in zip((ends - n).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), batch.column(0)[i:j], pa.array(n, pa.int64()), pa.array(r, pa.int32()),
                     pa.array(rank, pa.int64()), pa.array(base, pa.int64()), pa.array(blobs, pa.binary())],
                    ["part", "doc_id", "n", "r", "rank", "whole_at", "ids"])

    return run


def knapsack(value: np.ndarray, lengths: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest value that fits: how often each length is taken."""
    item = np.zeros(size + 1)
    which = np.full(size + 1, -1)
    item[lengths], which[lengths] = value, np.arange(len(lengths))
    best, take = np.zeros(size + 1), np.zeros(size + 1, np.int64)
    for c in range(1, size + 1):
        gain = item[1 : c + 1] + best[c - 1 :: -1] if c > 1 else item[1:2] + best[:1]
        k = int(gain.argmax())
        if gain[k] > best[c - 1] + 1e-12 and which[k + 1] >= 0:
            best[c], take[c] = gain[k], k + 1
        else:
            best[c] = best[c - 1]
    pattern, c = np.zeros(len(lengths), np.int64), size
    while c > 0:
        if take[c]:
            pattern[which[take[c]]] += 1
            c -= take[c]
        else:
            c -= 1
    return float(best[size]), pattern


def column_generation(lengths: np.ndarray, demand: np.ndarray, size: int = SEQUENCE // GRAIN, gap: float = GAP) -> list[tuple[float, np.ndarray]]:
    """Patterns and how often to use each, from the linear program (revised simplex, priced by knapsack)."""
    m = len(lengths)
    columns = np.diag(size // lengths).astype(float)
    inverse = np.diag(1.0 / (size // lengths))
    x = inverse @ demand
    for _ in range(MOST_PIVOTS):
        duals = inverse.sum(0)
        value, pattern = knapsack(duals, lengths, size)
        if value <= 1 + gap:  # the program's optimum is at least the present one divided by this value
            break
        d = inverse @ pattern
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        k = int(ratio.argmin())
        step = ratio[k]
        x -= step * d
        x[k] = step
        np.maximum(x, 0, out=x)
        columns[:, k] = pattern
        row = inverse[k] / d[k]
        inverse -= np.outer(d, row)
        inverse[k] = row
    return [(float(x[k]), columns[:, k].astype(np.int64)) for k in range(m) if x[k] > 1e-9]


def plan(histogram: dict[int, int], size: int = SEQUENCE // GRAIN, gap: float = GAP) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: how many}) patterns that hold exactly the histogram's pieces."""
    lengths = np.array(sorted(k for k, v in histogram.items() if k > 0 and v > 0), np.int64)
    if not len(lengths):
        return []
    left = np.array([histogram[int(k)] for k in lengths], np.int64)
    out = []
    for times, pattern in sorted(column_generation(lengths, left.astype(float), size, gap), key=lambda t: -t[0]):
        used = pattern > 0
        whole = min(int(times + 1e-6), int((left[used] // pattern[used]).min()) if used.any() else 0)
        if whole > 0:
            left -= whole * pattern
            out.append((whole, {int(k): int(a) for k, a in zip(lengths[used], pattern[used])}))
    # what rounding leaves: first fit decreasing; equal bins become one pattern
    free, bins = np.zeros(0, np.int64), []
    for length, count in sorted(zip(lengths.tolist(), left.tolist()), reverse=True):
        for _ in range(count):
            fit = np.flatnonzero(free >= length)
            if len(fit):
                k = int(fit[0])
            else:
                k, free = len(bins), np.append(free, size)
                bins.append({})
            free[k] -= length
            bins[k][length] = bins[k].get(length, 0) + 1
    return out + [(1, b) for b in bins]


def slots(patterns: list[tuple[int, dict[int, int]]]) -> tuple[int, dict[int, tuple[np.ndarray, ...]]]:
    """By length: cumulative slots, and for each entry its first sequence, items a sequence and offset."""
    base, by = 0, {}
    for times, pattern in patterns:
        at = 0
        for length in sorted(pattern, reverse=True):
            by.setdefault(length, []).append((times * pattern[length], base, pattern[length], at))
            at += length * pattern[length]
        base += times
    return base, {k: (np.cumsum([e[0] for e in v]), *(np.array([e[i] for e in v]) for i in (1, 2, 3))) for k, v in by.items()}


def _pieces(shared, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_whole, by = shared.value
        for batch in batches:
            rows, cols = [], batch.to_pydict()
            for doc, n, r, rank, before, whole, ids in zip(*(cols[c] for c in ("doc_id", "n", "r", "rank", "before", "whole", "ids"))):
                wide = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                for k in range(n // size):
                    rows.append((doc, k * size, size, zlib.crc32(wide[4 * k * size : 4 * (k + 1) * size]), n, first_whole + whole + k, 0))
                if n % size:
                    ends, sequence, items, offset = by[r]
                    slot = rank + before
                    e = int(np.searchsorted(ends, slot, "right"))
                    own = slot - (int(ends[e - 1]) if e else 0)
                    rest = n % size
                    rows.append((doc, n - rest, rest, zlib.crc32(wide[4 * (n - rest) :]), n, int(sequence[e]) + own // int(items[e]),
                                 int(offset[e]) + own % int(items[e]) * r))
            names = [x.split()[0] for x in PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 7)], names)

    return run


def pack(df: DataFrame, tokenizer_path: str, size: int = SEQUENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = df.sparkSession
    ids = written(id_text(df, id_col, text_col).mapInArrow(_tokens(tokenizer_path, size), IDS))
    counts = ids.groupBy("part", "r").agg(F.count(F.lit(1)).alias("n"))
    histogram = {row["r"]: row["n"] for row in counts.groupBy("r").agg(F.sum("n").alias("n")).collect()}  # size / GRAIN rows at most
    first_whole, by = slots(plan(histogram, size // GRAIN))
    running = Window.partitionBy("r").orderBy("part")
    before = counts.select("part", "r", (F.sum("n").over(running) - F.col("n")).alias("before"))
    parts = ids.groupBy("part").agg(F.sum(F.floor(F.col("n") / size)).alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("whole_before"))  # a row a partition
    before = written(before.join(parts, "part"))
    small = before.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = ids.join(F.broadcast(before) if small else before, ["part", "r"])
    rows = rows.select("doc_id", "n", "r", "rank", "before", (F.col("whole_at") + F.col("whole_before")).alias("whole"), "ids")
    pieces = rows.mapInArrow(_pieces(spark.sparkContext.broadcast((first_whole, by)), size), PIECE)
    # a sequence has at most `size` pieces
    within = Window.partitionBy("sequence_id").orderBy("slot")
    return pieces.select(*pieces.columns[:-1], (F.sum("length").over(within) - F.col("length")).alias("offset"))
