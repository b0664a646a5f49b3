"""Document fingerprints by content-defined chunking.

A gear hash rolls over the bytes; a chunk ends where the hash's masked bits are zero, with a stricter
mask before the normal size and a looser one after it (normalised chunking), within a least and a
greatest size. A boundary depends on the last bytes only, so an insertion shifts no chunk but those it
touches. A fingerprint is the sorted set of chunk digests, each with the bytes it stands for; likeness
is the shared weight over the larger text's weight, containment the shared weight over one's own.

`edited_report` needs each document's successor by id. Ids are dealt to ranges with explicit bounds and
each range also gets a copy of the row that follows its last one, so no range waits for another and
nothing passes through a single task.

Defined results: a null text is empty; the empty text has the fingerprint ""; two empty texts are alike
(1.0), an empty and a non-empty one are not (0.0); ids that repeat are ordered by their texts; null ids
come first; a table of one row is its own successor; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _vec
from ._common import id_text

LEAST, NORMAL, GREATEST = 12, 40, 160
STRICT, LOOSE = 6, 4  # zero bits asked for before and after the normal size
WINDOW = 32
OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _gear_table() -> np.ndarray:
    return (_vec.mix(np.arange(256, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear_table()  # zero for a zero byte
PAD = bytes(WINDOW)


def gear(buf: np.ndarray) -> np.ndarray:
    """The 32-bit gear hash after every byte, by doubling."""
    h = GEAR[buf]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width].copy() << np.uint32(width)
        width *= 2
    return h


def cuts(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Chunk ends of every text buf[start:end]."""
    if not len(buf):
        return [[] for _ in starts]
    top = gear(buf) >> np.uint32(32 - STRICT)
    loose = (np.flatnonzero(top >> np.uint32(STRICT - LOOSE) == 0) + 1).tolist()
    strict = (np.flatnonzero(top == 0) + 1).tolist()
    n_loose, n_strict, out = len(loose), len(strict), []
    for a, b in zip(starts.tolist(), ends.tolist()):
        at, found = a, []
        while b - at > LEAST:
            low = at + LEAST
            normal, most = at + NORMAL, min(at + GREATEST, b)
            i = bisect_right(strict, low - 1)
            cut = strict[i] if i < n_strict and strict[i] < min(normal, b) else 0
            if not cut:
                i = bisect_right(loose, max(normal, low) - 1)
                cut = loose[i] if i < n_loose and loose[i] < most else most
            found.append(cut)
            at = cut
        if at < b:
            found.append(b)
        out.append(found)
    return out


def chunk_sets(texts: list[str]) -> list[dict[int, int]]:
    """For every text the weight in bytes of each chunk digest; a repeated chunk counts once."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    size = np.array([len(r) for r in raw], np.int64)
    ends = np.cumsum(size + WINDOW)  # zero bytes before each text: they add nothing to its hashes
    starts = ends - size
    buf = np.frombuffer(b"".join([PAD + r for r in raw]), np.uint8)
    found = cuts(buf, starts, ends)
    high = np.fromiter((c for cs in found for c in cs), np.int64)
    low = np.fromiter((x for a, cs in zip(starts.tolist(), found) for x in ([a] + cs[:-1] if cs else [])), np.int64)
    digest = (_vec.span_hashes(buf, low, high) >> np.uint64(24)).tolist() if len(high) else []
    size = (high - low).tolist()
    out, at = [], 0
    for cs in found:
        out.append(dict(zip(digest[at : at + len(cs)], size[at : at + len(cs)])))
        at += len(cs)
    return out


def render(chunks: dict[int, int]) -> str:
    return " ".join(["%010x:%d" % c for c in sorted(chunks.items())])


def parse(fingerprint: str) -> dict[int, int]:
    return {int(a, 16): int(b) for a, _, b in (x.partition(":") for x in fingerprint.split())}


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """The share of a's weight that b holds too."""
    total = sum(a.values())
    return sum([a[k] for k in a.keys() & b.keys()]) / total if total else float(not b)


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """Containment of the lighter in the heavier, scaled to the heavier's weight: 1 only for equal sets."""
    heavy = max(sum(a.values()), sum(b.values()))
    return sum([a[k] for k in a.keys() & b.keys()]) / heavy if heavy else 1.0


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, weight (bytes in distinct chunks)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, _, _ in _vec.slices(batch.column(1)):
                sets = chunk_sets(batch.column(1)[i:j].to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(map(render, sets), pa.string()),
                                                  pa.array([sum(s.values()) for s in sets], pa.int64())], ["doc_id", "fingerprint", "weight"])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string, weight long")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by (range, id, text); `ahead` marks the copy of the row that follows the range."""
    names = [x.split()[0] for x in OUT.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    previous = None  # (range, id, text, its chunks), still without its successor

    def emit(pairs):
        edited = [t[: len(t) - len(t) // 4] + after[: len(t) // 4] for (_, t, _), (after, _) in pairs]
        sets = chunk_sets(edited)
        rows = [(i, len(t), hashlib.sha256(e.encode("utf-8", "replace")).hexdigest(), render(own), render(s), likeness(own, s), likeness(own, follower))
                for ((i, t, own), (_, follower)), e, s in zip(pairs, edited, sets)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], names)

    for batch in batches:
        for i, j, _, _ in _vec.slices(batch.column("text"), 2 << 20):
            part = batch.slice(i, j - i).to_pydict()
            sets = chunk_sets(part["text"])
            pairs = []
            for rng, doc, text, ahead, own in zip(part["rng"], part["doc_id"], part["text"], part["ahead"], sets):
                if previous and previous[0] == rng:
                    pairs.append((previous[1:], (text, own)))
                previous = None if ahead else (rng, doc, text, own)
            if pairs:
                yield emit(pairs)


def edited_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row."""
    spark = df.sparkSession
    rows = id_text(df, id_col, text_col)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the bounds: as many as there are partitions, whatever the input
    bounds = sorted(set(rows.approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (4 * n)))) if n > 1 else []
    rng = F.when(F.col("doc_id").isNull(), 0).otherwise(
        F.coalesce(F.size(F.filter(F.array(*[F.lit(int(b)) for b in bounds]), lambda b: b <= F.col("doc_id"))), F.lit(0)) if bounds else F.lit(0))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    heads = (rows.select(rng.alias("rng"), key.alias("key")).groupBy("rng").agg(F.min("key").alias("key")).collect())
    if not heads:
        return spark.createDataFrame([], OUT)
    heads = sorted(tuple(h) for h in heads)
    before = [(heads[i - 1][0], heads[i][1]) for i in range(len(heads))]  # the first follows the last
    wanted = F.broadcast(spark.createDataFrame(before, "rng int, key long"))  # one row a range
    first = rows.withColumn("key", key).join(wanted, "key").groupBy("rng", "doc_id").agg(F.min("text").alias("text"))
    every = (rows.select(rng.alias("rng"), "doc_id", "text", F.lit(False).alias("ahead"))
             .unionByName(first.select("rng", "doc_id", "text", F.lit(True).alias("ahead"))))
    dealt = every.repartition(n, "rng").sortWithinPartitions("rng", "ahead", "doc_id", "text")
    return dealt.select("rng", "doc_id", "text", "ahead").mapInArrow(_edited, OUT)
