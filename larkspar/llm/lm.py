"""Language-model scoring with an Elias-Fano n-gram trie.

The model is an interpolated absolute-discount bigram over a discounted unigram whose left-over mass belongs to
the unknown word; every pair seen enters it (`least_pairs` may ask for more). The trie is keyed by the predicted
word, then its context. Its levels are Elias-Fano sequences laid out one after the other and queried in place, in
the buffer a task is handed or in a mapped file (`Trie` takes either): the sorted word hashes; the running sum of
their counts; monotone pointers into level two; and there, made monotone over all words by the word's rank, the
32-bit hashes of the contexts. Smoothed log-probabilities and back-off weights stay one-byte codes with a codebook.
A query finds the word by successor search and then its context by successor search within the word's own segment.

With b(v) the back-off weight of context v, a seen pair stores log p(w|v) - b(v) and an unseen one costs log p(w), so
a text's score is the sum over its tokens w after v of one term that needs w's shard only, plus b(w), which is there
too (each text's end stands for the start of the text, its first context). So shards, dealt by the hash of the word,
are scored apart, and each once, whatever the model's size: a task sends the (word, context, row) queries of its texts
to the shards that hold the words, each shard answers with a sum a row, and a text's sums are added up. No machine
holds more than one shard, and nothing of the model is broadcast or collected. Words that a task sees oftener than
one time in HOT_SHARE are dealt by word and context, so that no shard holds all contexts of a common word;
only their totals (HOT_SHARE words at most) go to every task.

Defined results: a null text is empty and scores its end token; rows that share an id are scored each; null
ids hash as the empty text; with no training rows every word is unknown and scores 0; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _vec, elias_fano
from ._common import id_text, written

SHARD_BYTES = 12 << 20  # of text
FLUSH = 1_000_000
HOT_SHARE = 1_000
DEALING = 16
HOT_LEAST = 200_000  # a word seen less often is not hot: its contexts are no load
HELD_OUT = (7, 2)
_U = np.uint64
END = _U(0xA5B35705F00DFACE)
PACKED = "shard int, word binary, runs binary, context binary, n binary"
MERGED = "shard int, tokens long, words long, w1 long, w2 long, p1 long, p2 long, word binary, count binary, at binary, context binary, pairs binary"
QUERIES = "shard int, part int, block int, word binary, runs binary, context binary, uses binary, row binary, n binary, docs binary"
ANSWERS = "shard int, part int, block int, row binary, known binary, base binary, score binary, docs binary"
OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _zip(a: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unzip(b: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, each ended by END, and the first token of each row."""
    buf = _LOWER[buf]
    start, end, rows = _vec.word_bounds(buf, offsets)
    h = _vec.span_hashes(buf, start, end)
    n = len(offsets) - 1
    last = _vec.row_spans(rows, n)[1:]
    first = np.concatenate([[0], last[:-1] + np.arange(1, n)]) if n else np.zeros(0, np.int64)
    return np.insert(h, last, END), first


def _contexts(h: np.ndarray) -> np.ndarray:
    """A text's first word follows an end. Contexts are known by the high 32 bits of their hash."""
    return np.concatenate([[END], h[:-1]]).astype(_U) >> _U(32)


def _common_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the words that are at least one in 4 * HOT_SHARE of a slice's tokens."""
    for batch in batches:
        for _, _, buf, offsets in _vec.slices(batch.column(1)):
            h, _ = tokens(buf, offsets)
            word, n = np.unique(h, return_counts=True)
            many = n * 4 * HOT_SHARE >= len(h)
            yield pa.RecordBatch.from_arrays([pa.array(word[many].view(np.int64)), pa.array(n[many])], ["word", "n"])


def _shards(word: np.ndarray, context: np.ndarray, bits: int, hot: np.ndarray) -> np.ndarray:
    """By the word; a hot word's contexts by word and context."""
    out = word >> _U(64 - bits)
    if len(hot):
        at = np.flatnonzero(hot[np.minimum(np.searchsorted(hot, word), len(hot) - 1)] == word)
        out[at] = _vec.mix(word[at] ^ _vec.mix(context[at])) >> _U(64 - bits)
    return out.astype(np.int64)


def _lots(words: np.ndarray, contexts: np.ndarray, bits: int, hot: np.ndarray):
    """The distinct pairs in order of (shard, word, context): shard, word, context, and each token's pair."""
    shard = _shards(words, contexts, bits, hot)
    word, index = np.unique(words, return_inverse=True)
    key = index.astype(_U) << _U(32) | contexts
    pair, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    order = np.argsort(shard[first], kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    pair = pair[order]
    return shard[first][order], word[(pair >> _U(32)).astype(np.int64)], pair.astype(np.uint32), place[inverse]


def _runs(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words that follow each other, once, and how often each."""
    new = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    return word[new], np.diff(np.append(new, len(word))).astype(np.uint32)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _pack(bits: int, hot: np.ndarray):
    """The pairs of training texts and their counts, a block a shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flush():
            words, contexts = (np.concatenate(x) for x in zip(*held))
            shard, word, context, place = _lots(words, contexts, bits, hot)
            n = np.bincount(place).astype(np.uint32)
            cut = np.searchsorted(shard, np.arange((1 << bits) + 1)).tolist()
            rows = []
            for s, (a, b) in enumerate(zip(cut, cut[1:])):
                if b > a:
                    distinct, runs = _runs(word[a:b])
                    rows.append((s, _zip(distinct), _zip(runs), context[a:b].tobytes(), _zip(n[a:b])))
            return _batch(rows, PACKED)

        for batch in batches:
            for _, _, buf, offsets in _vec.slices(batch.column(1)):
                h, _ = tokens(buf, offsets)
                held.append((h, _contexts(h)))
                total += len(h)
                if total >= FLUSH:
                    yield flush()
                    held, total = [], 0
        if held:
            yield flush()

    return run


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """A shard's words and counts, its pairs and theirs."""
    own = [(_unzip(w, _U), _unzip(r, np.uint32), np.frombuffer(c, np.uint32), _unzip(n, np.uint32))
           for w, r, c, n in zip(group["word"], group["runs"], group["context"], group["n"])]
    word = np.unique(np.concatenate([o[0] for o in own]))
    key = np.concatenate([np.repeat(np.searchsorted(word, w).astype(_U), r) << _U(32) | c.astype(_U) for w, r, c, _ in own])
    n = np.concatenate([o[3] for o in own]).astype(np.int64)
    del own
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    key, n = key[new], np.add.reduceat(n, new)
    count = np.bincount((key >> _U(32)).astype(np.int64), n, len(word)).astype(np.int64)
    return pd.DataFrame([{"shard": group["shard"].iloc[0], "tokens": int(count.sum()), "words": len(word), "w1": int((count == 1).sum()),
                          "w2": int((count == 2).sum()), "p1": int((n == 1).sum()), "p2": int((n == 2).sum()), "word": word.tobytes(),
                          "count": _zip(count), "at": _zip((key >> _U(32)).astype(np.int32)),
                          "context": key.astype(np.uint32).tobytes(), "pairs": _zip(n)}])


def _discount(one: int, two: int) -> float:
    return one / (one + 2 * two) if one else 0.5


REQUEST = "lot int, shard int, v binary, n binary, kinds binary, gone binary"
REPLY = "shard int, lot int, v binary, cv binary, b binary"


def _requests(bits: int, least: int):
    """A shard's distinct contexts, its own words among them, with its part of their counts: a block a range of contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, word, context, n in zip(*(batch.column(c).to_pylist() for c in ("shard", "word", "context", "pairs"))):
                n = _unzip(n, np.int64)
                own = (np.frombuffer(word, _U) >> _U(32)).astype(np.uint32)
                v, at = np.unique(np.concatenate([np.frombuffer(context, np.uint32), own]), return_inverse=True)
                sums = [np.bincount(at[: len(n)], x, len(v)).astype(np.int64) for x in (n, n >= least, np.where(n < least, n, 0))]
                cut = np.searchsorted(v, np.arange((1 << bits) + 1, dtype=_U) << _U(32 - bits)).tolist()
                yield _batch([(lot, shard, _zip(v[a:b]), *(_zip(x[a:b]) for x in sums)) for lot, (a, b) in enumerate(zip(cut, cut[1:])) if b > a], REQUEST)

    return run


def _replies(discount: float):
    """The totals and back-off weights (log10) of a range of contexts, to each shard that asked."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        asked = [_unzip(x, np.uint32) for x in group["v"]]
        v, at = np.unique(np.concatenate(asked), return_inverse=True)
        cv, kinds, gone = (np.bincount(at, np.concatenate([_unzip(x, np.int64) for x in group[c]]), len(v)) for c in ("n", "kinds", "gone"))
        # what kept pairs do not hold backs off; a word that is never a context leaves all to the unigram
        b = np.log10(np.where(cv > 0, np.maximum(1e-6, (kinds * discount + gone) / np.maximum(cv, 1)), 1.0)).astype(np.float32)
        cv, out, low = cv.astype(np.int64), [], 0
        for shard, lot, x, own in zip(group["shard"], group["lot"], group["v"], asked):
            here = at[low : low + len(own)]
            out.append((shard, lot, x, _zip(cv[here]), _zip(b[here])))
            low += len(own)
        return pd.DataFrame(out, columns=[f.split()[0] for f in REPLY.split(", ")])

    return run


def _weights(hot: np.ndarray):
    """(v, b) of the hot words among the replies."""
    wanted = np.unique(hot >> _U(32)).astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v, b in zip(batch.column("v").to_pylist(), batch.column("b").to_pylist()):
                v, _, at = np.intersect1d(wanted, _unzip(v, np.uint32), assume_unique=True, return_indices=True)
                yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)), pa.array(_unzip(b, np.float32)[at].astype(float))], ["v", "b"])

    return run


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte a value, and the codebook: the means of 256 equal shares of the sorted values."""
    if not len(x):
        return np.zeros(0, np.uint8), np.zeros(256, np.float32)
    edges = np.quantile(x, np.arange(1, 256) / 256)
    code = np.searchsorted(edges, x, "right").astype(np.uint8)
    total, n = np.bincount(code, x, 256), np.bincount(code, minlength=256)
    return code, (total / np.maximum(n, 1)).astype(np.float32)


class Trie:
    """One shard's levels, read in place from a buffer or a mapped file."""

    def __init__(self, buffer):
        n, pairs = struct.unpack_from("<QQ", buffer)
        at = 16
        self.words = elias_fano.Sequence(buffer, at)
        self.sums = elias_fano.Sequence(buffer, self.words.end)
        self.pointers = elias_fano.Sequence(buffer, self.sums.end)
        self.contexts = elias_fano.Sequence(buffer, self.pointers.end)
        at = self.contexts.end
        self.back_book, self.book = np.frombuffer(buffer, np.float32, 256, at), np.frombuffer(buffer, np.float32, 256, at + 1024)
        self.back_code, self.code = np.frombuffer(buffer, np.uint8, n, at + 2048), np.frombuffer(buffer, np.uint8, pairs, at + 2048 + n)

    @staticmethod
    def encode(words: np.ndarray, count: np.ndarray, at: np.ndarray, context: np.ndarray, backoff: np.ndarray, value: np.ndarray) -> bytes:
        """words sorted; (at, context) sorted pairs, at being the word's rank."""
        pointers = np.searchsorted(at, np.arange(len(words) + 1))
        levels = (words, np.concatenate([[0], np.cumsum(count)]), pointers, at.astype(_U) << _U(32) | context.astype(_U))
        (back_code, back_book), (code, book) = quantise(backoff), quantise(value)
        return b"".join([struct.pack("<QQ", len(words), len(at)), *map(elias_fano.encode, levels), back_book.tobytes(), book.tobytes(), back_code.tobytes(), code.tobytes()])

    def find(self, word: np.ndarray) -> np.ndarray:
        """Rank of each word, -1 if it is not there."""
        return self.words.successor(word)

    def count(self, rank: np.ndarray) -> np.ndarray:
        return (self.sums.access(rank + 1) - self.sums.access(rank)).astype(np.int64)

    def backoff(self, rank: np.ndarray) -> np.ndarray:
        return self.back_book[self.back_code[rank]].astype(float)

    def pair(self, rank: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Place of each context within its word's own segment, -1 if it is not there."""
        a, b = self.pointers.access(rank).astype(np.int64), self.pointers.access(rank + 1).astype(np.int64)
        return self.contexts.successor(rank.astype(_U) << _U(32) | context.astype(_U), a, b)

    def value(self, place: np.ndarray) -> np.ndarray:
        return self.book[self.code[place]].astype(float)


def _totals(words: np.ndarray, count: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Counts over all shards."""
    if not len(hot[0]) or not len(words):
        return count
    at = np.minimum(np.searchsorted(hot[0], words), len(hot[0]) - 1)
    return np.where(hot[0][at] == words, hot[1][at], count)


def _build(stats: dict, hot: tuple[np.ndarray, np.ndarray], least: int):
    def run(merged: pd.DataFrame, contexts: pd.DataFrame) -> pd.DataFrame:
        if not len(merged):
            return pd.DataFrame({"shard": [], "data": []})
        row = merged.iloc[0]
        words = np.frombuffer(row["word"], _U)
        count = _totals(words, _unzip(row["count"], np.int64), hot)
        contexts = contexts.sort_values("lot")
        v, cv, b = (np.concatenate([_unzip(x, k) for x in contexts[c]]) for c, k in (("v", np.uint32), ("cv", np.int64), ("b", np.float32)))
        b = b.astype(float)
        at, context, n = _unzip(row["at"], np.int32).astype(np.int64), np.frombuffer(row["context"], np.uint32), _unzip(row["pairs"], np.int64)
        kept = np.flatnonzero(n >= least)
        at, context, n = at[kept], context[kept], n[kept]
        c = np.searchsorted(v, context)
        p = (n - stats["discount"]) / cv[c] + 10.0 ** b[c] * (count[at] - stats["unigram"]) / max(1, stats["tokens"])
        backoff = b[np.searchsorted(v, (words >> _U(32)).astype(np.uint32))]
        return pd.DataFrame([{"shard": int(row["shard"]), "data": Trie.encode(words, count, at, context, backoff, np.log10(p) - b[c])}])

    return run


def train(rows: DataFrame, bits: int, hot: np.ndarray, least_pairs: int = 1) -> tuple[DataFrame, dict]:
    """Shards of the trie (shard, data), and the constants, from rows (doc_id, text)."""
    packed = rows.mapInArrow(_pack(bits, hot), PACKED)
    shards = written(packed.groupBy("shard").applyInPandas(_merge, MERGED))
    stats = shards.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "words", "w1", "w2", "p1", "p2")]).first().asDict()
    totals = (hot, np.zeros(len(hot), np.int64))
    if len(hot):  # their contexts lie in all shards: their counts are summed, and they are one word each
        mine = shards.select("word", "count").mapInArrow(_hot_rows(hot), "k int, n long").groupBy("k").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("shards"), F.sum((F.col("n") == 1).cast("long")).alias("w1"), F.sum((F.col("n") == 2).cast("long")).alias("w2"))
        for r in mine.collect():  # HOT_SHARE rows at most
            totals[1][r["k"]] = r["n"]
            stats["words"] -= r["shards"] - 1
            stats["w1"] -= r["w1"] - (r["n"] == 1)
            stats["w2"] -= r["w2"] - (r["n"] == 2)
    stats |= {"bits": bits, "discount": _discount(stats["p1"], stats["p2"]), "unigram": _discount(stats["w1"], stats["w2"])}
    stats["unknown"] = stats["unigram"] * stats["words"] / stats["tokens"] if stats["tokens"] else 1.0
    asked = shards.select("shard", "word", "context", "pairs").mapInArrow(_requests(max(3, bits - 2), least_pairs), REQUEST)
    replies = written(asked.groupBy("lot").applyInPandas(_replies(stats["discount"]), REPLY))
    stats["hot"] = (*totals, np.zeros(len(hot)))
    if len(hot):  # known in every shard, also where none of their pairs lies
        found = replies.select("v", "b").mapInArrow(_weights(hot), "v long, b double").groupBy("v").agg(F.max("b").alias("b"))
        weights = {r["v"]: r["b"] for r in found.collect()}  # HOT_SHARE rows at most
        stats["hot"][2][:] = [weights.get(v, 0.0) for v in (hot >> _U(32)).tolist()]
    trie = (shards.select("shard", "word", "count", "at", "context", "pairs").groupBy("shard")
            .cogroup(replies.groupBy("shard")).applyInPandas(_build(stats, totals, least_pairs), "shard int, data binary"))
    return written(trie), stats


def _hot_rows(hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, k, at = np.intersect1d(hot, np.frombuffer(word, _U), assume_unique=True, return_indices=True)
                yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(_unzip(count, np.int64)[at])], ["k", "n"])

    return run


_DOCS = np.dtype([("id", "<i8"), ("none", "?"), ("held", "?"), ("n", "<i8")])


def _ask(bits: int, hot: np.ndarray):
    """The queries of all texts, a block a shard: pairs, and in which rows and how often each is used."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, docs, total, seen = TaskContext.get().partitionId(), 0, [], [], 0, 0

        def flush():
            words, contexts, row = (np.concatenate(x) for x in zip(*held))
            shard, word, context, place = _lots(words, contexts, bits, hot)
            use, n = np.unique(place.astype(_U) << _U(32) | row.astype(_U), return_counts=True)
            place = (use >> _U(32)).astype(np.int64)
            row, uses = use.astype(np.uint32), np.bincount(place, minlength=len(word))
            cut = np.searchsorted(shard, np.arange((1 << bits) + 1)).tolist()
            use_cut = np.searchsorted(place, cut).tolist()
            rows, table = [], np.concatenate(docs).tobytes()
            for s, (a, b, c, d) in enumerate(zip(cut, cut[1:], use_cut, use_cut[1:])):
                if b > a:
                    distinct, runs = _runs(word[a:b])
                    rows.append((s, part, block, _zip(distinct), _zip(runs), context[a:b].tobytes(), _zip(uses[a:b].astype(np.uint32)), _zip(row[c:d].astype(np.uint16 if seen <= 1 << 16 else np.uint32)), _zip(n[c:d].astype(np.uint32)), table))
                    table = None  # goes with one of them
            return _batch(rows, QUERIES)

        for batch in batches:
            ids, held_out = batch.column("doc_id"), np.array(batch.column("held_out"))
            for i, j, buf, offsets in _vec.slices(batch.column("text")):
                h, first = tokens(buf, offsets)
                size = np.diff(np.append(first, len(h)))
                held.append((h, _contexts(h), np.repeat(np.arange(seen, seen + j - i), size)))
                table = np.zeros(j - i, _DOCS)
                table["id"], table["none"] = np.array(ids[i:j].fill_null(0)), np.array(ids[i:j].is_null())
                table["held"], table["n"] = held_out[i:j], size
                docs.append(table)
                total, seen = total + len(h), seen + j - i
                if total >= FLUSH:
                    yield flush()
                    held, docs, total, seen, block = [], [], 0, 0, block + 1
        if held:
            yield flush()

    return run


def _answer(stats: dict):
    """A shard's part of the sums of all rows that asked it."""
    total = stats["tokens"]
    floor = np.log10(1 / (total + stats["words"] + 1))
    unknown = np.log10(stats["unknown"])

    def lot(asked: pd.DataFrame, trie: Trie | None) -> list[tuple]:
        parts = []
        for w, r, c, u, x, n in zip(*(asked[k] for k in ("word", "runs", "context", "uses", "row", "n"))):
            n, x = _unzip(n, np.uint32), _unzip(x, np.uint8)
            parts.append((_unzip(w, _U), _unzip(r, np.uint32), np.frombuffer(c, np.uint32), _unzip(u, np.uint32), x.view(np.uint16 if len(x) == 2 * len(n) else np.uint32).astype(np.uint32), n))
        words, runs, context, uses, row, n = (np.concatenate(x) for x in zip(*parts))
        rank = trie.find(words) if trie else np.full(len(words), -1)
        there = np.flatnonzero(rank >= 0)
        c, back = np.zeros(len(words)), np.zeros(len(words))
        if len(there):
            c[there], back[there] = trie.count(rank[there]), trie.backoff(rank[there])
        hot, totals, weights = stats["hot"]
        if len(hot):
            at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
            common = np.flatnonzero(hot[at] == words)
            c[common], back[common] = totals[at[common]], weights[at[common]]
        alone = np.where(c > 0, np.log10(np.maximum(c - stats["unigram"], 1e-9) / max(1, total)), unknown)
        term = np.repeat(alone, runs)
        rank = np.repeat(rank, runs)
        there = np.flatnonzero(rank >= 0)
        if len(there):
            place = trie.pair(rank[there], context[there])
            hit = np.flatnonzero(place >= 0)
            term[there[hit]] = trie.value(place[hit])
        term += np.repeat(back, runs)
        base = np.repeat(floor + np.log10(c + 1), runs)
        base, term, known = (np.repeat(x, uses) * n for x in (base, term, np.repeat(c > 0, runs)))
        who = np.repeat(np.arange(len(parts), dtype=_U), [len(p[4]) for p in parts]) << _U(32) | row.astype(_U)
        who, at = np.unique(who, return_inverse=True)
        base, term, known = (np.bincount(at, x, len(who)) for x in (base, term, known))
        cut = np.searchsorted(who, np.arange(len(parts) + 1, dtype=_U) << _U(32)).tolist()
        row = who.astype(np.uint32)
        return [(int(asked["shard"].iloc[0]), part, block, _zip(row[a:b]), _zip(known[a:b].astype(np.uint32)), base[a:b].tobytes(), term[a:b].astype(np.float32).tobytes(), docs)
                for part, block, docs, a, b in zip(asked["part"], asked["block"], asked["docs"], cut, cut[1:])]

    def run(asked: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        trie = Trie(model["data"].iloc[0]) if len(model) else None
        out, size = [], np.cumsum([len(c) // 4 for c in asked["context"]]) // FLUSH
        for k in np.unique(size):
            out += lot(asked[size == k], trie)
        return pd.DataFrame(out, columns=[f.split()[0] for f in ANSWERS.split(", ")])

    return run


def _sum(train_tokens: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        docs = np.frombuffer(next(d for d in group["docs"] if d is not None), _DOCS)
        known, base, score = np.zeros(len(docs), np.int64), np.zeros(len(docs)), np.zeros(len(docs))
        group = group.sort_values("shard")  # sums in one order, whatever the shuffle's
        for r, k, b, s in zip(group["row"], group["known"], group["base"], group["score"]):
            r = _unzip(r, np.uint32)
            known[r] += _unzip(k, np.uint32)
            base[r] += np.frombuffer(b, float)
            score[r] += np.frombuffer(s, np.float32)
        ids = pd.Series(docs["id"], dtype="Int64").mask(docs["none"])
        return pd.DataFrame({"doc_id": ids, "held_out": docs["held"], "n_tokens": docs["n"], "n_known": known, "train_tokens": train_tokens, "base_score": base, "score": score})

    return run


def score_texts(df: DataFrame, held_out: tuple[int, int] = HELD_OUT, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES,
                least_pairs: int = 1, hot_least: int = HOT_LEAST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row; rows held out teach nothing.

    Pairs seen less than `least_pairs` times are left to the back-off.
    """
    mod, rest = held_out
    rows = id_text(df, id_col, text_col)
    rows = rows.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod == rest)
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(3, (size // shard_bytes).bit_length())
    # which words are hot only says how the work is dealt: no count rests on it, and a sixteenth of the rows tells
    some = rows.where(F.xxhash64("doc_id", "text") % DEALING == 0)
    common = some.select("doc_id", "text").mapInArrow(_common_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") * DEALING >= hot_least)
    hot = np.sort(np.array([r["word"] for r in common.orderBy(F.desc("n"), "word").limit(HOT_SHARE).collect()], np.int64).view(_U))
    trie, stats = train(rows.where("not held_out").select("doc_id", "text"), bits, hot, least_pairs)
    asked = rows.mapInArrow(_ask(bits, hot), QUERIES)
    answers = asked.groupBy("shard").cogroup(trie.groupBy("shard")).applyInPandas(_answer(stats), ANSWERS)
    return answers.groupBy("part", "block").applyInPandas(_sum(stats["tokens"]), OUT)
