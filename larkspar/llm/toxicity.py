"""Toxicity by noisy-channel deobfuscation.

A token that looks disguised (a mark or digit with a reading anywhere in it, repeated letters, letters, marks
or digits set apart by spaces or marks) becomes a lattice of the characters that could have been meant; Viterbi decoding under a character language model,
learned from all documents, picks the likeliest reading. Plain and restored words, and the beginnings of
words, are the features of a logistic regression over the words that go with the label.

Bounds: the language model has 27**4 cells whatever the corpus; the classifier is fitted on at most
SAMPLE labelled rows (those of least id hash) and keeps at most FEATURES features. Counts for the language
model cover every document. Labels are the only thing taken from the label table, and only for rows that
are not held out; language, source and id never enter a score.

Defined results: a null or empty text has a score (the bias alone); rows that share an id are scored each;
a document labelled twice is toxic if either says so; without labels, or with labels of one kind only, every
text scores 0; an empty table gives an empty result; other columns pass through `score_texts` untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _vec
from ._common import fresh, id_text, quoted, written

SAMPLE = 20_000
FEATURES = 1_024
LEAST_SUPPORT = 4  # toxic rows a feature must be seen in
PREFIXES = (4, 5, 6, 7, 8)  # bytes
HELD_OUT = (3, 1)
THRESHOLD = 0.7
ORDER, SYMBOLS = 4, 27
SLICE_BYTES = 1 << 18  # of text at a time: the arrays over it take about a hundred times as much
READ = 20_000  # readings a decoder remembers
_U = np.uint64

# Readings of a mark or digit: fixed values.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "{": "c", "€": "e", "£": "l", "¡": "i",
    "*": "aeiou", "#": "aeiou", "%": "aeiou", "&": "aeiou",
}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True
_READABLE = np.zeros(256, bool)
_READABLE[[ord(c) for c in READINGS if ord(c) < 128]] = True
_WIDE = [np.frombuffer(c.encode(), np.uint8) for c in READINGS if ord(c) >= 128]
_ASCII = np.zeros(256, np.uint8)
_ASCII[97:123] = np.arange(1, 27)


def character_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, n): how often each run of four symbols occurs; 0 is a word's edge."""
    total = np.zeros(SYMBOLS**ORDER, np.int64)
    for batch in batches:
        for _, _, buf, offsets in _vec.slices(batch.column(1), SLICE_BYTES):
            s = _ASCII[_LOWER[buf]].astype(np.int64)
            s = np.concatenate([np.zeros(3, np.int64), s, np.zeros(1, np.int64)])
            # before a word's first letter everything is edge
            one, two, three = s[2:-1].copy(), s[1:-2].copy(), s[:-3].copy()
            two[one == 0] = 0
            three[two == 0] = 0
            here = s[3:]
            use = (one > 0) | (here > 0)
            total += np.bincount(((three * SYMBOLS + two) * SYMBOLS + one)[use] * SYMBOLS + here[use], minlength=len(total))
    cell = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["cell", "n"])


def language_model(counts: np.ndarray, strength: float = 4.0) -> np.ndarray:
    """log p(symbol | three before), each order smoothed by the one below."""
    c = counts.reshape((SYMBOLS,) * ORDER).astype(float)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        n = c.sum(axis=tuple(range(ORDER - order))) if order < ORDER else c
        p = (n + strength * p) / (n.sum(-1, keepdims=True) + strength)
    return np.log(p)


class _Rows(dict):
    """State -> its row of the language model as a list, made when first asked for."""

    def __init__(self, model: np.ndarray):
        self.model = model.reshape(-1, SYMBOLS)

    def __missing__(self, at: int) -> list[float]:
        self[at] = row = self.model[at].tolist()
        return row


class Decoder:
    """Viterbi over a token's character lattice."""

    def __init__(self, model: np.ndarray):
        self.model = _Rows(model)
        self.read: dict[str, str] = {}

    def decode(self, token: str) -> str:
        if token not in self.read:
            if len(self.read) >= READ:
                self.read.clear()
            self.read[token] = self._decode(token)
        return self.read[token]

    @staticmethod
    def lattice(token: str) -> list[list[tuple[str, float]]]:
        out, i = [], 0
        while i < len(token):
            c, n = token[i], 1
            while i + n < len(token) and token[i + n] == c:
                n += 1
            if c.isalpha():
                out.append([(c, 0.0)] if n == 1 else [(c * 2, -0.1), (c, -2.5)] if n == 2 else [(c, -0.5), (c * 2, -0.7)])
            else:
                wild = len(READINGS.get(c, "")) > 2
                options = [(r, -3.0 if wild else -1.0) for r in READINGS.get(c, "")]
                if n == 2 and not wild:
                    options += [(a * 2, s - 0.5) for a, s in options]
                out.append([*options, ("", -1.0 if wild or not options else -3.0)])
            i += n
        return out

    def _decode(self, token: str) -> str:
        model = self.model
        states = {0: (0.0, None)}  # last three symbols -> best score and reading, as a chain from its end
        for options in self.lattice(token):
            after: dict[int, tuple[float, tuple | None]] = {}
            for state, (score, text) in states.items():
                for reading, cost in options:
                    s, at = score + cost, state
                    for ch in reading:
                        k = ord(ch) - 96
                        k = k if 0 < k < SYMBOLS else 0
                        s += model[at][k]
                        at = (at * SYMBOLS + k) % SYMBOLS**3 if k else 0
                    if at not in after or s > after[at][0]:
                        after[at] = (s, (text, reading))
            states = after
        return max((s + model[at][0], _unchained(t)) for at, (s, t) in states.items())[1]


def _unchained(chain: tuple | None) -> str:
    out = []
    while chain:
        chain, reading = chain
        out.append(reading)
    return "".join(reversed(out))


_decoders: dict[int, Decoder] = {}


def decoder_of(model: np.ndarray) -> Decoder:
    """The one decoder of a Python worker: its tasks share it, so none is left for the collector after each."""
    key = zlib.crc32(model)
    if key not in _decoders:
        _decoders.clear()
        _decoders[key] = Decoder(model)
    return _decoders[key]


def _features(buf: np.ndarray, offsets: np.ndarray, decoder: Decoder, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) of plain words, word beginnings and restored words, of those in `known` if it is given.

    A feature counts once a row.
    """
    low = _LOWER[buf]
    start, end, rows = _vec.word_bounds(low, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    letter, readable = _LETTER[low], _READABLE[low]
    for c in _WIDE:  # marks of several bytes that have readings are no letters
        at = np.flatnonzero(low[: max(0, len(low) - len(c) + 1)] == c[0])
        for k in range(1, len(c)):
            at = at[low[at + k] == c[k]]
        for k in range(len(c)):
            letter[at + k], readable[at + k] = False, True
    at = np.arange(len(low))
    last = np.maximum.accumulate(np.where(letter, at, -1))[end - 1] + 1
    first = np.minimum.accumulate(np.where(letter, at, len(low))[::-1])[::-1][start]
    has = last > start
    letters = np.concatenate([[0], np.cumsum(letter)])
    marks = (letters[last] - letters[start]) < (last - start)  # something but letters before the last letter
    n_letters = letters[np.maximum(last, start)] - letters[start]
    triple = np.zeros(len(low) + 1, np.int64)
    if len(low) > 2:
        triple[3:] = np.cumsum((low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & letter[2:])
    repeated = has & (last - start > 2) & (triple[np.maximum(last, start)] > triple[np.minimum(start + 2, len(low))])
    ws, we, wr = first[has], last[has], rows[has]
    out_rows, out = [wr], [_vec.span_hashes(low, ws, we)]
    for k in PREFIXES:
        long = we - ws > k
        out_rows.append(wr[long])
        out.append(_vec.mix(_vec.span_hashes(low, ws[long], ws[long] + k) + _U(k)))
    # Disguised words are read every way they may be meant, so one reading hides no other.
    # A letter alone, three times or more in a row, is a word set apart; so is a run of single characters of any kind.
    heads = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])  # characters, not bytes
    chars = heads[end] - heads[start]
    usable = letter | readable
    head_of = lambda mask: np.concatenate([[0], np.cumsum(mask & ((low & 0xC0) != 0x80))])
    n_usable, n_heads = head_of(usable), head_of(letter)
    n_usable, lone = n_usable[end] - n_usable[start], n_heads[end] - n_heads[start] == 1
    ascii_single = has & (n_letters == 1) & (end - start <= 2)
    any_single = (chars == 1) | ((chars == 2) & (lone | (n_usable == 1)))
    words: list[str] = []
    owners: list[int] = []

    def sole(k: int) -> str:
        """The letter of a token, or else its mark."""
        t = low[start[k] : end[k]].tobytes().decode("utf-8", "ignore")
        return next((c for c in t if c.isalpha()), None) or next((c for c in t if c in READINGS), t[:1])

    spans = set()
    for single in (ascii_single, any_single):
        edge = np.diff(np.concatenate([[0], single.astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            cut = [a, *[k for k in range(a + 1, b) if rows[k] != rows[k - 1]], b]
            for x, y in zip(cut, cut[1:]):
                core = np.flatnonzero(lone[x:y])  # without the marks and digits around it
                spans.add((x, y))
                if len(core):
                    spans.add((x + int(core[0]), x + int(core[-1]) + 1))
    for x, y in sorted(spans):
        if y - x >= 3:
            words.append("".join(map(sole, range(x, y))))
            owners.append(int(rows[x]))
    # leading marks may be letters too ("$cum"): the lattice decides
    odd = np.flatnonzero(has & (n_letters > 0) & (last - start > 2) & (marks | repeated))
    spans = set(zip(start[odd].tolist(), last[odd].tolist(), rows[odd].tolist()))
    # and so may marks and digits anywhere, all trailing ones included ("sh17", "cla$$", "@$$")
    stop = np.maximum.accumulate(np.where(usable, at, -1))[end - 1] + 1
    begin = np.minimum.accumulate(np.where(usable, at, len(low))[::-1])[::-1][start]
    reads = np.concatenate([[0], np.cumsum(readable)])
    odd = np.flatnonzero((reads[end] > reads[start]) & (chars > 1))
    spans.update(zip(begin[odd].tolist(), stop[odd].tolist(), rows[odd].tolist()))
    for a, b, r in sorted(spans):
        words.append(low[a:b].tobytes().decode("utf-8", "ignore"))
        owners.append(r)
    if words:
        read = [decoder.decode(w).encode() for w in words]
        size = np.array([len(w) for w in read], np.int64)
        stop = np.cumsum(size)
        raw = np.frombuffer(b"".join(read), np.uint8)
        owner = np.array(owners, np.int64)
        for k in (0, *PREFIXES):
            long = size > k
            a, b = (stop - size)[long], stop[long]
            out_rows.append(owner[long])
            out.append(_vec.mix(_vec.span_hashes(raw, a, a + k) + _U(k)) if k else _vec.span_hashes(raw, a, b))
    row, h = np.concatenate(out_rows), np.concatenate(out)
    if known is not None:
        hit = known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)
        row, h = row[hit], h[hit]
    _, once = np.unique(_vec.mix(h + row.astype(_U) * _U(0x9E3779B97F4A7C15)), return_index=True)
    return row[once], h[once]


def _toxic_support(shared):
    """(feature, toxic rows) over toxic rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decoder_of(shared.value)
        for batch in batches:
            for _, _, buf, offsets in _vec.slices(batch.column("text"), SLICE_BYTES):
                keys, n = np.unique(_features(buf, offsets, decoder)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["feature", "bad"])

    return run


def _support(shared, candidates):
    """(feature, rows) of the candidates over all labelled rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, known = decoder_of(shared.value), candidates.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for _, _, buf, offsets in _vec.slices(batch.column("text"), SLICE_BYTES):
                total += np.bincount(np.searchsorted(known, _features(buf, offsets, decoder, known)[1]), minlength=len(known))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(known[some].view(np.int64)), pa.array(total[some])], ["feature", "n"])

    return run


def _design(shared, features):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, known = decoder_of(shared.value), features.value
        for batch in batches:
            for i, j, buf, offsets in _vec.slices(batch.column("text"), SLICE_BYTES):
                row, h = _features(buf, offsets, decoder, known)
                at = np.searchsorted(known, h)
                found: list[list[int]] = [[] for _ in range(j - i)]
                for r, k in zip(row.tolist(), at.tolist()):
                    found[r].append(k)
                yield pa.RecordBatch.from_arrays([batch.column("toxic")[i:j], pa.array(found, pa.list_(pa.int32()))], ["toxic", "found"])

    return run


def logistic(row: np.ndarray, column: np.ndarray, m: int, y: np.ndarray, ridge: float = 0.05, steps: int = 1_500) -> tuple[np.ndarray, float]:
    """Ridge logistic regression over binary features, given as (row, column) places, by accelerated descent."""
    n = len(y)
    row, column = np.concatenate([row, np.arange(n)]), np.concatenate([column, np.full(n, m)])  # a last feature for the bias
    ahead = lambda w: np.bincount(row, w[column], n)
    back = lambda r: np.bincount(column, r[row], m + 1)
    v = np.ones(m + 1)
    for _ in range(30):  # the largest singular value bounds the step
        v = back(ahead(v))
        v /= np.linalg.norm(v) + 1e-12
    rate = 1 / (0.25 * np.linalg.norm(ahead(v)) ** 2 + ridge)
    p = np.append(np.zeros(m), np.log((y.sum() + 1) / (n - y.sum() + 1)))
    last, speed, keep = p.copy(), 1.0, np.append(np.full(m, ridge), 0.0)
    for _ in range(steps):
        after = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        q = p + (speed - 1) / after * (p - last)
        gradient = back(1 / (1 + np.exp(-np.clip(ahead(q), -30, 30))) - y) + keep * q
        last, p, speed = p, q - rate * gradient, after
    return p[:-1], float(p[-1])


def fit(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = HELD_OUT, sample: int = SAMPLE) -> dict:
    """The bounded model: language model, sorted features, their weights, bias. docs: doc_id, text."""
    spark = docs.sparkSession
    cells = docs.mapInArrow(character_counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # 27**4 rows at most
    counts = np.zeros(SYMBOLS**ORDER)
    counts[cells["cell"]] = cells["n"]
    model = spark.sparkContext.broadcast(language_model(counts))
    mod, rest = held_out
    own = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
           .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod != rest)
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = written(docs.join(F.broadcast(own), "doc_id").select("toxic", "text"))
    empty = {"model": model, "features": np.zeros(0, _U), "weights": np.zeros(0), "bias": -30.0}
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("bad")).first()
    n, bad = sums["n"], sums["bad"] or 0
    if not 0 < bad < n:
        return empty
    toxic = (rows.where("toxic = 1").select("text").mapInArrow(_toxic_support(model), "feature long, bad long").groupBy("feature").agg(F.sum("bad").alias("bad"))
             .where(F.col("bad") >= LEAST_SUPPORT))
    toxic = written(toxic)
    # words of at most `sample` rows, each in LEAST_SUPPORT of them
    candidates = spark.sparkContext.broadcast(np.sort(toxic.select("feature").toPandas()["feature"].to_numpy(np.int64).view(_U)))
    seen = rows.select("text").mapInArrow(_support(model, candidates), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    support = toxic.join(seen, "feature").select("feature", "bad", (F.col("n") - F.col("bad")).alias("good"))
    # the G statistic against independence, for features that go with the label
    k, t = F.col("bad"), F.col("bad") + F.col("good")
    part = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    g = 2 * (part(k, t * bad / n) + part(t - k, t * (n - bad) / n) + part(bad - k, (n - t) * bad / n) + part((n - bad) - (t - k), (n - t) * (n - bad) / n))
    best = (support.where((k >= LEAST_SUPPORT) & (k * n > t * bad)).select("feature", g.alias("g")).where("g >= 12")
            .orderBy(F.desc("g"), "feature").limit(FEATURES).toPandas())
    if not len(best):
        return empty
    features = np.sort(best["feature"].to_numpy(np.int64).view(_U))
    design = rows.mapInArrow(_design(model, spark.sparkContext.broadcast(features)), "toxic int, found array<int>").toPandas()
    each = design["found"].map(len).to_numpy(np.int64)
    column = np.concatenate([*design["found"], []]).astype(np.int64)
    weights, bias = logistic(np.repeat(np.arange(len(design)), each), column, len(features), design["toxic"].to_numpy(float))
    return {"model": model, "features": features, "weights": weights, "bias": bias}


def score_texts(df: DataFrame, model: dict, text_col: str = "text", score: str = "score") -> DataFrame:
    """df with a score from 0 to 1."""
    spark = df.sparkSession
    (text,) = fresh(df, "text")
    shared = spark.sparkContext.broadcast((model["features"], model["weights"], model["bias"]))
    letters = model["model"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, bias = shared.value
        decoder = decoder_of(letters.value)
        for batch in batches:
            column = batch.column(text)
            for i, j, buf, offsets in _vec.slices(column, SLICE_BYTES):
                z = np.full(j - i, bias)
                if len(features):
                    row, h = _features(buf, offsets, decoder, features)
                    z += np.bincount(row, weights[np.searchsorted(features, h)], j - i)
                part = batch.slice(i, j - i).drop_columns([text])
                yield part.append_column(score, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))))

    rows = df.withColumn(text, F.coalesce(F.col(quoted(text_col)), F.lit("")))
    schema = df.select(*[quoted(c) for c in df.columns]).withColumn(score, F.lit(0.0)).schema
    return rows.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = HELD_OUT, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = id_text(docs, "doc_id", "text")
    model = fit(rows, labels, held_out)
    mod, rest = held_out
    flag = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod == rest
    return score_texts(rows, model).select("doc_id", flag.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that score at the threshold or above; columns as they were."""
    (score,) = fresh(docs, "score")
    model = fit(id_text(docs, "doc_id", "text"), labels)
    return score_texts(docs, model, score=score).where(F.col(score) < threshold).drop(score)
