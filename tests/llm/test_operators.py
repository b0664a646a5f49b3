"""Every operator on small awkward tables: nulls, empty and long texts, ties, repeated rows, an empty table, clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from larkspar.llm import bpe, elias_fano, exact_dedup, fingerprint, lm, ngram_jaccard, packing, pii, substring, toxicity, wavelet

SCHEMA = "doc_id long, text string, lang string, kept boolean, _lk_maybe int"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    shared = text(30)
    base = text(120)
    out = [None, "", "   ", "one", "a b c d", "a b  c d", "For " * 60, text(6000), "x" * 40_000, "İΣ's don't 12 漢字 \U0001f600  \n\t end ", "\\E $1 mail a.b@c.d-e.fr, +33 1 44 07 80 00",
           "ip 10.0.0.256 1.2.3.4.5 card 4539 1488 0343 6467 and 4539148803436468", "i d i o t m0r0n"]
    out += [text(40) + " " + shared + " " + text(40) for _ in range(4)]
    for k in range(8):  # near copies
        w = base.split()
        w[10 * k + 3] = f"edit{k}"
        out.append(" ".join(w))
    out += [base] * 5
    return [(i, t, "en", True, 1) for i, t in enumerate(out)] + [(3, "one", "en", False, 2), (None, "a b c d", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def plain(rows):
    """Rows with ids of their own, by id."""
    return {i: t or "" for i, t, *_ in rows if i not in (3, None)}


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_groups(spark, docs, rows):
    got = exact_dedup.exact_groups(docs).collect()
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    want = sorted((str(i), str(max((x for x in groups[t or ""] if x is not None), default=None)), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    left = exact_dedup.deduplicate(docs)
    assert left.columns == docs.columns and left.count() == len(groups)
    beyond = exact_dedup.exact_groups(docs, most_bits=1).collect()  # the filter is not broadcast
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in beyond) == want
    own = lambda df: sorted(str((r.doc_id, r.text)) for r in df.collect())  # noqa: E731  which of rows equal in both stays is open
    assert own(exact_dedup.deduplicate(docs, most_bits=1)) == own(left)
    assert exact_dedup.exact_groups(empty(spark)).count() == 0 and exact_dedup.deduplicate(empty(spark)).count() == 0


def test_no_false_negative_of_the_filter(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("t"))
    for broadcast in (True, False):
        assert exact_dedup.with_candidate_flag(df, F.col("t"), "f", 1 << 15, broadcast).where("not f").count() == 0


def base_spans(t):
    found = []
    for k, p in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - (9 if int(c) > 4 else 0) for i, c in enumerate(d[::-1])) % 10 == 0
            if [True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else True, 12 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15][k]:
                found.append((m.start(), k, m.end()))
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_pii(spark, docs, plain):
    got = by_id(pii.report(docs))
    assert all(got[i].base_sha256 == hashlib.sha256(base_spans(t).encode()).hexdigest() for i, t in plain.items())
    clean = by_id(pii.sanitise(docs))
    assert clean[10].text == "\\E $1 mail [EMAIL], [PHONE]" and clean[0].text is None and clean[10].lang == "en"
    assert pii.report(empty(spark)).count() == 0 and pii.sanitise(empty(spark)).columns == docs.columns


def test_pii_terms(spark):
    """A word that stands beside one address in different contexts, and nowhere else, gives it away."""
    rnd = random.Random(1)
    w = lambda: "w%03d" % rnd.randrange(300) + "x"
    texts = [" ".join(w() for _ in range(8)) + " Zorblax a@b.fr " + " ".join(w() for _ in range(8)) for _ in range(6)] + [" ".join(w() for _ in range(200)) for _ in range(60)] + ["ask Zorblax (Q.E)"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(pii.report(df))
    assert got[0].n_term == 1 and got[66].spans == "term:4:11" and got[20].n_term == 0
    assert "Zorblax" not in by_id(pii.sanitise(df))[66].text


def test_pii_terms_are_folded(spark):
    """Case and punctuation neither split the evidence nor hide an occurrence."""
    rnd = random.Random(1)
    w = lambda: "w%03d" % rnd.randrange(300) + "x"
    beside = [(f, "a@b.fr") for f in ("Zorblax,", "zorblax", "(ZORBLAX)", "Zorblax:")] + [(f, "e@f.fr") for f in ("\u0130zmir,", "\u0130zmir;", "\u0130zmir")]
    texts = [" ".join(w() for _ in range(8)) + f" {form} {address} " + " ".join(w() for _ in range(8)) for form, address in beside]
    n = len(texts)
    texts += [" ".join(w() for _ in range(200)) for _ in range(60)] + ["ask ((zorBlax)), ZORBLAX! un-zorblax \u0130zmir."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(pii.report(df))
    assert [got[k].n_term for k in range(n)] == [1] * n
    assert got[n + 60].spans == "term:6:13,term:17:24,term:37:42"
    clean = by_id(pii.sanitise(df))[n + 60].text
    assert "un-zorblax" in clean and "ZORBLAX" not in clean and "zorBlax" not in clean


def test_pii_terms_of_repeated_rows(spark):
    """Rows equal in id and text each get their spans; a term behind a very long word counts; no column name clashes."""
    rnd = random.Random(2)
    w = lambda: "w%03d" % rnd.randrange(300) + "x"
    long = "y" * 170
    texts = [" ".join(w() for _ in range(8)) + f" Zorblax {long} a@b.fr " + " ".join(w() for _ in range(8)) for _ in range(6)]
    texts += [" ".join(w() for _ in range(9)) + f" e@f.fr {long} Quuxly " + " ".join(w() for _ in range(8)) for _ in range(6)]
    texts += [" ".join(w() for _ in range(200)) for _ in range(60)]
    rows = [(i, t, -7, "mine", "mine", "mine") for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[0], rows[0], rows[8]], "doc_id long, text string, _lk_row long, _lk_base string, _lk_added string, _lk_terms string")
    got = pii.report(df.select("doc_id", "text")).collect()
    assert sorted(r.doc_id for r in got if r.n_term == 2) == [0, 0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 10, 11] and len(got) == len(rows) + 3
    clean = pii.sanitise(df).collect()
    assert all("Zorblax" not in r.text and "Quuxly" not in r.text and r[2:] == (-7, "mine", "mine", "mine") for r in clean) and len(clean) == len(rows) + 3


def test_wavelet(spark, docs, rows):
    rnd = np.random.default_rng(2)
    seq = rnd.integers(0, 200, 9001).astype(np.uint16)
    w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(seq).to_bytes())
    assert (w.decode() == seq).all() and all(w.access(i) == seq[i] for i in range(0, 9001, 700))
    assert w.rank(9, 5000) == (seq[:5000] == 9).sum() and w.occurrences(9) == np.flatnonzero(seq == 9).tolist() and w.count(60_000) == 0
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tk.encode_special_tokens = True
    want, start = [], 0
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tk.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = wavelet.encoded_digests(docs, P.path("word_bpe_49k.json")).orderBy("start").collect()
    assert [tuple(r) for r in got] == want
    assert wavelet.encoded_digests(empty(spark), P.path("word_bpe_49k.json")).count() == 0


def test_added_tokens_are_one_id(spark):
    """A literal added token in a text is the library's one id, and later documents start accordingly."""
    from tokenizers import Tokenizer

    texts = ["plain one", "end <|endoftext|> of", "<|startoftext|>É<|endoftext|><|endoftext|>", "", "<|ENDOFTEXT|> last"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tk, want, start = Tokenizer.from_file(P.path("word_bpe_49k.json")), [], 0
    for i, t in enumerate(texts):
        ids = [*tk.encode(t, add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in wavelet.encoded_digests(df, P.path("word_bpe_49k.json")).orderBy("start").collect()] == want
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for r in packing.pack(df, P.path("byte_bpe_50k.json")).collect():
        ids = np.array([*tk.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.length, r.doc_tokens, r.ids_crc32) == (0, len(ids), len(ids), zlib.crc32(ids.tobytes()))


def test_language_model(spark, docs, plain, rows, monkeypatch):
    monkeypatch.setattr(lm, "DEALING", 1)
    got = by_id(lm.score_texts(docs))
    tokens = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in words(t)] + ["\0"]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    count = collections.Counter(w for i, t, *_ in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    for i, t in plain.items():
        own = tokens(t)
        assert (got[i].held_out, got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (held(i), len(own), sum(w in count for w in own), n)
        assert math.isclose(got[i].base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
    shards = by_id(lm.score_texts(docs, shard_bytes=500))
    hot = by_id(lm.score_texts(docs, shard_bytes=500, hot_least=20))
    for other in (shards, hot):
        assert all(other[i].base_score == pytest.approx(got[i].base_score, rel=1e-9) and other[i].n_known == got[i].n_known for i in plain)
        far = {i: (other[i].score, got[i].score) for i in plain if not math.isclose(other[i].score, got[i].score, rel_tol=0.05, abs_tol=0.3)}
        assert not far  # codebooks are a shard's
    assert lm.score_texts(empty(spark)).count() == 0


def test_scores_by_brute_force(spark, monkeypatch):
    """The interpolated model, computed from plain counts; codes cost a little precision."""
    rnd = random.Random(13)
    vocabulary = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join(rnd.choice(vocabulary[: rnd.choice([3, 12, 40])]) for _ in range(rnd.randint(0, 60)))) for i in range(120)] + [(500, "unseen words w1 w2"), (501, None)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    own = {i: [*words(t), "\0"] for i, t in rows}
    pairs = collections.Counter(p for i, t in own.items() if not held(i) for p in zip(["\0", *t], t))
    count = collections.Counter(w for i, t in own.items() if not held(i) for w in t)
    after = collections.Counter(v for v, _ in pairs.elements())
    kinds = collections.Counter(v for v, _ in pairs)
    n = sum(count.values())
    d, u = (lm._discount(*(sum(c == k for c in x.values()) for k in (1, 2))) for x in (pairs, count))

    def p(v, w):
        alone = (count[w] - u) / n if w in count else u * len(count) / n
        return alone if v not in after else max(pairs[v, w] - d, 0) / after[v] + d * kinds[v] / after[v] * alone

    assert all(math.isclose(sum(p(v, w) for w in [*count, "?"]), 1, rel_tol=1e-9) for v in [*count, "\0"])
    monkeypatch.setattr(lm, "DEALING", 1)
    for hot in (lm.HOT_LEAST, 50):
        got = by_id(lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), hot_least=hot))
        for i, t in own.items():
            assert math.isclose(got[i].score, sum(math.log10(p(v, w)) for v, w in zip(["\0", *t], t)), rel_tol=0.02, abs_tol=0.05), i


def test_elias_fano():
    rnd = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 2**63), (3, 10), (1000, 2**64 - 1), (100_000, 2**40), (500, 5), (70_000, 70_000)):
        v = np.sort(rnd.integers(0, top, n, dtype=np.uint64, endpoint=True))
        s = elias_fano.Sequence(elias_fano.encode(v))
        assert (s.access(np.arange(n)).astype(np.uint64) == v).all() and s.n == n
        q = np.concatenate([v[:500], rnd.integers(0, top, 500, dtype=np.uint64, endpoint=True)])
        at = s.successor(q)
        assert ((at >= 0) == np.isin(q, v)).all() and (v[at[at >= 0]] == q[at >= 0]).all()


def test_counts_beyond_32_bits(tmp_path):
    """Also read from a mapped file."""
    words = np.array([5, 1 << 63], np.uint64)
    data = lm.Trie.encode(words, np.array([7, 2**32 + 3]), np.array([1]), np.array([9], np.uint32), np.zeros(2), np.array([-1.5]))
    (tmp_path / "shard").write_bytes(data)
    trie = lm.Trie(np.memmap(tmp_path / "shard", np.uint8, "r"))
    rank = trie.find(words)
    assert trie.count(rank).tolist() == [7, 2**32 + 3] and trie.value(trie.pair(rank, np.array([9, 9], np.uint32))[1:]).tolist() == [-1.5]
    assert trie.pair(rank, np.array([9, 8], np.uint32)).tolist() == [-1, -1]


def test_substring(spark, docs, plain, rows):
    got = by_id(substring.duplicate_words(docs))
    seen = {}
    for i, t, *_ in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        own, gone = words(t), set()
        for a in range(len(own) - 19):
            key = tuple(own[a : a + 20])
            if key in seen:
                gone |= set(range(a, a + 20))
            seen[key] = i
        if i in plain:
            kept = " ".join(w for k, w in enumerate(own) if k not in gone)
            assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()), i
    assert substring.duplicate_words(empty(spark)).count() == 0


def test_near_duplicates(spark, docs, plain):
    got = by_id(ngram_jaccard.similar_groups(docs))
    sets = {i: frozenset(tuple(words(t)[k : k + 5]) for k in range(max(1, len(words(t)) - 4))) if words(t) else t for i, t in plain.items()}
    sets[3] = sets.get(3, frozenset([("one",)]))

    def near(a, b):
        if isinstance(a, str) or isinstance(b, str):
            return a == b
        return 5 * len(a & b) >= 4 * len(a | b)

    for i in plain:
        links = sum(near(sets[i], sets[j]) for j in plain if j != i)
        if words(plain[i]) != ["a", "b", "c", "d"]:
            assert got[i].n_links == links, i
    assert len({got[i].class_id for i in range(17, 30)}) == 1
    assert ngram_jaccard.similar_groups(empty(spark)).count() == 0
    assert 1 - (1 - ngram_jaccard.meeting_probability(ngram_jaccard.DEPTH)) ** ngram_jaccard.RUNS >= ngram_jaccard.TARGET_RECALL


@pytest.mark.parametrize("top", [9, (1 << 63) - 1])
def test_near_duplicates_of_rows_that_share_an_id(spark, top):
    """Texts, not ids, are compared: rows with one id or none are each linked by their own text."""
    rnd = random.Random(8)
    text = lambda: " ".join("w%d" % rnd.randrange(10**6) for _ in range(60))
    a, b, c, d, e = (text() for _ in range(5))
    near = lambda t, k: " ".join([*t.split()[:-1], f"edit{k}"])
    rows = [(7, a), (3, near(a, 1)), (3, b), (7, c), (8, near(c, 1)), (None, d), (None, near(d, 1)), (None, e), (5, near(e, 1)), (4, near(e, 2)), (4, near(e, 3)), (top, "alone " + text())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    keys = df.select("text", F.xxhash64("text", F.lit(11)), F.xxhash64("text", F.lit(12))).collect()
    key = {(k1, k2): t for t, k1, k2 in keys}
    got = {key[r._lk_k1, r._lk_k2]: (r.doc_id, r.class_id, r.n_links) for r in ngram_jaccard.classes(df).collect()}
    want = [(3, 1), (3, 1), (3, 0), (7, 1), (7, 1), (None, 1), (None, 1), (4, 3), (4, 3), (4, 3), (4, 3), (top, 0)]
    assert [got[t] for _, t in rows] == [(i, *w) for (i, _), w in zip(rows, want)]
    assert collections.Counter(map(tuple, ngram_jaccard.similar_groups(df).select("doc_id", "class_id", "n_links").collect())) == collections.Counter(got.values())
    import corpus_pipeline

    left = collections.Counter(map(tuple, corpus_pipeline.drop_near_copies(spark, df, "").collect()))
    fours = [left[4, near(e, k)] for k in (2, 3)]
    assert sorted(fours) == [0, 1]
    assert {r for r in left if r[0] != 4} == {rows[k] for k in (1, 2, 3, 5, 6, 7, 11)}


def test_blocks_find_all_links(spark, monkeypatch):
    """A group over several blocks and buckets: the same links as all pairs."""
    monkeypatch.setattr(ngram_jaccard, "BLOCK", 8)
    monkeypatch.setattr(ngram_jaccard, "TILE", 3)
    monkeypatch.setattr(ngram_jaccard, "BUCKET", 8)
    base = [f"w{k}" for k in range(100)]
    texts = [" ".join(base[:k] + [f"e{k}"] + base[k + 1 :]) for k in range(5, 45)]
    got = by_id(ngram_jaccard.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    sets = [frozenset(tuple(words(t)[k : k + 5]) for k in range(96)) for t in texts]
    assert [got[i].n_links for i in range(40)] == [sum(5 * len(a & b) >= 4 * len(a | b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    assert {r.class_id for r in got.values()} == {0}


def test_toxicity(spark):
    rnd = random.Random(4)
    good = ["house", "river", "table", "green", "walk", "stone", "letter", "window"]
    rows = [(i, " ".join(rnd.choice(good) for _ in range(20)) + (" moron scum idiot" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic")
    got = {r.doc_id: r for r in toxicity.report(df, labels).collect()}
    assert all(got[i].predicted == y for i, _, y in rows) and got[1].held_out == (zlib.crc32(b"1") % 3 == 1)
    model = toxicity.fit(df.select("doc_id", "text"), labels)
    decoder = toxicity.Decoder(model["model"].value)
    assert [decoder.decode(w) for w in ("m0r0n", "1d10t", "i.d.i.o.t", "moroooon", "$cum", "house")] == ["moron", "idiot", "idiot", "moron", "scum", "house"]
    odd = spark.createDataFrame([(1, "river m0r0n i d i o t", 0.5), (2, "", None), (3, None, None), (3, "green " * 9000, None)], "doc_id long, text string, score double")
    scored = toxicity.score_texts(odd, model, score="s").collect()
    assert [r.s > 0.5 for r in scored] == [True, False, False, False] and toxicity.keep_clean(df.limit(0), labels).count() == 0
    assert {r.predicted for r in toxicity.report(df, labels.limit(0)).collect()} == {0}


@pytest.mark.parametrize("disguise", ["idi07", "idi07.", "cla55", "cla$$", "(cla$$),", "m0r0n!!", "@$$", "£oon", "cr€€p", "m 0 r 0 n", "1 m 0 r 0 n !", "1 m o r o n", "- m - o - r - o - n -", "i d i ö t"])
def test_disguises_reach_the_lattice(disguise):
    toxic = ["moron", "idiot", "class", "ass", "loon", "creep", "idiöt"]
    rnd = random.Random(9)
    text = " ".join(rnd.choice([*toxic, "house", "river", "table", "green"]) for _ in range(3000)).encode()
    counts = np.zeros(toxicity.SYMBOLS**toxicity.ORDER)
    import pyarrow as pa

    for out in toxicity.character_counts(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text.decode()])], ["id", "text"])])):
        counts[out.column(0).to_numpy()] = out.column(1).to_numpy()
    decoder = toxicity.Decoder(toxicity.language_model(counts))
    whole = lambda t: set(toxicity._features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), decoder)[1].tolist())
    known = {t: toxicity._vec.span_hashes(np.frombuffer(t.encode(), np.uint8), np.array([0]), np.array([len(t.encode())]))[0] for t in toxic}
    assert {t for t in toxic if known[t] in whole("river " + disguise + " house")}
    assert not {t for t in toxic if known[t] in whole("river 2024 house 3.50 % table (green) - 1 2 3 4")}


def test_packing(spark, docs, rows, plain):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tk.encode_special_tokens = True
    got = packing.pack(docs, P.path("byte_bpe_50k.json")).toPandas()
    for i, t in plain.items():
        ids, at = np.array([*tk.encode(t, add_special_tokens=False).ids, 0], "<u4"), 0
        for r in got[got.doc_id == i].sort_values("start").itertuples():
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 1024 and (s.offset.to_numpy() == np.concatenate([[0], np.cumsum(s.length)[:-1]])).all()
    assert packing.pack(empty(spark), P.path("byte_bpe_50k.json")).count() == 0


def test_cutting_stock_plan():
    rnd = np.random.default_rng(0)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(rnd.integers(1, 129, 5000), return_counts=True))}
    plan = packing.plan(histogram)
    held = collections.Counter()
    for times, pattern in plan:
        assert sum(k * n for k, n in pattern.items()) <= 128
        for k, n in pattern.items():
            held[k] += times * n
    assert held == histogram and sum(t for t, _ in plan) <= 1.03 * sum(k * n for k, n in histogram.items()) / 128


def test_fingerprints(spark, docs, rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for (i, t, *_), (_, n, *_) in zip(ordered, ordered[1:] + ordered[:1]):
        t, n = t or "", n or ""
        want.append((str(i), len(t), hashlib.sha256((t[: len(t) - len(t) // 4] + n[: len(t) // 4]).encode()).hexdigest()))
    got = fingerprint.edited_report(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    long = {r.doc_id: r for r in got}[7]
    assert 0.6 < long.near_edited < 0.9 and fingerprint.likeness(fingerprint.parse(long.fingerprint), fingerprint.parse(long.fingerprint)) == 1.0
    rnd = random.Random(6)
    t = "".join(rnd.choice("abcdefgh ") for _ in range(5000))
    a, b = fingerprint.chunk_sets([t, "shifted" + t])
    assert fingerprint.containment(a, b) > 0.95 and fingerprint.chunk_sets([t, "zz", t])[0] == fingerprint.chunk_sets(["q", t])[1]
    assert fingerprint.edited_report(empty(spark)).count() == 0


def test_byte_bpe(spark, docs, plain):
    import base64

    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
    enc = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(bpe.encode_digests(docs, P.path("byte_bpe_multi_50k.tiktoken")))
    for i, t in plain.items():
        ids = enc.encode_ordinary(t)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()), i
    assert bpe.encode_digests(empty(spark), P.path("byte_bpe_multi_50k.tiktoken")).count() == 0


def test_stitching():
    import regex

    rnd = random.Random(7)
    for k in range(300):
        t = "".join(rnd.choice("ab's  re\n9!é") for _ in range(rnd.randint(1, 200))) if k % 3 else rnd.choice("a ") * rnd.randint(1, 150)
        text, starts = bpe.stitch([(a, c, bpe.boundaries(c)) for a, c in bpe.chunks(t, 20, 10)])
        assert text == t and starts.tolist() == [m.start() for m in regex.finditer(P.PATTERN, t)]


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs, columns = spark.read.parquet(f"{sf}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        n, columns = docs.count(), docs.columns
        docs = corpus_pipeline.written(stage(spark, docs, sf))
        if name != "packing":
            assert docs.columns == columns and 0 < docs.count() <= n
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
