"""The n-gram Jaccard join against all pairs, and its output against a group's size."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from larkspar.llm import ngram_jaccard


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def links(texts):
    """Linked pairs of distinct texts by comparing all that share a shingle."""
    sets, by, out = [shingles(t) for t in texts], {}, set()
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    for i, s in enumerate(sets):
        near = {j for g in s for j in by[g] if j > i}
        out |= {(i, j) for j in near if 5 * len(s & sets[j]) >= 4 * len(s | sets[j])}
    return out


def edited(rnd, base, edits):
    w = list(base)
    for k in rnd.sample(range(len(w)), edits):
        w[k] = f"e{rnd.randrange(10**9)}"
    return " ".join(w)


def test_pairs_at_the_threshold_are_found(spark):
    """Pairs planted at 0.80 to 0.85: at least the target recall, less what 300 pairs may miss by chance."""
    rnd, texts = random.Random(11), []
    while len(texts) < 600:
        base = [f"w{rnd.randrange(10**9)}" for _ in range(rnd.randint(100, 300))]
        n = len(base) - 4
        other = edited(rnd, base, max(1, round(n * 0.0195)))
        a, b = shingles(" ".join(base)), shingles(other)
        if 0.8 <= len(a & b) / len(a | b) <= 0.85:
            texts += [" ".join(base), other]
    got = {r.doc_id: r for r in ngram_jaccard.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert sum(got[i].n_links for i in range(0, 600, 2)) >= 297
    assert all(got[i].n_links in (0, 1) and got[i + 1].n_links == got[i].n_links for i in range(0, 600, 2))


def test_links_of_a_large_group_and_its_neighbours(spark, monkeypatch):
    """A core over many buckets, looser copies, and strangers that share a passage with it: all pairs' counts."""
    monkeypatch.setattr(ngram_jaccard, "BUCKET", 16)
    monkeypatch.setattr(ngram_jaccard, "STRAYS", 40)
    monkeypatch.setattr(ngram_jaccard, "SETTLING", 50)
    rnd = random.Random(12)
    base = [f"w{k}" for k in range(150)]
    texts = [edited(rnd, base, rnd.choice([1, 1, 2, 3, 4])) for _ in range(200)]
    texts += [" ".join(base[:60] + [f"s{rnd.randrange(10**9)}" for _ in range(90)]) for _ in range(100)]
    want = [0] * len(texts)
    for i, j in links(texts):
        want[i] += 1
        want[j] += 1
    got = {r.doc_id: r.n_links for r in ngram_jaccard.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_proposed_edges_are_linear_in_the_group(spark):
    made = []
    for n in (500, 1_000, 2_000):
        rnd = random.Random(n)
        base = [f"w{k}" for k in range(120)]
        texts = [(i, edited(rnd, base, rnd.choice([1, 2, 3]))) for i in range(n)]
        df = spark.createDataFrame(texts, "id long, text string").repartition(4)
        sketches = ngram_jaccard.written(df.mapInArrow(ngram_jaccard._sketches, ngram_jaccard._SKETCH)).withColumn("root", F.col("id"))
        edges, _, _ = ngram_jaccard._wave(sketches, [1, 2], 0.8, split=False)
        made.append(edges.count())
    assert made[2] <= 2.5 * made[1] <= 6.25 * made[0] and made[2] <= 8 * 2_000


def test_tiles_agree_with_sets():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(0, 60))).astype(np.uint64) for _ in range(40)]
    side, copies = rnd.integers(0, 2, 40).astype(bool), rnd.integers(1, 4, 40)
    for alone in (True, False):
        weight, root = ngram_jaccard.linked(sets, copies, side, alone, 0.5)
        want = np.zeros(40, np.int64)
        for i in range(40):
            for j in range(40):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if i != j and (alone or side[i] != side[j]) and a and b and 2 * len(a & b) >= len(a | b):
                    want[i] += copies[j]
                    assert root[i] == root[j]
        assert weight.tolist() == want.tolist()
