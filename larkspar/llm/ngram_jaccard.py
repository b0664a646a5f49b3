"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles; two documents are linked when the Jaccard similarity of
their sets is 0.8 or more. Each set is embedded into SIZE min-hash tokens, so that similarity becomes the
share of equal tokens. A run sends a set down every token that a hash of (run, path, token) chooses, 1 / 0.8
tokens on average: pairs at the threshold go on meeting as often as not, less similar ones part. A path
with few sets is a bucket for brute force; a path with many is split by another step, as deep as it takes.
RUNS independent runs bring the recall of a pair at the threshold over TARGET_RECALL if its paths are split
to DEPTH; sets whose paths went deeper get more runs, until the depth they reached gives that recall too.

What keeps a group of any size linear: a first look at CONTRACTING runs joins the sets of one bucket that agree
enough (each with the bucket's pivot where it is large) and names each set by its component's root. From then on
buckets that hold one root are dropped, and a large bucket whose sets, but for STRAYS at most, share a root is settled
at once: the strays are compared with every set of the bucket, in blocks. Only large buckets of many roots are split.

Buckets only propose: joined sets are loose components (a task emits a spanning forest of roots, never pairs).
Within a loose component every pair is then compared exactly, on whole shingle sets, block against block, blocks
being bounded by bytes, so a component of any size is dealt over many tasks and each task holds two blocks. Links
are counted there and only one edge a member leaves a task. Copies (equal texts) are one set with a weight.

Defined results: a null text is empty; a text of one to four words is one shingle; texts without words are
linked to their exact copies only; a row is classed by its own text, so rows that share an id (or have none)
but not a text are compared each, and the id is a label only; a class is named by the least id reached over
links, null if no text in it has one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _vec
from ._common import BROADCAST_ROWS, bounded, components, forest, fresh, hot_salted, id_text, keyed_join, quoted, text_key, with_first, written
from ._vec import roots

WORDS = 5
SIMILARITY = 0.8
SIZE = 64
BUCKET = 256
DEPTH = 4
TARGET_RECALL = 0.995
LOOSE = 0.64  # three standard deviations of 64 tokens below the threshold
FAR = SIZE - math.ceil(LOOSE * SIZE)  # unequal tokens of a proposed pair, at most
CONTRACTING = 4
STRAYS = 2_048
SETTLING = 2_048  # sets of a large bucket that strays are compared with in one task
BLOCK_BYTES = 4 << 20  # of shingle sets
BLOCK = 4_096  # sets
TILE = 512
_U = np.uint64
_SEEDS = _vec.mix(np.arange(1, 2 * SIZE + 1, dtype=_U))
_A, _B = _SEEDS[:SIZE] | _U(1), _SEEDS[SIZE:]


def meeting_probability(depth: int, similarity: float = SIMILARITY, size: int = SIZE) -> float:
    """Least chance that a pair at the threshold still shares a path after so many steps."""
    shared, chosen = round(similarity * size), 1 / (similarity * size)
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - chosen * p) ** shared
    return p


def runs_for(depth: int) -> int:
    return math.ceil(math.log(1 - TARGET_RECALL) / math.log(1 - meeting_probability(depth)))


RUNS = runs_for(DEPTH)


def shingle_hashes(buf: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of all shingles; a shorter text is one shingle of all its words."""
    start, end, rows = _vec.word_bounds(buf, offsets)
    h = _vec.span_hashes(buf, start, end)
    found, first = _vec.window_hashes(h, rows, words)
    owner = rows[first]
    n = np.bincount(rows, minlength=len(offsets) - 1) if len(rows) else np.zeros(len(offsets) - 1, np.int64)
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        at = np.searchsorted(rows, short)
        extra = np.array([_vec.mix(np.array([sum((int(x) * (k + 3) << k) for k, x in enumerate(h[a : a + m])) & (2**64 - 1)], _U))[0]
                          for a, m in zip(at.tolist(), n[short].tolist())], _U)
        found, owner = np.concatenate([found, extra]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return found, owner


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, buf, offsets in _vec.slices(batch.column(1)):
            found, owner = shingle_hashes(buf, offsets)
            has, at = np.unique(owner, return_index=True)
            if not len(has):
                continue
            tokens = np.empty((len(has), SIZE), np.uint32)
            for k in range(SIZE):
                tokens[:, k] = np.minimum.reduceat((found * _A[k] + _B[k]) >> _U(32), at).astype(np.uint32)
            blobs = [[t.tobytes() for t in x] for x in (tokens, tokens.astype(np.uint8))]
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j].take(pa.array(has)), *(pa.array(x, pa.binary()) for x in blobs)], ["id", "tokens", "brief"])


def _step(paths: np.ndarray, tokens: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and new paths of the tokens chosen after each path."""
    limit = _U(int(2**64 / (similarity * SIZE)))
    rows, out = [], []
    for k in range(SIZE):
        h = _vec.mix(paths ^ (tokens[:, k].astype(_U) * _A[k] + _B[k]))
        hit = np.flatnonzero(_vec.mix(h) < limit)
        rows.append(hit)
        out.append(h[hit])
    return np.concatenate(rows), np.concatenate(out)


def _matrix(column: pa.Array, kind=np.uint32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, SIZE)


def _first_step(runs: list[int], similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            tokens = _matrix(batch.column("tokens"))
            for r in runs:
                rows, paths = _step(np.full(len(tokens), _vec.mix(np.array([r + 1], _U))[0]), tokens, similarity)
                rows = pa.array(rows)
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), batch.column("id").take(rows), batch.column("root").take(rows)], ["path", "id", "root"])

    return run


def _next_step(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows, paths = _step(np.array(batch.column("path")).view(_U), _matrix(batch.column("tokens")), similarity)
            rows = pa.array(rows)
            yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), batch.column("id").take(rows), batch.column("root").take(rows)], ["path", "id", "root"])

    return run


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches sorted by key; a group is never cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = np.array(batch.column(key))
        before = np.flatnonzero(keys != keys[-1])
        cut = int(before[-1]) + 1 if len(before) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _forest(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """A spanning forest of the edges (a, b)."""
    return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(a, b)], ["a", "b"])


def _proposals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brute force in buckets sorted by path: a forest of the roots whose sets agree enough."""
    for table in _grouped(batches, "path"):
        path, root = np.array(table.column("path")), np.array(table.column("root"))
        tokens = _matrix(table.column("brief"), np.uint8)
        pairs_a, pairs_b, d = [], [], 1
        same = np.flatnonzero(path[d:] == path[:-d])
        while len(same):
            same = same[root[same] != root[same + d]]
            for lot in np.array_split(same, len(same) // 100_000 + 1):
                near = lot[(tokens[lot] == tokens[lot + d]).sum(1) >= SIZE - FAR]
                pairs_a.append(root[near])
                pairs_b.append(root[near + d])
            d += 1
            same = np.flatnonzero(path[d:] == path[:-d])
        if pairs_a and (a := np.concatenate(pairs_a)).size:
            yield _forest(a, np.concatenate(pairs_b))


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between the roots of sets and of their bucket's pivot, where these agree enough."""
    for batch in batches:
        if not len(batch):
            continue
        far = (_matrix(batch.column("brief"), np.uint8) != _matrix(batch.column("pivot"), np.uint8)).sum(1)
        near = pa.array(far <= FAR)
        yield pa.RecordBatch.from_arrays([batch.column("root").filter(near), batch.column("pivot_root").filter(near)], ["a", "b"])


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest of the roots whose sets agree enough, strays against all sets of their block."""
    for table in _grouped(batches, "key"):
        key, root, stray = (np.array(table.column(c)) for c in ("key", "root", "stray"))
        tokens = _matrix(table.column("brief"), np.uint8)
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        pairs = []
        for low, high in zip(cut[:-1].tolist(), cut[1:].tolist()):
            for k in np.flatnonzero(stray[low:high]).tolist():
                near = np.flatnonzero((tokens[low:high] == tokens[low + k]).sum(1) >= SIZE - FAR)
                near = np.unique(root[low:high][near])
                pairs.append((near, np.full(len(near), root[low + k])))
        if pairs:
            a, b = (np.concatenate(x) for x in zip(*pairs))
            if (a != b).any():
                yield _forest(a[a != b], b[a != b])


def _blocked(rows: DataFrame, group: str, blocks: str) -> DataFrame:
    """rows once for every pair of blocks of its group that its own block is in; column key names the pair."""
    rows = rows.withColumn("_lk_b", F.pmod(F.xxhash64("id"), F.col(blocks)).cast("int"))
    rows = rows.withColumn("_lk_o", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
    low, high = F.least("_lk_b", "_lk_o"), F.greatest("_lk_b", "_lk_o")
    return (rows.withColumn("key", F.xxhash64(group, low, high)).withColumn("side", F.col("_lk_b") == low)
            .withColumn("alone", low == high).drop("_lk_b", "_lk_o"))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, buf, offsets in _vec.slices(batch.column("text")):
            found, owner = shingle_hashes(buf, offsets)
            at = np.searchsorted(owner, np.arange(j - i + 1)).tolist()
            blobs = [np.unique(found[a:b]).tobytes() for a, b in zip(at, at[1:])]
            part = batch.slice(i, j - i)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("root"), part.column("copies"), pa.array(blobs, pa.binary())],
                                             ["id", "root", "copies", "shingles"])


def _hits(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of a left and a right set reach the threshold exactly."""
    sizes = [np.array([len(s) for s in x], np.int64) for x in (left, right)]
    values = [np.concatenate(x) for x in (left, right)]
    rows = [np.repeat(np.arange(len(x)), n) for x, n in zip((left, right), sizes)]
    common = np.intersect1d(*(np.unique(v) for v in values), assume_unique=True)
    inter = np.zeros((len(left), len(right)), np.float32)
    if len(common):
        for k in (0, 1):  # only what both sides have can count; sorted by column
            at = np.minimum(np.searchsorted(common, values[k]), len(common) - 1)
            held = np.flatnonzero(common[at] == values[k])
            held = held[np.argsort(at[held], kind="stable")]
            values[k], rows[k] = at[held], rows[k][held]
        width = 4_096
        for low in range(0, len(common), width):
            dense = []
            for k, x in enumerate((left, right)):
                a, b = np.searchsorted(values[k], [low, low + width])
                d = np.zeros((len(x), min(width, len(common) - low)), np.float32)
                d[rows[k][a:b], values[k][a:b] - low] = 1
                dense.append(d)
            inter += dense[0] @ dense[1].T
    inter = inter.astype(np.int64)
    union = sizes[0][:, None] + sizes[1][None, :] - inter
    # five decimals of the threshold, in whole numbers
    return (inter * 100_000 >= round(similarity * 100_000) * union) & (sizes[0] > 0)[:, None] & (sizes[1] > 0)[None, :]


def linked(sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray, alone: bool, similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """For each set the weight of its links and the least set it is connected to: across the sides, or within one block."""
    m = len(sets)
    weight, root = np.zeros(m, np.int64), np.arange(m)
    halves = (np.arange(m), np.arange(m)) if alone else (np.flatnonzero(side), np.flatnonzero(~side))
    tiles = [[h[i : i + TILE] for i in range(0, len(h), TILE)] for h in halves]
    for i, left in enumerate(tiles[0]):
        for j, right in enumerate(tiles[1]):
            if alone and j < i:
                continue
            hit = _hits([sets[k] for k in left], [sets[k] for k in right], similarity)
            own = alone and i == j
            if own:
                np.fill_diagonal(hit, False)
            weight[left] += hit @ copies[right]
            if not own:
                weight[right] += copies[left] @ hit
            a, b = np.nonzero(hit & (root[left][:, None] != root[right][None, :]))
            if len(a):
                root = roots(m, np.concatenate([np.arange(m), left[a]]), np.concatenate([root, right[b]]))
    return weight, root


def _exact(similarity: float):
    """For each member of a block pair: one edge (or none) and the weight of its links there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "key"):
            key, ids = np.array(table.column("key")), np.array(table.column("id"))
            side, alone = np.array(table.column("side")), np.array(table.column("alone"))
            copies, blobs = np.array(table.column("copies")), table.column("shingles").to_pylist()
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            out = []
            for low, high in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if high - low < 2:
                    continue
                weight, root = linked([np.frombuffer(x, _U) for x in blobs[low:high]], copies[low:high], side[low:high], bool(alone[low]), similarity)
                some = np.flatnonzero(weight)
                out.append((ids[low:high][some], ids[low:high][root[some]], weight[some]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b", "links"])

    return run


_SKETCH = "id long, tokens binary, brief binary"
_FRONTIER = "path long, id long, root long"
_TOKENS_BROADCAST = 400_000  # rows of an id and 64 bytes
_PIVOTS_BROADCAST = 100_000


def _bucketed(frontier: DataFrame) -> DataFrame:
    """Rows of the paths on which several roots meet, with the path's number of rows."""
    paths = written(frontier.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("path", "n"))
    left, right = hot_salted(frontier, paths, "path", "n", "id")
    return written(left.join(right, ["path", "_lk_salt"]).drop("_lk_salt"))


def _to_pivots(big: DataFrame) -> DataFrame:
    """Edges (a, b) from the sets of large buckets to one set of their bucket."""
    pivots = written(big.groupBy("path").agg(F.min(F.struct(F.xxhash64("path", "id").alias("h"), "root", "brief")).alias("p"), F.first("n").alias("n"))
                     .select("path", "n", F.col("p.root").alias("pivot_root"), F.col("p.brief").alias("pivot")))
    held = keyed_join(big.drop("n"), pivots, "path", "n", "id", _PIVOTS_BROADCAST)
    return held.where("root != pivot_root").select("root", "brief", "pivot_root", "pivot").mapInArrow(_distances, "a long, b long").distinct()


def _dominated(big: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of large buckets that are to be settled, dealt to blocks (key, root, stray, brief), and of those to be split."""
    counts = big.groupBy("path", "root").agg(F.count(F.lit(1)).alias("m"))
    heads = written(counts.groupBy("path").agg(F.max(F.struct("m", "root")).alias("h"), F.sum("m").alias("n")).select("path", "n", F.col("h.root").alias("head"), (F.col("n") - F.col("h.m")).alias("strays")))
    rows = keyed_join(big.drop("n"), heads.withColumn("blocks", F.ceil(F.col("n") / SETTLING).cast("int")), "path", "n", "id", BROADCAST_ROWS)
    stray = F.col("root") != F.col("head")
    settle = rows.where(F.col("strays") <= STRAYS).withColumn("stray", stray)
    block = F.when(stray, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    settle = settle.withColumn("block", F.explode(block)).select(F.xxhash64("path", "block").alias("key"), "root", "stray", "brief")
    return settle, rows.where(F.col("strays") > STRAYS).select("path", "id", "root")


def _wave(sketches: DataFrame, runs: list[int], similarity: float, split: bool = True) -> tuple[DataFrame, DataFrame | None, int]:
    """Edges (a, b) between roots proposed by the buckets of these runs, ids whose paths went below DEPTH, and the depth reached."""
    brief = bounded(sketches.select("id", "brief"), _TOKENS_BROADCAST)
    frontier = written(sketches.mapInArrow(_first_step(runs, similarity), _FRONTIER))
    found, deep, depth = [], None, 1
    while True:
        rows = _bucketed(frontier)
        small = rows.where(F.col("n") <= BUCKET).drop("n").join(brief, "id")
        found.append(written(small.select("path", "root", "brief").repartition("path").sortWithinPartitions("path").mapInArrow(_proposals, "a long, b long")))
        big = rows.where(F.col("n") > BUCKET)
        if not big.limit(1).count():
            break
        big = big.repartition("id", "path").join(brief, "id")
        if not split:
            found.append(written(_to_pivots(big)))
            break
        settle, on = _dominated(big)
        found.append(written(settle.repartition("key").sortWithinPartitions("key").mapInArrow(_settled, "a long, b long")))
        on = written(on)
        if not on.limit(1).count():
            break
        if depth >= DEPTH:
            ids = written(on.select("id").distinct())
            deep = ids if deep is None else deep.unionByName(ids)
        frontier = written(on.join(sketches.select("id", "tokens"), "id").mapInArrow(_next_step(similarity), _FRONTIER))
        depth += 1
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges, deep, depth


def loose_components(sketches: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(id, root) of the sets (id, tokens) that buckets join to others, from enough runs for the target recall."""
    def rooted(rows: DataFrame, known: DataFrame) -> DataFrame:
        return written(rows.join(bounded(known), "id", "left").withColumn("root", F.coalesce("root", "id")))

    edges, _, _ = _wave(sketches.withColumn("root", F.col("id")), [1 << 20 | r for r in range(CONTRACTING)], similarity, split=False)
    joined = components(edges)
    done, need, some = 0, RUNS, sketches
    while done < need:
        edges, deep, depth = _wave(rooted(some, joined), list(range(done, need)), similarity)
        joined = components(edges.unionByName(joined.select(F.col("id").alias("a"), F.col("root").alias("b"))))
        done = need
        if deep is not None:  # only pairs of these sets may have met too seldom
            need, some = max(need, runs_for(depth)), sketches.join(bounded(deep.distinct()), "id", "left_semi")
    return joined


def keyed(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """with_first(rows) plus key, a number no other text has, and the texts (key, first) whose key is not `first`.

    The key is the least id of the text where no other text has that id; the others are numbered above all ids.
    """
    held = with_first(rows)
    shared = written(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("first")))
    if not shared.limit(1).count():
        return held.withColumn("key", F.col("first")), None
    texts = held.select("_lk_k1", "_lk_k2", "first").distinct()
    least = rows.agg(F.max("doc_id")).first()[0]
    least = 0 if least is None else max(least + 1, 0)
    if least < 1 << 62:
        texts = texts.where("first is null").unionByName(texts.join(bounded(shared), "first", "left_semi"))
    else:  # no room above the ids: every text is numbered
        least = 0
    odd = written(texts.withColumn("_lk_key", F.monotonically_increasing_id() + F.lit(least).cast("long")))
    held = held.join(bounded(odd.drop("first")), ["_lk_k1", "_lk_k2"], "left").withColumn("key", F.coalesce("_lk_key", "first")).drop("_lk_key")
    return held, odd.select(F.col("_lk_key").alias("key"), "first")


def named(classes: DataFrame, odd: DataFrame | None) -> DataFrame:
    """classes (key, root), roots included, plus label: the least id of any text of the class."""
    if odd is None:
        return classes.withColumn("label", F.col("root"))
    classes = written(classes)
    firsts = classes.join(bounded(odd.withColumn("_lk_odd", F.lit(True))), "key", "left")
    labels = firsts.groupBy("root").agg(F.min(F.when(F.col("_lk_odd"), F.col("first")).otherwise(F.col("key"))).alias("label"))
    return classes.join(bounded(written(labels)), "root")


def classes(df: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """similar_groups plus root (equal in one class only) and the text key, per row."""
    rows, odd = keyed(id_text(df, id_col, text_col))
    own = rows.where(F.col("first").eqNullSafe(F.col("doc_id")))
    sketches = written(own.select(F.col("key").alias("id"), "text").mapInArrow(_sketches, _SKETCH).dropDuplicates(["id"]))
    loose = loose_components(sketches, similarity)
    members = written(loose.unionByName(loose.select(F.col("root").alias("id"), "root").distinct()))
    text = own.select(F.col("key").alias("id"), "text", "copies").join(bounded(members), "id").dropDuplicates(["id"])
    sets = written(text.select("id", "root", "copies", "text").mapInArrow(_sets, "id long, root long, copies long, shingles binary"))
    blocks = F.greatest(F.ceil(F.sum(F.octet_length("shingles").cast("long")) / BLOCK_BYTES), F.ceil(F.count(F.lit(1)) / BLOCK), F.lit(1)).cast("int")
    size = written(sets.groupBy("root").agg(F.count(F.lit(1)).alias("n"), blocks.alias("blocks")))
    blocks = _blocked(keyed_join(sets, size, "root", "n", "id"), "root", "blocks")
    exact = written(blocks.select("key", "id", "side", "alone", "copies", "shingles").repartition("key").sortWithinPartitions("key")
                    .mapInArrow(_exact(similarity), "a long, b long, links long"))
    links = exact.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "key")
    joined = components(exact.select("a", "b")).withColumnRenamed("id", "key")
    joined = named(joined.unionByName(joined.select(F.col("root").alias("key"), "root").distinct()), odd)
    found = bounded(written(links.join(joined, "key", "left")))
    return (rows.select("doc_id", "key", "first", "copies", "_lk_k1", "_lk_k2").join(found, "key", "left")
            .select("doc_id", F.when(F.col("copies") + F.coalesce("links", F.lit(0)) > 1, F.coalesce("label", "first")).otherwise(F.col("doc_id")).alias("class_id"),
                    (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies", F.coalesce("root", "key").alias("root"), "_lk_k1", "_lk_k2"))


def similar_groups(df: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (least id reached over links), n_links (linked documents, copies included), copies per row."""
    return classes(df, similarity, id_col, text_col).select("doc_id", "class_id", "n_links", "copies")


def deduplicate(df: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the rows whose class has a text of lesser id, or of the same id and lesser text key; columns as they were.

    A row goes by its id and text, never by its id alone; a null id is never dropped.
    """
    linked = written(classes(df, similarity, id_col, text_col).where("doc_id is not null and n_links > 0").drop("n_links", "copies").distinct())
    stay = linked.where("doc_id = class_id").groupBy("root").agg(F.min(F.struct("_lk_k1", "_lk_k2")).alias("stay"))
    gone = linked.join(bounded(written(stay)), "root", "left").where(
        (F.col("doc_id") != F.col("class_id")) | (F.struct("_lk_k1", "_lk_k2") != F.col("stay")))
    gone = bounded(written(gone.select(F.col("doc_id").alias("_lk_id"), "_lk_k1", "_lk_k2")))
    a, b = fresh(df, "a", "b")
    k1, k2 = text_key(F.coalesce(F.col(quoted(text_col)), F.lit("")))
    held = df.withColumns({a: k1, b: k2})
    same = (held[quoted(id_col)].cast("long") == gone["_lk_id"]) & (held[a] == gone["_lk_k1"]) & (held[b] == gone["_lk_k2"])
    return held.join(gone, same, "left_anti").select(*[quoted(c) for c in df.columns])
