import random

from pyspark.sql import functions as F

from larkspar.operators import batching, ordering


def test_numbers_groups_over_many_tasks(spark):
    rows = [(None if k % 7 == 0 else "hot" if k % 3 else f"g{k % 5}", k, (k * 37) % 11) for k in range(600)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    got = ordering.numbered(df.repartition(13), ["g"], [F.desc("v"), "k"], "n").collect()
    groups = {}
    for g, k, v in rows:
        groups.setdefault(g, []).append((-v, k))
    want = {k: n for own in groups.values() for n, (_, k) in enumerate(sorted(own), 1)}
    assert {r.k: r.n for r in got} == want and len(got) == len(rows)
    assert {r.k: r.n for r in ordering.numbered(df, [], ["k"], "n").collect()} == {k: k + 1 for k in range(600)}
    assert ordering.numbered(df.limit(0), ["g"], ["k"]).columns == ["g", "k", "v", "rank"] and not ordering.numbered(df.limit(0), ["g"], ["k"]).count()


def test_batches_do_not_depend_on_blocks(spark):
    rnd = random.Random(5)
    rows = [(g, k, None if rnd.random() < 0.05 else rnd.choice([1, 5, 20, 90, 250])) for g, n in (("a", 333), ("b", 1), ("c", 28), (None, 64)) for k in range(n)]
    df = spark.createDataFrame(rows, "g string, k long, size long")
    want = {}
    for group in {g for g, _, _ in rows}:
        batch, n, used = -1, 0, 0
        for g, k, size in rows:
            if g == group:
                size = size or 0
                if not n or n + 1 > 6 or used + size > 100:
                    batch, n, used = batch + 1, 0, 0
                n, used = n + 1, used + size
                want[g, str(k)] = batch
    for block in (6, 7, 32, 1000):
        got = {(r.g, r.k): r.batch for r in batching.packed(df, "g", "k", "size", 6, 100, block).collect()}
        assert got == want, block
