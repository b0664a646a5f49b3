"""What the training-data operators leave on the driver and in the session."""

import random

import pytest
from pyspark.sql import functions as F

from larkspar.llm import exact_dedup, ngram_jaccard
from larkspar.llm._common import brief_plans, components, written


def executions(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return spark._jsparkSession.sharedState().statusStore().executionsCount()


def least_reached(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    root = {}
    for v in sorted(near):
        todo = [] if v in root else [v]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = v
                todo += near[x]
    return {v: r for v, r in root.items() if v != r}


@pytest.mark.parametrize("local_edges", [0, 40, 500_000])
def test_components_however_they_end(spark, local_edges):
    rnd = random.Random(3)
    edges = [(rnd.randint(-99, 300), rnd.randint(-99, 300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2001 + k) for k in range(60)] + [(7, 7), (-(1 << 63), 1 << 62)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = [tuple(r) for r in components(df, local_edges).select("id", "root").collect()]
    assert len(got) == len(set(got)) and dict(got) == least_reached(edges)
    assert components(df.limit(0), local_edges).count() == 0


def test_few_edges_take_few_executions(spark):
    df = written(spark.range(3_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    before = executions(spark)
    found = components(df)
    assert executions(spark) - before <= 6
    assert (found.count(), found.where("root = 0").count()) == (3_000, 3_000)


def test_filter_is_planned_once(spark):
    df = spark.createDataFrame([(k, f"t{k % 7}") for k in range(20)], "doc_id long, text string")
    assert exact_dedup.deduplicate(df)._jdf.queryExecution().optimizedPlan().toString().count("bitmap_construct_agg") == 0
    assert {r.doc_id for r in exact_dedup.deduplicate(df).collect()} == set(range(13, 20))


def test_plans_of_others_stay_whole(spark):
    key = "spark.sql.maxPlanStringLength"
    assert spark.conf.get(key, None) is None
    df = spark.createDataFrame([(k, f"a b c d e f{k % 2}") for k in range(4)], "doc_id long, text string")
    assert ngram_jaccard.similar_groups(df).count() == 4
    assert spark.conf.get(key, None) is None
    with pytest.raises(ValueError), brief_plans(spark):
        assert spark.conf.get(key) == "4096"
        raise ValueError
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "9000")
    try:
        with brief_plans(spark):
            assert spark.conf.get(key) == "9000"
        assert spark.conf.get(key) == "9000"
    finally:
        spark.conf.unset(key)
