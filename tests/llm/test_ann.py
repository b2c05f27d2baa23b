import numpy as np
import pytest
from pyspark.sql import functions as F

from mendwork.llm import ann


def brute(vectors, queries, k):
    out = {}
    for q in queries:
        scored = sorted((-(float((np.array(v) * np.array(vectors[q])).sum())), i) for i, v in vectors.items() if i != q)
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_traversal_is_in_falling_order_and_complete():
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=7), rng.normal(size=5)
    counts = np.ones(35, int)
    seen = [c for c, _ in ann.traverse(a, b, counts)]
    scores = [a[c // 5] + b[c % 5] for c in seen]
    assert sorted(seen) == list(range(35)) and scores == sorted(scores, reverse=True)


@pytest.mark.parametrize("shard_rows", [4096, 16])
def test_recall_and_scores(spark, shard_rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 10))
    vectors = {i: [float(x) for x in (centres[i % 12] + rng.normal(size=10) * 0.6)] for i in range(900)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>").repartition(4)
    rows = ann.search(df, F.col("vec_id") % 20 == 0, k=20, shard_rows=shard_rows).collect()
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 20)
    found = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(found) == set(want) and all(len(f) == 20 for f in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, near in found.items():
        for i, s in near:
            assert s == pytest.approx(float(np.dot(vectors[i], vectors[q])), abs=1e-12)


def test_unusable_vectors_ties_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (5, [0.5, 0.5]), (3, [0.5, 0.5]), (4, None), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]),
            (8, [None, 1.0]), (9, [float("inf"), 1.0]), (10, [1.0]), (None, [1.0, 1.0]), (20, [2.0, 0.0]), (40, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit("own")).withColumn("vector", F.lit(0))
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 2.0), (0, 2, 3, 0.5), (0, 3, 5, 0.5), (20, 1, 0, 2.0), (20, 2, 3, 1.0), (20, 3, 5, 1.0)]
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_many_equal_vectors(spark):
    df = spark.range(400).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(0.6), F.lit(0.8), F.lit(0.0))).otherwise(F.array(F.rand(1), F.rand(2), F.rand(3))).alias("embedding"))
    rows = ann.search(df, F.col("vec_id") == 0, k=5, shard_rows=32).orderBy("rank").collect()
    vectors = {r["vec_id"]: r["embedding"] for r in df.collect()}
    assert [r["vec_id"] for r in rows] == [i for i, _ in brute(vectors, [0], 5)[0]]


def test_queries_of_a_length_the_table_does_not_have(spark):
    rows = [(i, [float(i + 1), 1.0, 0.5, float(-i)]) for i in range(12)] + [(20 + i, [1.0, 2.0]) for i in range(3)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = ann.search(vectors, F.col("vec_id").isin(0, 20, 21, 22), k=3).collect()
    assert {r["query_id"] for r in found} == {0} and len(found) == 3
