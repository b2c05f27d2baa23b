"""Bounded summaries whose results are exact: heavy hitters in two passes, and differences by digests."""

import random
from collections import Counter

from pyspark.sql import functions as F

from mendwork.operators import equivalence, workload


def skewed(spark, rows=20_000, values=6_000):
    rng = random.Random(1)
    drawn = [f"v{min(int(rng.paretovariate(0.7)), values)}" for _ in range(rows)] + [None] * 50
    return drawn, spark.createDataFrame([(d,) for d in drawn], "v string").repartition(5)


def test_summary_keeps_its_bound(spark):
    drawn, df = skewed(spark)
    true = Counter(d for d in drawn if d is not None)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        rows = workload.counter_summary(df, "v", counters=100).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    error = sum(r["error"] for r in rows if r["value"] is None)
    known = {r["value"]: r["at_least"] for r in rows if r["value"] is not None}
    assert 0 < error <= true.total() / 101 and len(true) > 5 * 100
    assert all(known.get(v, 0) <= n <= known.get(v, 0) + error for v, n in true.items())


def test_two_passes_equal_counting_everything(spark):
    drawn, df = skewed(spark)
    true = Counter(d for d in drawn if d is not None)
    want = sorted(true.items(), key=lambda t: (-t[1], t[0]))
    for n, counters in ((10, 300), (40, 300), (10, 5), (10_000, 300)):
        got = workload.heavy_hitters_two_pass(df, "v", n, counters)
        assert [tuple(r) for r in got.collect()] == want[:n]
    assert workload.heavy_hitters_two_pass(df.limit(0), "v", 3).count() == 0
    numbers = df.select(F.length("v").alias("v"))
    assert [tuple(r) for r in workload.heavy_hitters_two_pass(numbers, "v", 2).collect()] == [tuple(r) for r in workload.heavy_hitters(numbers, "v", 2).collect()]


def test_digests_find_the_same_differences(spark):
    a = spark.createDataFrame([(i % 50, None if i % 7 == 0 else f"x{i % 11}", float(i % 3)) for i in range(3000)], "k int, v string, d double")
    b = a.withColumn("v", F.when(F.col("k") == 13, F.lit("changed")).otherwise(F.col("v"))).unionByName(a.where("k = 4").limit(3))
    got = equivalence.multiset_diff_by_digest(a, b.select("d", "v", "k"), buckets=64)
    assert sorted(map(str, got.collect())) == sorted(map(str, equivalence.multiset_diff(a, b).collect())) and got.count() > 0
    assert equivalence.multiset_diff_by_digest(a, a.repartition(7)).count() == 0
    signed = a.withColumn("d", -F.col("d"))
    assert equivalence.multiset_diff_by_digest(a.where("d = 0"), signed.where("d = 0")).count() == 0


def test_equal_results_read_no_bucket(spark):
    a = spark.range(1000).withColumn("v", F.col("id") % 7)
    diff = equivalence.multiset_diff_by_digest(a, a.orderBy(F.col("id").desc()))
    diff.collect()
    assert diff.count() == 0
    digests = equivalence.bucket_digests(a, ["id", "v"], buckets=16).collect()
    assert len(digests) == 16 and sum(r["n"] for r in digests) == 1000
    assert sorted(map(tuple, digests)) == sorted(map(tuple, equivalence.bucket_digests(a.repartition(9), ["id", "v"], buckets=16).collect()))
