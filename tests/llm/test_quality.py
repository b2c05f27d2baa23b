import numpy as np
from pyspark.sql import functions as F

from mendwork.llm import quality


def test_isotonic_against_projection():
    rng = np.random.default_rng(0)
    total = rng.integers(1, 9, 40).astype(float)
    good = np.array([rng.binomial(int(t), p) for t, p in zip(total, np.linspace(0.1, 0.9, 40))], float)
    got = quality.isotonic(good, total)
    assert (np.diff(got) >= -1e-12).all()
    share = good / total
    # Max over starts of the min over ends of block means is the closed form.
    want = [max(min(share[a : b + 1] @ total[a : b + 1] / total[a : b + 1].sum() for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert np.allclose(got, want)


def test_statistics_are_finite():
    for text in (None, "", " ", "\n\n", "!", "a", "ab " * 1000, "😀".encode("utf-16", "surrogatepass").decode("utf-16")):
        found = quality.statistics(text)
        assert found.shape == (len(quality.STATISTICS),) and np.isfinite(found).all()


def test_held_out_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    scored = quality.classify(docs, labels, ~held)
    assert scored.count() == docs.count()
    rows = scored.where("not learn").join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum((r["score"] >= 0.7) == (r["quality"] == 1) for r in rows) >= 0.9 * len(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (1, 0), (4, 1), (4, 1), (5, 0), (6, None), (None, 1)], "doc_id bigint, quality int")
    scored = quality.classify(odd_docs, labels, F.col("doc_id") >= 0).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert {r["score"] for r in quality.classify(odd_docs, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert quality.classify(no_docs, labels, F.lit(True)).count() == 0
