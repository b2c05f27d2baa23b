import numpy as np
from pyspark.sql import functions as F

from mendwork.llm import language


def test_counts_do_not_depend_on_the_slices(monkeypatch):
    text = "Der schnelle Fuchs, 12 Hühner & Ähren. " * 20
    whole = language.ngram_counts(text)
    monkeypatch.setattr(language, "_SLICE", 7)
    assert (language.ngram_counts(text) == whole).all()
    assert language.ngram_counts("12 !?") is None and language.ngram_counts(None) is None


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.train(docs.where(~held))
    rows = language.identify(docs.where(held), model, "doc_id", "lang").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert not any(r["rejected"] for r in rows)
    strange = spark.createDataFrame([(1, "ᚠᚢᚦ" * 900), (2, "qzxj" * 3 + "".join(chr(0x4E00 + i) for i in range(3000)))], "doc_id bigint, text string")
    assert all(r["rejected"] for r in language.identify(strange, model, "doc_id").collect())


def test_odd_rows(spark, odd_docs, no_docs):
    model = language.train(odd_docs)
    rows = language.identify(odd_docs.drop("score", "rejected"), model, "doc_id", "text", "size").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert r["lang_pred"] == ("en" if letters else "und") and 0 <= r["score"] <= 1
        assert letters or (r["rejected"] and r["score"] == 0)
    empty = language.train(no_docs)
    assert empty.languages == []
    assert {r["lang_pred"] for r in language.identify(odd_docs.drop("score", "rejected"), empty, "doc_id").collect()} == {"und"}
    assert language.identify(no_docs.drop("score", "rejected"), model, "doc_id").count() == 0


def test_clusters_are_unit_and_few():
    rows = np.eye(6, dtype=np.float32)[[0, 0, 1, 1, 2]]
    centres = language.cluster(rows, 4)
    assert len(centres) <= 4 and np.allclose(np.linalg.norm(centres, axis=1), 1)
