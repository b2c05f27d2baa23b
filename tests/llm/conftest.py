"""Odd rows that every operator must take: nulls, empty and long texts, repeats, clashing names."""

import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977} of the long text" for i in range(30_000))
TEXTS = [None, "", "   \n\t ", "12 !? 34", "The same short line.", "The same short line.", LONG, LONG + " end", "é" * 200, "日本語 text"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, "The same short line.", None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("score", "fp", "size", "taken", "n_lines", "n_removed", "piece", "start", "key", "th", "before", "rejected", "stats"):
        docs = docs.withColumn(name, F.lit("own"))
    return docs


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
