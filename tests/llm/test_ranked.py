import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendwork.llm import ranked

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall(text.translate(FOLD)) if text is not None else []


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 25 + 75 * c.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def invented(rng, n, words, vocabulary=400):
    p = 1 / np.arange(1, vocabulary + 1)
    return [" ".join(f"Word{w}" for w in rng.choice(vocabulary, size=rng.integers(1, words), p=p / p.sum())) for _ in range(n)]


@pytest.mark.parametrize("shard_postings,block_items", [(1 << 19, 256), (600, 7)])
def test_same_as_all_scores(spark, shard_postings, block_items):
    rng = np.random.default_rng(2)
    docs = list(enumerate(invented(rng, 500, 60)))
    docs += [(1000 + i, docs[i % 7][1]) for i in range(60)] + [(3, docs[3][1]), (3, docs[3][1])]
    items = list(enumerate(invented(rng, 30, 25)))
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    q = spark.createDataFrame(items, "item_id bigint, text string")
    got = ranked.search(d, q, shard_postings=shard_postings, block_items=block_items).collect()
    assert sorted(map(tuple, got)) == brute(docs, items, 10)


def coordinates(rows):
    flat = [(m, c, v) for m, row in enumerate(rows) for c, v in enumerate(row) if v]
    return tuple(np.array(x, np.int64) for x in zip(*flat))


def test_bounds_prune_whole_batches_and_lose_nothing():
    rng = np.random.default_rng(4)
    # Items of one topic each; documents of a topic hold its terms, and many hold common ones.
    items = [[int(rng.integers(1, 9)) if c // 10 == t % 20 else 0 for c in range(200)] for t in range(60)]
    docs = [[int(rng.integers(1, 100)) if c // 10 == t % 20 and rng.random() < 0.5 else int(rng.random() < 0.02) for c in range(200)] for t in range(4000)]
    ids = rng.permutation(4000)
    exact = np.array(items) @ np.array(docs).T
    best, scored = ranked.search_block(coordinates(items), coordinates(docs), np.zeros(60, np.int64), ids, 10)
    for i, found in enumerate(best):
        top = np.lexsort((ids, -exact[i]))[:10]
        assert found == [(int(exact[i, d]), int(d)) for d in top]
    assert scored < exact.size / 4
    floors = np.array([f[-1][0] for f in best])
    again, fewer = ranked.search_block(coordinates(items), coordinates(docs), floors, ids, 10)
    assert again == best and fewer <= scored


def test_sums_beyond_doubles_stay_exact():
    items, docs = [[1 << 33, (1 << 33) + 1]], [[1 << 21, 1 << 21], [(1 << 21) + 1, (1 << 21) - 1], [1 << 20, 0]]
    exact = [sum(a * b for a, b in zip(items[0], d)) for d in docs]
    best, _ = ranked.search_block(coordinates(items), coordinates(docs), np.zeros(1, np.int64), np.arange(3), 3)
    assert best[0] == sorted(((s, i) for i, s in enumerate(exact)), reverse=True)


def test_slots_hold_every_term(spark):
    words = [f"t{i}" for i in range(3000)]
    bits = np.unpackbits(np.frombuffer(ranked._slots(spark.createDataFrame([(w,) for w in words], "term string")), np.uint8), bitorder="little")
    assert len(bits) == ranked.SLOTS
    assert set(np.flatnonzero(bits)) == {zlib.crc32(w.encode()) & (ranked.SLOTS - 1) for w in words}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    items = [(1, "The SAME short-line of text, text"), (1, "The SAME short-line of text, text"), (2, None), (3, ""), (4, "?!"), (None, "12 34"), (5, "é日本 日本語"), (6, "nowhere")]
    q = spark.createDataFrame(items, "item_id bigint, text string").withColumn("rank", F.lit("own")).withColumn("term", F.lit(1))
    got = ranked.search(odd_docs.withColumn("row", F.lit(0)), q)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(rows, [items[0]], 10) + brute(rows, [items[5]], 10) + brute(rows, [items[6]], 10), key=str)
    assert ranked.search(no_docs, q).count() == 0 and ranked.search(odd_docs, q.limit(0)).count() == 0
