import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendwork.llm import codes


def brute(vectors, parts, entries, rounds):
    """All distances to all entries in Python's whole numbers; ``vectors`` are (id, vector) in id order."""
    whole = [[int(np.floor(1024 * float(x))) for x in v] for _, v in vectors]
    cuts = np.array_split(np.arange(len(whole[0])), parts)
    out, error, books = [[] for _ in whole], [0] * len(whole), []
    for cut in cuts:
        rows = [[w[i] for i in cut] for w in whole]
        book = [list(r) for r in rows[:entries]]
        for turn in range(rounds + 1):
            dist = [[sum((a - b) ** 2 for a, b in zip(r, e)) for e in book] for r in rows]
            own = [d.index(min(d)) for d in dist]
            if turn == rounds:
                break
            for j in range(len(book)):
                mine = [r for r, o in zip(rows, own) if o == j]
                if mine:
                    book[j] = [sum(col) // len(mine) for col in zip(*mine)]
        books.append(book)
        for i, (o, d) in enumerate(zip(own, dist)):
            out[i].append(o)
            error[i] += d[o]
    text = ",".join(str(v) for book in books for e in book for v in e)
    return out, error, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("entries,first_list,spread", [(16, 4, 0.05), (16, 16, 1.0), (40, 5, 0.3), (1, 1, 0.3)])
def test_same_as_all_distances(spark, entries, first_list, spread):
    rng = np.random.default_rng(entries)
    centres = rng.normal(size=(9, 10))
    rows = [(int(i), [float(x) for x in (centres[i % 9] + rng.normal(size=10) * spread)], int(i % 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    coded = codes.compress(df, entries=entries, first_list=first_list)
    want, error, digest = brute([(i, v) for i, v, _ in rows], 4, entries, 4)
    got = codes.with_label_error(coded.rows).orderBy("vec_id").collect()
    assert [list(r["code"]) for r in got] == want and [r["error"] for r in got] == error
    assert codes.books_digest(coded.books) == digest
    by_label = {k: sum(e for i, e in enumerate(error) if i % 4 == k) for k in range(4)}
    assert all(r["label_error"] == by_label[r["label"]] for r in got)


def test_bounds_spare_most_full_comparisons(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(64, 16))
    rows = [(i, [float(x) for x in (centres[i % 64] + rng.normal(size=16) * 0.02)]) for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("label", F.lit(None).cast("int"))
    coded = codes.compress(df, entries=64, first_list=16)
    assert coded.full[0] == 1.0 and max(coded.full[1:]) < 0.2 and coded.lists[-1] < 16


def test_bounds_hold_after_every_move():
    rng = np.random.default_rng(8)
    x, book = rng.integers(-800, 800, (500, 8)), rng.integers(-800, 800, (48, 8))
    known, _ = codes.compare_all(x, book, 12)
    b = 12
    for b in (12, 6, 20, 5, 12):
        moved = book + rng.integers(-25, 26, book.shape)
        known, best, _ = codes.assign(x, moved, known, codes._above(np.sqrt(((moved - book) ** 2).sum(1))), b)
        book = moved
        exact = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (known.near[:, 0] == exact.argmin(1)).all() and (best == exact.min(1)).all()
        assert known.near.shape[1] == b
        listed = np.take_along_axis(exact, known.near, 1)
        assert (np.where(np.isfinite(known.low), known.low, 0) <= np.sqrt(listed)).all()
        others = exact.astype(float)
        np.put_along_axis(others, known.near, np.inf, 1)
        assert (known.outer <= np.sqrt(others.min(1))).all()


def test_odd_rows(spark):
    rows = [(3, [1.0, 2.0, 3.0, 4.0], 1), (1, None, 1), (2, [1.0, None, 3.0, 4.0], 1), (4, [float("nan")] * 4, 1), (5, [float("inf"), 0.0, 0.0, 0.0], 1),
            (6, [], 1), (7, [1.0], 1), (3, [1.0, 2.0, 3.0, 4.0], 1), (None, [9.0, 9.0, 9.0, 9.0], None), (8, [1e30, -1e30, 0.5, -0.00001], None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    for name in ("near", "low", "outer", "vector", "code", "error", "part"):
        df = df.withColumn(name, F.lit("own"))
    coded = codes.compress(df, entries=3, rounds=0)
    got = sorted((r["vec_id"] is None, r["vec_id"], list(r["code"]), r["error"]) for r in coded.rows.collect())
    limit = codes.LIMIT
    far = [(limit - 1024) ** 2, (limit + 2048) ** 2, (512 - 3072) ** 2, (-1 - 4096) ** 2]
    # The two equal rows come first, then id 8; the row without an id is no entry.
    assert got[0] == got[1] == (False, 3, [0, 0, 0, 0], 0) and got[2] == (False, 8, [2, 2, 2, 2], 0)
    assert got[3][2] == [0, 0, 0, 0] and len(got) == 4 and all(v > 0 for v in far)
    summed = codes.with_label_error(coded.rows).where("label is null").select("label_error").distinct().collect()
    assert len(summed) == 1
    none = codes.compress(df.limit(0))
    assert none.rows.count() == 0 and codes.with_label_error(none.rows).count() == 0
    uneven = codes.compress(spark.createDataFrame([(i, [float(i)] * 6, 0) for i in range(9)], "vec_id bigint, embedding array<float>, label int"), entries=9)
    assert [b.shape[1] for b in uneven.books] == [2, 2, 1, 1] and uneven.rows.agg(F.sum("error")).first()[0] == 0
