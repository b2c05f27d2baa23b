"""Nearest neighbours by inner product with an inverted multi-index.

Two halves of the vectors are quantised apart; a pair of centroids is a cell, and every vector is in the posting
list of its cell. A query scores the centroids of both halves, takes cells in falling order of the summed scores
from a heap until they hold enough vectors, and reranks what these cells hold by the exact product.

How many vectors are enough is not guessed: exact neighbours of a few queries, found by brute force over all rows,
tell how far the traversal must go to meet the wanted share of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mendwork.functions.durable import durable

# Bound of the sample that centroids are fitted on, and of the queries the traversal is measured with.
TRAIN_ROWS = 20_000
MEASURED_QUERIES = 64
CELL_ROWS = 50
SHARD_ROWS = 4096
QUERY_ROWS = 1024
RECALL = 0.97
SEED = 5


class Index(NamedTuple):
    """``first`` and ``second`` are the centroids of the halves; ``counts`` the rows of each cell; the rows of cell
    ``c`` are in shards ``shard[c]`` to ``shard[c] + spread[c] - 1``. All are bounded by the number of cells."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray
    shard: np.ndarray
    spread: np.ndarray

    def cells(self, rows: np.ndarray) -> np.ndarray:
        half = self.first.shape[1]
        return _nearest(rows[:, :half], self.first) * len(self.second) + _nearest(rows[:, half:], self.second)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)


def quantise(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of ``rows`` by k-means; not more than there are different rows."""
    different = np.unique(rows, axis=0)
    centres = different[np.random.default_rng(SEED).permutation(len(different))[:k]]
    for _ in range(rounds):
        own = _nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        count = np.bincount(own, minlength=len(centres))[:, None]
        centres = np.where(count > 0, sums / np.maximum(count, 1), centres)
    return centres


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """``(cell, rows)`` of all cells in falling order of the sum of their centroids' scores, empty ones left out.

    The heap holds the border of the pairs already seen in the two sorted score lists.
    """
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y, wide = first[a].tolist(), second[b].tolist(), len(second)
    left, right = a.tolist(), b.tolist()
    border = [(-(x[0] + y[0]), 0, 0)]
    while border:
        _, i, j = heapq.heappop(border)
        cell = left[i] * wide + right[j]
        if counts[cell]:
            yield cell, counts[cell]
        if j + 1 < len(y):
            heapq.heappush(border, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(border, (-(x[i + 1] + y[0]), i + 1, 0))


def _vectors(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _best(ids: np.ndarray, rows: np.ndarray, near: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of ``rows`` for one query: score falling, then id. ``near`` are products that may differ in the last
    bits between equal rows, so all within rounding of the k-th are scored again, each row by itself."""
    live = np.flatnonzero((ids != own) & (near > -np.inf))
    if len(live) > k:
        edge = np.partition(near[live], len(live) - k)[len(live) - k]
        live = live[near[live] >= edge - 1e-9 * max(1.0, abs(edge))]
    exact = (rows[live] * query).sum(axis=1)
    order = np.lexsort((ids[live], -exact))[:k]
    return live[order], exact[order]


def usable(vectors: DataFrame, vec_id: str, embedding: str, *others: str) -> DataFrame:
    """``vec_id``, ``vector`` (doubles) and ``others`` of rows whose vector is not null, has the commonest length, holds only finite
    numbers and is not zero, and whose id is not null."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"), *others)

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    finite = rows.where("vec_id is not null and vector is not null and size(vector) > 0")
    finite = finite.where(~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0))
    common = finite.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return finite.where(F.size("vector") == (common["n"] if common else 0))


def build(rows: DataFrame, *, train_rows: int = TRAIN_ROWS, cell_rows: int = CELL_ROWS, shard_rows: int = SHARD_ROWS) -> tuple[Index, DataFrame]:
    """The index of ``rows`` (``vec_id``, ``vector``) and its stored posting lists (with ``cell`` and ``shard``).

    Centroids, about ``sqrt(rows / cell_rows)`` and at most 1024 a half, are fitted on the ``train_rows`` rows with the
    smallest id hash; every row is indexed. Posting lists are packed into shards of about ``shard_rows``; a longer
    list is dealt over several shards by hash.
    """
    sample = _vectors(pa.array([r["vector"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(train_rows).select("vector").collect()], pa.list_(pa.float64())))
    k = int(np.clip(round(np.sqrt(rows.count() / cell_rows)), 4, 1024))
    half = (sample.shape[1] + 1) // 2
    empty = np.zeros(0, np.int64)
    index = Index(quantise(sample[:, :half], k), quantise(sample[:, half:], k), empty, empty, empty)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(index.cells(_vectors(batch.column(1))))], names=["vec_id", "vector", "cell"])

    placed = durable(rows.select("vec_id", "vector").mapInArrow(assign, "vec_id bigint, vector array<double>, cell bigint"))
    counts = np.zeros(len(index.first) * len(index.second), np.int64)
    for row in placed.groupBy("cell").count().collect():
        counts[row["cell"]] = row["count"]
    spread = np.maximum(-(-counts // shard_rows), 1)
    shard, at, held = np.zeros(len(counts), np.int64), 0, 0
    for cell, n in enumerate(counts.tolist()):
        if held and held + n > shard_rows:
            at, held = at + 1, 0
        shard[cell] = at
        held += n
        if spread[cell] > 1:
            at, held = at + int(spread[cell]), 0
    full = index._replace(counts=counts, shard=shard, spread=spread)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            turn = batch.column("turn").to_numpy() % full.spread[cell]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(full.shard[cell] + turn)], names=["vec_id", "vector", "cell", "shard"])

    turned = placed.withColumn("turn", F.pmod(F.xxhash64("vec_id", F.lit("turn")), F.lit(1 << 30)))
    return full, turned.mapInArrow(deal, "vec_id bigint, vector array<double>, cell bigint, shard bigint")


def measure_budget(index: Index, postings: DataFrame, queries: DataFrame, k: int, recall: float, most: int = MEASURED_QUERIES) -> int:
    """Rows a traversal must cover so that it meets a ``recall`` share of the true neighbours of ``most`` queries (smallest
    hash), which are compared with every row."""
    probes = queries.orderBy(F.xxhash64("vec_id", F.lit("probe")), "vec_id").limit(most).collect()
    if not probes:
        return 0
    own = [r["vec_id"] for r in probes]
    sought = np.array([r["vector"] for r in probes])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))] * len(own)
        for batch in batches:
            ids, cells, rows = batch.column(0).to_numpy(), batch.column(2).to_numpy(), _vectors(batch.column(1))
            near = sought @ rows.T
            for q, name in enumerate(own):
                live, exact = _best(ids, rows, near[q], sought[q], name, k)
                merged = [np.concatenate(x) for x in zip(held[q], (ids[live], exact, cells[live]))]
                order = np.lexsort((merged[0], -merged[1]))[:k]
                held[q] = tuple(m[order] for m in merged)
        for q, (ids, scores, cells) in enumerate(held):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q)), pa.array(ids), pa.array(scores), pa.array(cells)], names=["q", "vec_id", "score", "cell"])

    best = postings.select("vec_id", "vector", "cell").mapInArrow(scan, "q bigint, vec_id bigint, score double, cell bigint")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    true = best.withColumn("rank", rank).where(F.col("rank") <= k).select("q", "cell").collect()
    wanted: dict[int, list[int]] = {}
    for row in true:
        wanted.setdefault(row["q"], []).append(row["cell"])
    half, needed = index.first.shape[1], []
    for q, cells in wanted.items():
        seen, upto = 0, {}
        for cell, n in traverse(index.first @ sought[q, :half], index.second @ sought[q, half:], index.counts):
            seen += int(n)
            upto[cell] = seen
        needed += [upto[c] for c in cells]
    return int(np.quantile(needed, recall, method="higher")) if needed else 0


def search(
    vectors: DataFrame, is_query: Column, *, k: int = 20, recall: float = RECALL, vec_id: str = "vec_id", embedding: str = "embedding", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """For every row for which ``is_query`` (on the columns of ``vectors``) holds, its ``k`` nearest other rows found.

    ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (inner product in double precision), ties to the smaller id. All
    rows are candidates but those with the query's own id; with fewer than ``k``, all are returned. Rows that
    :func:`usable` leaves out take no part. Rows that repeat an id are entries of their own; as queries they are one,
    with the smallest vector. Other columns are not read. No usable row: an empty result.

    A query is sent to the shards its cells are in, with the list of these cells. A shard meets its queries in
    tasks of at most ``shard_rows`` rows and about ``QUERY_ROWS`` queries, each giving ``k`` rows a query.
    """
    spark = vectors.sparkSession
    out = "query_id bigint, vec_id bigint, score double"
    marked = vectors.withColumn("_query", F.coalesce(is_query, F.lit(False)))
    taking = durable(usable(marked, vec_id, embedding, "_query"))
    rows = taking.drop("_query")
    if rows.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    queries = durable(taking.where("_query").groupBy("vec_id").agg(F.min("vector").alias("vector")))
    index, postings = build(rows, shard_rows=shard_rows)
    postings = durable(postings)
    budget = max(measure_budget(index, postings, queries, k, recall), k + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = index.first.shape[1]
        for batch in batches:
            found: list[tuple] = []
            for name, query in zip(batch.column(0).to_pylist(), _vectors(batch.column(1)) if batch.num_rows else []):
                cells, seen = [], 0
                for cell, n in traverse(index.first @ query[:half], index.second @ query[half:], index.counts):
                    cells.append(cell)
                    seen += int(n)
                    if seen >= budget:
                        break
                taken = np.array(cells, np.int64)
                times = index.spread[taken]
                turn = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                shards, taken = np.repeat(index.shard[taken], times) + turn, np.repeat(taken, times)
                order = np.argsort(shards, kind="stable")
                shards, taken = shards[order], taken[order]
                cuts = np.flatnonzero(np.diff(shards)) + 1
                found += [(name, query, int(s[0]), c) for s, c in zip(np.split(shards, cuts), np.split(taken, cuts))]
            if found:
                kinds = (pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found), kinds)], names=["query_id", "query", "shard", "cells"])

    probes = durable(queries.select("vec_id", "vector").mapInArrow(probe, "query_id bigint, query array<double>, shard bigint, cells array<bigint>"))
    loads = durable(probes.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("bigint").alias("parts")))
    dealt = probes.join(loads, "shard").withColumn("part", F.pmod(F.xxhash64("query_id"), "parts")).drop("parts")
    held = postings.join(loads, "shard").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).drop("parts")

    def rerank(entries: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[pa.Table] = []
        if entries.num_rows and asked.num_rows:
            order = np.argsort(entries["cell"].to_numpy(), kind="stable")
            cells, ids = entries["cell"].to_numpy()[order], entries["vec_id"].to_numpy()[order]
            rows, sought, names = _vectors(entries["vector"])[order], _vectors(asked["query"]), asked["query_id"].to_pylist()
            edges = np.append(np.flatnonzero(np.append(True, cells[1:] != cells[:-1])), len(cells))
            lists = [np.asarray(c) for c in asked["cells"].to_pylist()]
            near = np.full((len(names), len(ids)), -np.inf)
            for a, b in zip(edges[:-1], edges[1:]):
                who = np.array([q for q, c in enumerate(lists) if (at := np.searchsorted(c, cells[a])) < len(c) and c[at] == cells[a]], np.int64)
                near[who, a:b] = sought[who] @ rows[a:b].T
            for q, name in enumerate(names):
                live, exact = _best(ids, rows, near[q], sought[q], name, k)
                found.append(pa.table({"query_id": pa.array(np.full(len(live), name, np.int64)), "vec_id": pa.array(ids[live]), "score": pa.array(exact)}))
        nothing = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return pa.concat_tables([nothing, *found])

    keys = ["shard", "part"]
    sorted_cells = dealt.withColumn("cells", F.sort_array("cells"))
    best = held.groupBy(*keys).cogroup(sorted_cells.groupBy(*keys)).applyInArrow(rerank, out)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
