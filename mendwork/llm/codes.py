"""Vector code compression: product codebooks in whole numbers, assigned under adaptive distance bounds.

Vectors are scaled to whole numbers and cut into parts; each part position has a codebook. A round gives every part
its nearest entry, then moves every entry to the floored mean of its parts. Between rounds a part keeps its ``b``
closest entries, nearest first, each with a lower bound of its distance, and one outer bound below the distances
to all others. When entries move, each bound falls by its entry's move and the outer one by the largest move. An
entry whose bound stays above the exact distance to the part's own entry cannot be nearer and is not looked at;
the rest is settled in whole numbers, and a part whose outer bound no longer holds is compared with all entries
and gets a new list. ``b`` follows what the rounds needed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mendwork.functions.durable import durable, new_stage, remove
from mendwork.functions.ranking import join_null_safe

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Whole-number components lie within this; beyond it a component counts as the limit. Squares then fit in 64 bits.
LIMIT = 1 << 24
# Below this, sums of products are exact in doubles.
EXACT = 1 << 21
# The first list length, and the least one.
LIST, LEAST = 16, 4
# A list is shortened to what this share of the parts needed, and doubled where more than the rest were compared in full.
COVERED = 0.99
CHUNK = 4096

STATE = "vec_id bigint, label {label}, vector array<int>, near binary, low binary, outer binary, depth binary, error bigint"
FULL = 255


class Bounds(NamedTuple):
    """Per part: ``near`` (n x b entries, its own first), ``low`` (n x b) and ``outer`` (n) lower bounds of distances."""

    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray


class Coded(NamedTuple):
    """Rows of ``vec_id``, ``label``, ``code`` (a byte a part) and ``error``, and the codebooks, one array a part.

    ``lists`` holds the list length of each round and ``full`` the share of parts it compared with all entries.
    """

    rows: DataFrame
    books: list[np.ndarray]
    lists: list[int]
    full: list[float]


def _below(d: np.ndarray) -> np.ndarray:
    return np.nextafter(d.astype(np.float32), np.float32(-np.inf))


def _above(d: np.ndarray) -> np.ndarray:
    return np.nextafter(d.astype(np.float64), np.inf)


def _squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    if max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)) < EXACT and x.shape[1] <= 256:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(book)), np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - book[None, :, j]) ** 2
    return out


def compare_all(x: np.ndarray, book: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
    """New lists for the rows of ``x``, and the exact squared distances to their nearest entries (ties: lower index)."""
    d2 = _squared(x, book)
    at = np.arange(len(x))
    own = d2.argmin(axis=1)
    best = d2[at, own]
    d2[at, own] = -1
    if b < len(book):
        near = np.argpartition(d2, b, axis=1)[:, : b + 1]
        outer = _below(np.sqrt(d2[at, near[:, b]]))
        near = near[:, :b]
    else:
        near, outer = np.tile(np.arange(len(book)), (len(x), 1)), np.full(len(x), np.inf, np.float32)
    near = np.take_along_axis(near, np.take_along_axis(d2, near, 1).argsort(axis=1, kind="stable"), 1)
    low = _below(np.sqrt(np.maximum(np.take_along_axis(d2, near, 1), 0)))
    low[:, 0] = -np.inf
    return _resized(Bounds(near, low, outer), b), best


def _resized(known: Bounds, b: int) -> Bounds:
    """Lists of ``b`` entries: what is cut off falls under the outer bound, added places are never looked at."""
    near, low, outer = known
    have = near.shape[1]
    if have > b:
        return Bounds(near[:, :b], low[:, :b], np.minimum(outer, low[:, b:].min(axis=1)))
    wide = ((0, 0), (0, b - have))
    return Bounds(np.pad(near, wide), np.pad(low, wide, constant_values=np.inf), outer)


def assign(x: np.ndarray, book: np.ndarray, known: Bounds, moves: np.ndarray, b: int) -> tuple[Bounds, np.ndarray, np.ndarray]:
    """Nearest entries after the entries moved by ``moves``: bounds, exact squared distances, and how deep each list was read.

    The depth is the last place of the list that had to be looked at (0: none), or ``FULL``.
    """
    near, low, outer = known
    at = np.arange(len(x))
    low = _below(low.astype(np.float64) - moves[near])
    outer = _below(outer.astype(np.float64) - moves.max(initial=0.0))
    d2 = np.full(near.shape, np.iinfo(np.int64).max)
    d2[:, 0] = ((x - book[near[:, 0]]) ** 2).sum(axis=1)
    unsure = low <= _above(np.sqrt(d2[:, 0]))[:, None]
    unsure[:, 0] = False
    rows, cols = np.nonzero(unsure)
    found = ((x[rows] - book[near[rows, cols]]) ** 2).sum(axis=1)
    d2[rows, cols] = found
    low[rows, cols] = _below(np.sqrt(found))
    low[:, 0] = _below(np.sqrt(d2[:, 0]))
    best = d2.min(axis=1)
    slot = np.where(d2 == best[:, None], near, len(book)).argmin(axis=1)
    low[at, slot] = -np.inf
    order = low.argsort(axis=1, kind="stable")
    bounds = _resized(Bounds(np.take_along_axis(near, order, 1), np.take_along_axis(low, order, 1), outer), b)
    depth = np.where(unsure, np.arange(near.shape[1])[None, :], 0).max(axis=1)
    full = np.flatnonzero(outer <= _above(np.sqrt(best)))
    if len(full):
        anew, best[full] = compare_all(x[full], book, b)
        for old, new in zip(bounds, anew):
            old[full] = new
        depth[full] = FULL
    return bounds, best, depth


def _columns(size: int, parts: int) -> list[np.ndarray]:
    return np.array_split(np.arange(size), parts)


def _ints(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), size)


def _unpacked(column: pa.Array, kind: str, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _packed(array: np.ndarray, kind: str) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(array.astype(kind))], pa.binary())


def whole_numbers(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` (whole numbers) of the usable rows.

    Null vectors and those that hold a null or non-finite component are dropped, and so are those that have not the
    commonest length (ties: the shorter).
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("_v"))

    def bad(v: Column) -> Column:
        return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))

    def scaled(v: Column) -> Column:
        return F.greatest(F.least(F.floor(F.lit(float(scale)) * v), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int")

    finite = rows.where("_v is not null").where(~F.exists("_v", bad))
    common = finite.groupBy(F.size("_v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    fitting = finite.where(F.size("_v") == (common["n"] if common else -1))
    return fitting.select("vec_id", "label", F.transform("_v", scaled).alias("vector"))


def _round(state: DataFrame, books: list[np.ndarray], moves: list[np.ndarray] | None, b: int, old_b: int) -> DataFrame:
    """One assignment of all parts; without ``moves`` every part is compared with all entries."""
    size = sum(book.shape[1] for book in books)
    columns = _columns(size, len(books))
    names = state.columns
    schema = STATE.format(label=dict(state.dtypes)["label"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(start, CHUNK)
                at = {name: piece.column(i) for i, name in enumerate(names)}
                x = _ints(at["vector"], size)
                if moves is not None:
                    near = _unpacked(at["near"], "u1", len(books), old_b)
                    low = _unpacked(at["low"], "<f4", len(books), old_b)
                    outer = _unpacked(at["outer"], "<f4", len(books))
                error, found, depths = np.zeros(len(x), np.int64), [], []
                for p, (book, cols) in enumerate(zip(books, columns)):
                    if moves is None:
                        bounds, best = compare_all(x[:, cols], book, b)
                        depth = np.full(len(x), FULL)
                    else:
                        known = Bounds(near[:, p].astype(np.int64), low[:, p], outer[:, p])
                        bounds, best, depth = assign(x[:, cols], book, known, moves[p], b)
                    error += best
                    found.append(bounds)
                    depths.append(depth)
                out = [
                    at["vec_id"], at["label"], at["vector"],
                    _packed(np.stack([f.near for f in found], 1), "u1"), _packed(np.stack([f.low for f in found], 1), "<f4"),
                    _packed(np.stack([f.outer for f in found], 1), "<f4"), _packed(np.stack(depths, 1), "u1"), pa.array(error),
                ]
                yield pa.RecordBatch.from_arrays(out, names=[f.split()[0] for f in schema.split(", ")])

    return state.mapInArrow(run, schema)


def _sums(state: DataFrame, books: list[np.ndarray], b: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Counts (part x entry), component sums a part (entry x component), and how many parts were read to each depth.

    Summed within a task first; the driver gets one number an entry and component.
    """
    size, k = sum(book.shape[1] for book in books), len(books[0])
    columns = _columns(size, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((len(columns), k), np.int64)
        total = [np.zeros((k, len(cols)), np.int64) for cols in columns]
        depths = np.zeros(256, np.int64)
        for batch in batches:
            x, own = _ints(batch.column(0), size), _unpacked(batch.column(1), "u1", len(columns), b)[:, :, 0]
            depths += np.bincount(_unpacked(batch.column(2), "u1", len(columns)).ravel(), minlength=256)
            for p, cols in enumerate(columns):
                count[p] += np.bincount(own[:, p], minlength=k)
                np.add.at(total[p], own[:, p], x[:, cols])
        parts = [(p, j, int(count[p, j]), total[p][j].tolist()) for p in range(len(columns)) for j in np.flatnonzero(count[p]).tolist()]
        parts += [(-1, j, int(depths[j]), []) for j in np.flatnonzero(depths).tolist()]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*parts), kinds)] if parts else [pa.array([], t) for t in kinds], names=["part", "entry", "n", "sums"])

    partial = state.select("vector", "near", "depth").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    each = partial.select("part", "entry", F.explode(F.concat(F.array(F.struct(F.lit(-1).alias("at"), F.col("n").alias("v"))),
        F.transform("sums", lambda v, i: F.struct(i.alias("at"), v.alias("v"))))).alias("s"))
    count = np.zeros((len(columns), k), np.int64)
    total = [np.zeros((k, len(cols)), np.int64) for cols in columns]
    depths = np.zeros(256, np.int64)
    for part, entry, at, v in each.groupBy("part", "entry", "s.at").agg(F.sum("s.v").alias("v")).collect():
        if part < 0:
            depths[entry] = v
        elif at < 0:
            count[part, entry] = v
        else:
            total[part][entry, at] = v
    return count, total, depths


def _next_length(depths: np.ndarray, b: int, k: int) -> int:
    """The list length that covers what the last round needed."""
    whole = depths.sum()
    if depths[FULL] > (1 - COVERED) * whole:
        return min(2 * b, max(LEAST, k // 4))
    needed = int(np.searchsorted(np.cumsum(depths[:FULL]), COVERED * whole))
    return min(b, max(LEAST, needed + 1))


def compress(
    vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, first_list: int = LIST,
) -> Coded:
    """Codes of all usable vectors after ``rounds`` rounds; see :func:`whole_numbers` for which rows take part.

    Codebooks start as the parts of the ``entries`` smallest ids (nulls last, then by vector); fewer rows give fewer
    entries. ``entries`` is at most 256. Repeated rows each count. A length that ``parts`` does not divide gives the
    first parts one component more. An empty table gives no rows and empty codebooks. Other columns are ignored, null
    ids and labels are kept.

    A round reads the stored state of the one before and writes its own, so a lost executor costs that executor's tasks;
    then the older state is removed. What reaches the driver and every task are the codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"entries must be 1 to 256, not {entries}")
    spark = vectors.sparkSession
    rows = durable(whole_numbers(vectors, vec_id=vec_id, embedding=embedding, label=label, scale=scale))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not first:
        empty = rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("bigint").alias("error")).limit(0)
        return Coded(empty, [np.zeros((0, 0), np.int64)] * parts, [], [])
    start = np.array([r["vector"] for r in first], np.int64)
    books = [start[:, cols] for cols in _columns(start.shape[1], parts)]
    k, b, old_b, moves, path = len(start), min(first_list, len(start)), 0, None, None
    state, lists, full = rows, [], []
    for turn in range(rounds + 1):
        written = new_stage(spark)
        found = _round(state, books, moves, b, old_b)
        found.write.parquet(written)
        state = spark.read.schema(found.schema).parquet(written)
        if path:
            remove(spark, path)
        path, old_b = written, b
        lists.append(b)
        if turn == rounds:
            break
        count, total, depths = _sums(state, books, b)
        full.append(float(depths[FULL]) / max(1, int(depths.sum())))
        moved = [np.where(n[:, None] > 0, t // np.maximum(n, 1)[:, None], book) for n, t, book in zip(count, total, books)]
        moves = [_above(np.sqrt(((m - book).astype(np.float64) ** 2).sum(axis=1))) for m, book in zip(moved, books)]
        books = moved
        b = _next_length(depths, b, k) if turn else b
    # The first byte of each part's list is its own entry.
    own = F.concat(*[F.substring("near", p * old_b + 1, 1) for p in range(parts)])
    return Coded(state.select("vec_id", "label", own.alias("code"), "error"), books, lists, full)


def books_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components as decimal text, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label_error``: the errors summed over equal labels, nulls together.

    Sums are stored before they are joined back, so the join is planned on their size and a hot label is split.
    """
    sums = durable(rows.groupBy("label").agg(F.sum("error").alias("label_error")))
    return join_null_safe(rows, sums, ["label"])
