"""Improbable-feature digests: rare byte windows in chained Bloom filters.

Every window of 64 bytes has an entropy level. How rare each level is over the whole corpus gives its rank. In
every run of 64 neighbouring windows the rarest (first of equals) gets a vote; windows with enough votes are the
text's features. Their hashes fill Bloom filters of 2048 bits, a new one after every 160 features. Two digests are
compared by the normalised overlap of their filters' bits.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendwork.functions.durable import durable
from mendwork.llm.batches import small_batches

WINDOW = 64
RUN = 64
VOTES = 16
LEVELS = 1024
FILTER_BYTES = 256
FILTER_FEATURES = 160
SUB_HASHES = 5
# Share of the room between chance overlap and full overlap that still counts as chance.
CHANCE = 0.3
_UNIT = 1024
_COUNTS = np.arange(WINDOW + 2)
_INFO = np.rint(_COUNTS * np.log2(np.maximum(_COUNTS, 1)) * _UNIT).astype(np.int64)
_STEP = np.diff(_INFO)
_BLOCK = 1 << 16


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Level, 0 to ``LEVELS - 1``, of the window that starts at each byte; the last 63 bytes start none.

    A byte's count among the 63 before (and after) it tells what entering (and leaving) the window changes.
    """
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    enter, leave = np.empty(n, np.int64), np.empty(n, np.int64)
    for at in range(0, n, _BLOCK):
        lo, hi = max(at - WINDOW + 1, 0), min(at + _BLOCK + WINDOW - 1, n)
        part = data[lo:hi]
        before, after = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        for d in range(1, min(WINDOW, len(part))):
            same = (part[d:] == part[:-d]).view(np.uint8)
            before[d:] += same
            after[:-d] += same
        own = slice(at - lo, at - lo + min(_BLOCK, n - at))
        enter[at : at + _BLOCK], leave[at : at + _BLOCK] = _STEP[before[own]], _STEP[after[own]]
    total = _INFO[np.bincount(data[:WINDOW], minlength=256)].sum()
    info = total + np.cumsum(np.append(0, enter[WINDOW:] - leave[: n - WINDOW]))
    return np.clip(((_INFO[WINDOW] - info) * (LEVELS - 1)) // _INFO[WINDOW], 0, LEVELS - 1)


def _join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts], np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum(sizes))


def level_counts(texts: list[bytes]) -> np.ndarray:
    """How many windows of the texts have each level; windows never span two texts."""
    data, edges = _join(texts)
    levels = entropy_levels(data)
    inside = np.zeros(len(levels) + 1, np.int64)
    long = edges[1:] - edges[:-1] >= WINDOW
    np.add.at(inside, edges[:-1][long], 1)
    np.add.at(inside, edges[1:][long] - WINDOW + 1, -1)
    return np.bincount(levels[np.cumsum(inside)[:-1] > 0], minlength=LEVELS)


def _hashes(windows: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of 64 bytes."""
    words = np.ascontiguousarray(windows).view("<u8")
    h = np.full(len(words), 0x9E3779B97F4A7C15, np.uint64)
    for column in range(words.shape[1]):
        h = (h ^ words[:, column]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The filters of every text, as rows of ``FILTER_BYTES``.

    A text shorter than a window has one feature, itself padded with zeros; an empty text has no filter.
    """
    data, edges = _join(texts)
    levels = entropy_levels(data)
    votes = np.zeros(len(data) + 1, np.int64)
    runs = len(levels) - RUN + 1
    if runs > 0:
        best = (ranks[levels].astype(np.int64) << 40) | np.arange(len(levels))
        for span in (1, 2, 4, 8, 16, 32):
            best = np.minimum(best[:-span], best[span:])
        inside = np.zeros(len(data) + 1, np.int64)
        long = edges[1:] - edges[:-1] >= WINDOW + RUN - 1
        np.add.at(inside, edges[:-1][long], 1)
        np.add.at(inside, edges[1:][long] - WINDOW - RUN + 2, -1)
        valid = np.cumsum(inside)[: len(best)] > 0
        votes += np.bincount(best[valid] & ((1 << 40) - 1), minlength=len(votes))
    out = []
    views = np.lib.stride_tricks.sliding_window_view(data, WINDOW) if len(data) >= WINDOW else None
    for a, b in zip(edges[:-1], edges[1:]):
        if a == b:
            out.append(np.zeros((0, FILTER_BYTES), np.uint8))
            continue
        if b - a < WINDOW:
            padded = np.zeros((1, WINDOW), np.uint8)
            padded[0, : b - a] = data[a:b]
            found = _hashes(padded)
        else:
            own = votes[a : b - WINDOW + 1]
            if b - a < WINDOW + RUN - 1:
                chosen = np.array([np.argmin(ranks[levels[a : b - WINDOW + 1]])])
            else:
                chosen = np.flatnonzero(own >= min(VOTES, own.max()))
            found = _hashes(views[a + chosen])
        _, first = np.unique(found, return_index=True)
        found = found[np.sort(first)]
        filters = -(-len(found) // FILTER_FEATURES)
        bits = np.zeros((filters, FILTER_BYTES * 8), np.uint8)
        chain = np.arange(len(found)) // FILTER_FEATURES
        for k in range(SUB_HASHES):
            bits[chain, ((found >> np.uint64(11 * k)) & np.uint64(2047)).astype(np.int64)] = 1
        out.append(np.packbits(bits, axis=1))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the filters of the shorter chain of the best overlap with a filter of the other; two empty ones: 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    ones_a, ones_b = np.bitwise_count(a).sum(axis=1).astype(float), np.bitwise_count(b).sum(axis=1).astype(float)
    best = np.zeros(len(a))
    for i in range(len(a)):
        most = np.minimum(ones_a[i], ones_b)
        chance = ones_a[i] * ones_b / (FILTER_BYTES * 8)
        cut = chance + CHANCE * (most - chance)
        shared = np.bitwise_count(a[i] & b).sum(axis=1)
        best[i] = np.clip((shared - cut) / np.maximum(most - cut, 1e-9), 0, 1).max()
    return float(best.mean())


def level_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of every level, the rarest over all windows of all texts first. Only the level counts reach the driver."""

    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            for part in _portions([(t.as_py() or "").encode() for t in batch.column(0)]):
                total += level_counts(part)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["level", "n"])

    counts = np.zeros(LEVELS, np.int64)
    for row in docs.select(text).mapInArrow(count, "level bigint, n bigint").groupBy("level").agg(F.sum("n").alias("n")).collect():
        counts[row["level"]] = row["n"]
    ranks = np.empty(LEVELS, np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(LEVELS)
    return ranks


def _portions(texts: list[bytes], most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Runs of texts of about ``most`` bytes together; a longer text is a run of its own."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _all_digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    return [d for part in _portions(texts) for d in digests(part, ranks)]


def fingerprints(docs: DataFrame, *keys: str, ranks: np.ndarray, text: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint`` (filters in base64) of every whole text; null texts are empty. No shuffle."""
    schema = T.StructType([*docs.select(*keys).schema.fields, T.StructField("fingerprint", T.StringType())])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _all_digests([(t.as_py() or "").encode() for t in batch.column(len(keys))], ranks)
            shown = pa.array([base64.b64encode(d.tobytes()).decode() for d in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], shown], names=[*keys, "fingerprint"])

    return docs.select(*keys, F.col(text)).mapInArrow(compute, schema)


_RESULT = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_RESULT_SQL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(rows: list[tuple], ranks: np.ndarray) -> list[tuple]:
    """Result rows of ``(doc_id, text, filters, next text, next filters)``."""
    edited = []
    for _, text, _, following, _ in rows:
        cut = len(text) // 3
        edited.append((text[: len(text) - cut] + following[:cut]).encode())
    shown = lambda d: base64.b64encode(d.tobytes()).decode()
    return [
        (name, len(text), hashlib.sha256(e).hexdigest(), shown(own), shown(d), likeness(own, d), likeness(own, after))
        for (name, text, own, _, after), e, d in zip(rows, edited, _all_digests(edited, ranks))
    ]


def compare_edited(docs: DataFrame, ranks: np.ndarray, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they and the next document's are.

    Documents are in descending order of id (null last; equal ids by text hash, then text); the last is followed
    by the first. The edited text has its last third (code points, rounded down) replaced by as many of the next
    text's first. Null texts are empty. Other columns are not read; an empty table gives an empty result.
    The texts are shuffled once, by ranges of the order. A task compares what follows in its own range; the first
    and last text of each range are stored and joined by range number, one row a task.
    """
    small_batches(docs.sparkSession)
    body = pa.schema([*_RESULT, ("part", pa.int64()), ("edge", pa.int64()), ("text", pa.string())])
    sql = f"{_RESULT_SQL}, part bigint, edge bigint, text string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        carried: tuple | None = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), body)], schema=body)

        def edge(row: tuple, kind: int) -> pa.RecordBatch:
            return table([(row[0], len(row[1]), None, None, None, None, None, part, kind, row[1])])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                texts = [t.as_py() or "" for t in piece.column(1)]
                rows = list(zip(piece.column(0).to_pylist(), texts, _all_digests([t.encode() for t in texts], ranks)))
                if carried is None:
                    yield edge(rows[0], 1)
                else:
                    rows.insert(0, carried)
                carried = rows[-1]
                if len(rows) > 1:
                    yield table([(*r, part, 0, None) for r in _compare([(*a, *b[1:]) for a, b in zip(rows, rows[1:])], ranks)])
        if carried is not None:
            yield edge(carried, 2)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, own, following in zip(*(c.to_pylist() for c in batch.columns)):
                mine, after = _all_digests([own.encode(), following.encode()], ranks)
                row = _compare([(name, own, mine, following, after)], ranks)[0]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(row, _RESULT)], names=[n for n, _ in _RESULT])

    keyed = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("words"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("words").asc(), F.col("words").asc()]
    walked = durable(keyed.repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(walk, sql))
    inner = walked.where("edge = 0").select(*[n for n, _ in _RESULT])
    # One row for each task that had rows.
    by_part = Window.orderBy("part")
    parts = walked.where("edge = 1").select("part").select("part", F.coalesce(F.lead("part").over(by_part), F.min("part").over(Window.partitionBy())).alias("after"))
    heads = walked.where("edge = 1").select(F.col("part").alias("after"), F.col("text").alias("following"))
    tails = walked.where("edge = 2").select("part", "doc_id", F.col("text").alias("own")).join(parts, "part").join(heads, "after")
    return inner.union(tails.select("doc_id", "own", "following").mapInArrow(finish, _RESULT_SQL))
