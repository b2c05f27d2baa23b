"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic calibration.

Statistics of every whole text are standardised and mapped to cosines whose inner products approximate a Gaussian
kernel. Tasks sum their part of the normal equations, apart for each fold; models that leave a fold out are then
free, and give the ridge and the scores the calibration is fitted on. A fold is a hash of the text, so copies
share one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendwork.functions.durable import durable
from mendwork.llm.batches import small_batches

FEATURES = 192
FOLDS = 4
RIDGES = (1e-4, 1e-3, 1e-2, 1e-1, 1.0)
# Width in standard deviations of the kernel, for each statistic.
WIDTH = 4.0
# Calibration cells over raw scores from -0.5 to 1.5: their counts are all the driver sees of the scores.
CELLS = 2000
STATISTICS = (
    "log_chars", "log_words", "word_chars", "word_chars_spread", "upper_share", "letter_share", "digit_share",
    "space_share", "sentence_marks", "other_marks", "bar_share", "repeated_mark_words", "upper_words", "line_words",
    "distinct_words", "distinct_pairs", "top_word_share", "top_pair_share", "distinct_lines", "repeated_line_chars",
    "deflate_ratio", "short_words", "long_words", "title_words",
)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SLICE = 1 << 22


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text, all finite; null is an empty text, whose statistics are all zero."""
    if not text:
        return np.zeros(len(STATISTICS))
    raw = text.encode("utf-8", "surrogatepass")
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(text)
    upper, lower = codes[65:91].sum(), codes[97:123].sum()
    letters = upper + lower + codes[192:].sum()
    digits, spaces = codes[48:58].sum(), codes[9:14].sum() + codes[32]
    sentence = codes[[44, 46, 58, 59, 63]].sum()
    marks = codes[33:48].sum() + codes[58:65].sum() + codes[91:97].sum() + codes[123:127].sum() - sentence
    words = _WORD.findall(text)
    n = len(words)
    if n:
        sizes = np.fromiter(map(len, words), np.int64, n)
        single, pairs = Counter(words), Counter(zip(words, words[1:]))
        marked = sum(k for w, k in single.items() if len(w) > 2 and w[-1] == w[-2] and not w[-1].isalnum())
        shouted = sum(k for w, k in single.items() if len(w) > 1 and w.isupper())
        titled = sum(k for w, k in single.items() if w[:1].isupper() and not w.isupper())
        word_part = [
            sizes.mean(), sizes.std(), marked / n, shouted / n, len(single) / n, len(pairs) / max(n - 1, 1),
            max(single.values()) / n, max(pairs.values(), default=0) / max(n - 1, 1), (sizes <= 3).mean(),
            (sizes > 12).mean(), titled / n,
        ]
    else:
        word_part = [0.0] * 11
    lines = text.split("\n")
    kinds = Counter(lines)
    packed = zlib.compressobj(1)
    squeezed = sum(len(packed.compress(raw[a : a + _SLICE])) for a in range(0, len(raw), _SLICE)) + len(packed.flush())
    mean, spread, marked_share, shouted_share, distinct, distinct_pairs, top, top_pair, short, long, titles = word_part
    return np.array([
        np.log1p(chars), np.log1p(n), np.log1p(mean), np.log1p(spread), upper / max(upper + lower, 1), letters / len(raw),
        digits / chars, spaces / chars, sentence / max(n, 1), marks / max(n, 1), codes[124] / max(n, 1), marked_share,
        shouted_share, np.log1p(n / len(lines)), distinct, distinct_pairs, top, top_pair, len(kinds) / len(lines),
        sum(len(k) * (c - 1) for k, c in kinds.items()) / chars, min(squeezed / len(raw), 2.0), short, long, titles,
    ])


class Model(NamedTuple):
    """``mean`` and ``scale`` standardise; ``waves`` and ``phase`` make features; ``weights`` end in the intercept;
    ``steps`` and ``levels`` are the calibration (raw score, share of good texts). No weights: score 0.5."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray


def features(stats: np.ndarray, model: Model) -> np.ndarray:
    """Random Fourier features of rows of statistics, the standardised statistics themselves, and a constant."""
    unit = np.clip((stats - model.mean) / model.scale, -6, 6)
    waves = np.cos(unit @ model.waves + model.phase) * np.sqrt(2 / model.waves.shape[1])
    return np.concatenate([waves, unit / np.sqrt(unit.shape[1]), np.ones((len(unit), 1))], axis=1)


def with_statistics(docs: DataFrame, *keep: Column | str, text: str = "text") -> DataFrame:
    """``keep`` columns with ``stats`` (array of doubles); one pass, no shuffle."""
    small_batches(docs.sparkSession)
    kept = docs.select(*keep)
    names = kept.columns
    schema = T.StructType([*kept.schema.fields, T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()).tolist() for t in batch.column(len(names))]
            columns = [*batch.columns[: len(names)], pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "stats"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(compute, schema)


def _moments(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    width = len(STATISTICS)
    aggs = [F.count(F.lit(1))] + [f(F.col("stats")[i]) for i in range(width) for f in (F.avg, F.stddev_pop)]
    n, *found = rows.agg(*aggs).first()
    pairs = np.array([0.0 if x is None else x for x in found]).reshape(width, 2)
    return n, pairs[:, 0], np.where(pairs[:, 1] > 1e-9, pairs[:, 1], 1.0)


def _normal_equations(rows: DataFrame, model: Model, folds: int) -> np.ndarray:
    """For each fold the sums of ``[x, y] [x, y]^T``: one matrix a task and fold, added up in two rounds by tasks."""
    size = model.waves.shape[1] + len(STATISTICS) + 2

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((folds, size, size))
        for batch in batches:
            stats = np.array(batch.column("stats").to_pylist(), float).reshape(-1, len(STATISTICS))
            x = np.concatenate([features(stats, model), np.asarray(batch.column("good"), float)[:, None]], axis=1)
            fold = np.asarray(batch.column("fold"))
            for k in range(folds):
                sums[k] += x[fold == k].T @ x[fold == k]
        yield pa.RecordBatch.from_arrays([pa.array(range(folds), pa.int32()), pa.array([s.tobytes() for s in sums])], names=["fold", "sums"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size * size)
        for s in group["sums"]:
            total += np.frombuffer(s)
        return pd.DataFrame({"fold": group["fold"].iloc[:1], "salt": 0, "sums": [total.tobytes()]})

    kind = "fold int, salt int, sums binary"
    # Task matrices are small in number per salt, whatever the number of tasks.
    salted = rows.mapInArrow(part, "fold int, sums binary").withColumn("salt", (F.spark_partition_id() / 64).cast("int"))
    parts = salted.groupBy("fold", "salt").applyInPandas(add, kind).groupBy("fold").applyInPandas(add, kind).collect()
    found = np.zeros((folds, size, size))
    for row in parts:
        found[row["fold"]] = np.frombuffer(bytes(row["sums"])).reshape(size, size)
    return found


def _solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    gram, right = sums[:-1, :-1], sums[:-1, -1]
    n = max(gram[-1, -1], 1.0)
    penalty = np.full(len(gram), ridge * n / 10)
    penalty[-1] = 1e-9
    return np.linalg.solve(gram + np.diag(penalty), right)


def isotonic(good: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-decreasing shares of ``good`` in ``total`` nearest in squares; neighbouring violators are pooled."""
    blocks: list[list[float]] = []
    for g, t in zip(good.tolist(), total.tolist()):
        blocks.append([g, t, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g2, t2, c2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g2, blocks[-1][1] + t2, blocks[-1][2] + c2]
    return np.concatenate([np.full(c, g / t) for g, t, c in blocks])


def train(
    stats: DataFrame, *, features_count: int = FEATURES, folds: int = FOLDS, width: float = WIDTH, ridges: tuple[float, ...] = RIDGES, seed: int = 11
) -> Model:
    """Fit on all rows of ``stats`` (``stats``, ``good`` 0/1, ``fold`` from 0), none sampled.

    Rows whose label is null are not learned from. What reaches the driver is one matrix for each fold and the
    counts of the calibration cells, whatever the number of rows. No row: a model that scores 0.5.
    """
    rows = stats.where("good is not null").select("stats", F.col("good").cast("double").alias("good"), F.col("fold").cast("int").alias("fold"))
    n, mean, scale = _moments(rows)
    rng = np.random.default_rng(seed)
    waves = rng.normal(size=(len(STATISTICS), features_count)) / (width * np.sqrt(len(STATISTICS) / 8))
    phase = rng.uniform(0, 2 * np.pi, features_count)
    nothing = np.zeros(0)
    model = Model(mean, scale, waves, phase, nothing, nothing, nothing)
    if not n:
        return model
    sums = _normal_equations(rows, model, folds)
    whole = sums.sum(axis=0)

    def error(ridge: float) -> float:
        """Squared error of every fold under the model fitted on the others, from the sums alone."""
        found = 0.0
        for own in sums:
            w = np.append(_solve(whole - own, ridge), -1.0)
            found += float(w @ own @ w)
        return found

    ridge = min(ridges, key=error)
    left_out = np.stack([_solve(whole - own, ridge) for own in sums])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, good = np.zeros(CELLS, np.int64), np.zeros(CELLS)
        for batch in batches:
            x = features(np.array(batch.column("stats").to_pylist(), float).reshape(-1, len(STATISTICS)), model)
            raw = (x * left_out[np.asarray(batch.column("fold"))]).sum(axis=1)
            cell = _cell(raw)
            total += np.bincount(cell, minlength=CELLS)
            good += np.bincount(cell, weights=np.asarray(batch.column("good"), float), minlength=CELLS)
        lit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lit), pa.array(total[lit]), pa.array(good[lit])], names=["cell", "n", "good"])

    counted = rows.mapInArrow(cells, "cell bigint, n bigint, good double").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    at = sorted((r["cell"], r["n"], r["good"]) for r in counted.collect())
    cell, total, good = (np.array(x, float) for x in zip(*at))
    # One good and one bad text spread over the ends keep the shares off 0 and 1.
    levels = isotonic(good + 1e-3, total + 2e-3)
    return model._replace(weights=_solve(whole, ridge), steps=-0.5 + (cell + 0.5) * 2 / CELLS, levels=levels)


def _cell(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 0.5) * CELLS / 2).astype(np.int64), 0, CELLS - 1)


def predict(stats: np.ndarray, model: Model) -> np.ndarray:
    """Calibrated scores of rows of statistics."""
    if not len(model.weights):
        return np.full(len(stats), 0.5)
    return np.clip(np.interp(features(stats, model) @ model.weights, model.steps, model.levels), 0, 1)


def score(stats: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns of every row of ``stats`` with ``score`` (0 to 1, higher: good is likelier)."""
    schema = T.StructType([*stats.select(*keep).schema.fields, T.StructField("score", T.DoubleType())])

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column(len(keep)).to_pylist(), float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(predict(rows, model))], names=[*keep, "score"])

    return stats.select(*keep, "stats").mapInArrow(rate, schema)


def classify(
    docs: DataFrame, labels: DataFrame, learn: Column, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """Scores every whole text of ``docs``: ``doc_id``, ``learn`` and ``score``.

    Learns from the documents for which ``learn`` (a condition on the documents' columns) holds and ``labels`` has
    one 0/1 ``label``; an id that ``labels`` repeats takes its mean, rounded. Null and empty texts have the statistics
    zero and are scored like others. The texts are read once: their statistics are stored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text).alias("text"))
    keyed = rows.withColumn("fold", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int"))
    stats = durable(with_statistics(keyed, "doc_id", "learn", "fold"))
    marks = labels.where(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(F.round(F.avg(label)).alias("good"))
    learned = stats.where("learn").join(marks, "doc_id").select("stats", "good", "fold")
    return score(stats, train(durable(learned)), "doc_id", "learn")
