"""Language identification by nearest centroid over hashed letter n-grams.

A text is lower-cased; runs without letters count as a word edge. Its 1- to 3-grams are hashed into ``dims``
buckets, weighted by ``(1 + log tf) * idf`` and normalised. Every language has several centroids, clustered from a
bounded sample of its texts. A text takes the language of the nearest centroid by cosine; it is rejected when it
is further from it than texts with as many different n-grams ever are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendwork.llm.batches import small_batches

DIMS = 8192
UNDETERMINED = "und"
# Bound of the sample: distinct texts a language is clustered from.
SAMPLE_TEXTS = 400
CENTROIDS = 4
ROUNDS = 12
# A text is rejected when its cosine is this many deviations below the mean of texts with as many n-grams, or below
# half of the least of them.
REJECT_DEVIATIONS = 6.0
_LEVELS = 24
_SLICE = 1 << 20


class Model(NamedTuple):
    """``centroids`` has a row for each entry of ``languages``; ``floor`` is the least accepted cosine by the
    logarithm (base 2) of the number of different n-grams."""

    languages: list[str]
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str | None, dims: int = DIMS) -> np.ndarray | None:
    """How often each n-gram bucket occurs in the whole text; None for a text without letters."""
    if not text:
        return None
    counts = np.zeros(dims, np.int64)
    shift = np.uint32(32 - (dims.bit_length() - 1))
    salts = [(0x9E3779B1, 0, 0), (0x85EBCA6B, 0xC2B2AE35, 0), (0x27D4EB2F, 0x165667B1, 0x9E3779B1)]
    seen = False
    for at in range(0, len(text), _SLICE):
        # Two characters before the slice give the n-grams that cross its edge; one-grams of them are not recounted.
        lead = min(at, 2)
        codes = np.frombuffer(text[at - lead : at + _SLICE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(_letters()[codes], codes, np.uint32(0))
        seen = seen or bool(codes.any())
        for n, salt in enumerate(salts, 1):
            start = max(lead - n + 1, 0)
            size = len(codes) - start - n + 1
            if size <= 0:
                continue
            parts = [codes[start + i : start + i + size] for i in range(n)]
            mixed = sum((p * np.uint32(s) for p, s in zip(parts, salt)), np.zeros(size, np.uint32))
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            lit = parts[0] != 0 if n == 1 else (parts[0] | parts[1]) != 0 if n == 2 else parts[1] != 0
            counts += np.bincount(mixed[lit] >> shift, minlength=dims)
    return counts if seen else None


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows of n-gram counts (rows)."""
    rows = np.zeros(counts.shape, np.float32)
    lit = counts > 0
    rows[lit] = 1 + np.log(counts[lit])
    rows *= idf
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def _level(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum((counts > 0).sum(axis=-1), 1))


def cluster(rows: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit rows by spherical k-means, started from rows far from each other."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(rows)))]
    near = rows @ rows[chosen[0]]
    while len(chosen) < min(k, len(rows)):
        far = np.clip(1 - near, 0, None)
        if far.sum() <= 1e-6:
            break
        chosen.append(int(rng.choice(len(rows), p=far / far.sum())))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centres = rows[chosen]
    for _ in range(rounds):
        own = np.argmax(rows @ centres.T, axis=1)
        sums = np.stack([rows[own == c].sum(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float32)


def document_frequencies(docs: DataFrame, text: str = "text", dims: int = DIMS) -> tuple[int, np.ndarray]:
    """Texts with letters, and how many of them have each n-gram bucket, over all rows. Only ``dims`` sums reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found = 0, np.zeros(dims, np.int64)
        for batch in batches:
            for t in batch.column(0):
                if (counts := ngram_counts(t.as_py(), dims)) is not None:
                    total += 1
                    found += counts > 0
        slot = np.append(np.flatnonzero(found), -1)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.append(found[found > 0], total))], names=["slot", "n"])

    sums = docs.select(text).mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(dims + 1, np.int64)
    for row in sums:
        frequency[row["slot"]] = row["n"]
    return int(frequency[-1]), frequency[:-1]


def train(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    dims: int = DIMS,
    sample_texts: int = SAMPLE_TEXTS,
    centroids: int = CENTROIDS,
    deviations: float = REJECT_DEVIATIONS,
) -> Model:
    """Fit on labelled rows: texts with letters and a language that is not null. No such row: a model without languages.

    Document frequencies are over all these rows. Centroids come from a sample by text hash that is meant to have
    four fifths of ``sample_texts`` distinct texts of a language, so that it stays below; each language is clustered by
    a task of its own, from the ``sample_texts`` with the smallest hashes should there be more.
    """
    small_batches(docs.sparkSession)
    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    total, frequency = document_frequencies(labelled, dims=dims)
    idf = (np.log((1 + total) / (1 + frequency)) + 1).astype(np.float32)
    hashed = labelled.withColumn("h", F.xxhash64("text"))
    sizes = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    shares = {r["lang"]: min(1.0, sample_texts / (1.25 * max(r["n"], 1))) if r["n"] > sample_texts / 2 else 1.0 for r in sizes}
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")] if shares else F.lit(0.0)
    drawn = F.pmod(F.col("h"), F.lit(1 << 40)) < share * float(1 << 40)
    sample = hashed.where(drawn).groupBy("lang", "h").agg(F.min("text").alias("text"))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("h").head(sample_texts)
        rows, levels = [], []
        for t in group["text"]:
            if (counts := ngram_counts(t, dims)) is not None:
                rows.append(counts)
        if not rows:
            return pd.DataFrame({"lang": [], "centroid": [], "levels": [], "cosines": []})
        counts = np.stack(rows)
        units = weighted(counts, idf)
        centres = cluster(units, centroids)
        levels, cosines = [_level(counts)], [(units @ centres.T).max(axis=1)]
        # Beginnings of the sampled texts show how near texts come that are shorter than those of the sample.
        for size in (2**j for j in range(2, 14)):
            short = [c for t in group["text"] if len(t) > size and (c := ngram_counts(t[:size], dims)) is not None]
            if short:
                cut = np.stack(short)
                levels.append(_level(cut))
                cosines.append((weighted(cut, idf) @ centres.T).max(axis=1))
        found = pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": [c.tobytes() for c in centres]})
        found["levels"] = [np.concatenate(levels).astype(float).tolist()] + [[]] * (len(centres) - 1)
        found["cosines"] = [np.concatenate(cosines).astype(float).tolist()] + [[]] * (len(centres) - 1)
        return found

    fitted = sample.groupBy("lang").applyInPandas(fit, "lang string, centroid binary, levels array<double>, cosines array<double>")
    rows = sorted(fitted.collect(), key=lambda r: (r["lang"], bytes(r["centroid"])))
    levels = np.array([x for r in rows for x in r["levels"]])
    cosines = np.array([x for r in rows for x in r["cosines"]])
    floor = np.full(_LEVELS, -np.inf)
    for level in range(_LEVELS):
        # At least two levels wide, so that every level that occurs has texts; levels never seen take the one below.
        near = cosines[np.abs(levels - level) <= 1] if len(levels) else cosines
        if len(near) >= 8:
            floor[level] = max(near.mean() - deviations * near.std(), near.min() / 2)
        elif level:
            floor[level] = floor[level - 1]
    centres = np.stack([np.frombuffer(bytes(r["centroid"]), np.float32) for r in rows]) if rows else np.zeros((0, dims), np.float32)
    return Model([r["lang"] for r in rows], centres, idf, floor)


def identify(
    docs: DataFrame, model: Model, *keep: str, text: str = "text", named: tuple[str, str, str] = ("lang_pred", "score", "rejected")
) -> DataFrame:
    """``keep`` columns of every row with prediction, score and rejection (called ``named``); one pass, no shuffle.

    The score is the cosine to the nearest centroid, at least 0. Null texts and texts without a letter are
    ``und`` with score 0 and rejected; so is everything when the model has no language. The prediction of a
    rejected text with letters is still the nearest language. Kept columns must not have the names in ``named``.
    """
    small_batches(docs.sparkSession)
    kept = docs.select(*keep)
    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*kept.schema.fields, *map(T.StructField, named, kinds)])
    languages = np.array(model.languages, object)
    centres, idf, floor, dims = model.centroids, model.idf, model.floor, len(model.idf)
    read = kept if text in keep else docs.select(*keep, text)
    at_text, width = read.columns.index(text), len(keep)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at_text)
            pred = np.full(len(texts), UNDETERMINED, object)
            score, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
            for at in range(0, len(texts), 256):
                rows = {i: c for i in range(at, min(at + 256, len(texts))) if (c := ngram_counts(texts[i].as_py(), dims)) is not None}
                if not rows or not len(languages):
                    continue
                where, counts = np.array(list(rows)), np.stack(list(rows.values()))
                near = weighted(counts, idf) @ centres.T
                pred[where] = languages[near.argmax(axis=1)]
                score[where] = np.clip(near.max(axis=1).astype(float), 0, 1)
                rejected[where] = near.max(axis=1) < floor[np.minimum(np.rint(_level(counts)).astype(int), _LEVELS - 1)]
            columns = [*batch.columns[:width], pa.array(pred, pa.string()), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *named])

    return read.mapInArrow(name, schema)
