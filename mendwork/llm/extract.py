"""Main text of web pages: a linear-chain conditional random field over their leaf blocks.

Each block is main text or not. Features are the tags and the words of class, id and role of all its ancestors, and what
its text looks like: length, links, punctuation, place. A page's most likely labels as a whole are found by
Viterbi. Weights are fitted on labelled pages by rounds of parameter mixing: each share of the pages, a
Spark group of its own, climbs the regularised likelihood of its pages from the common weights, and the shares' weights
are averaged by their numbers of pages.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendwork.functions.durable import durable
from mendwork.llm.batches import small_batches
from mendwork.llm.html import Block, leaf_blocks

# Shares of the labelled pages, rounds of mixing, and steps in a round.
SHARES, ROUNDS, STEPS = 4, 3, 60
RATE, RIDGE = 0.2, 1e-4
# Features must be seen on so many pages.
LEAST_PAGES = 5
LENGTHS = (1, 2, 4, 8, 16, 32, 64)
SENTENCE_ENDS = ".!?…。！？:;\"”»'’)"


class Model(NamedTuple):
    """Weight of each feature for main text, ``(before, after)`` transition scores with 1 for main text, and the start score of main text."""

    weights: dict[str, float]
    moves: list[list[float]]
    start: float


def shape_of(block: Block, place: int, blocks: int) -> list[str]:
    """Features of a block's text and its place in the page."""
    text = block.text
    words = text.count(" ") + 1
    share = block.linked / len(text)
    found = [
        f"words:{sum(words >= n for n in LENGTHS)}",
        f"links:{0 if share == 0 else 1 if share < 0.35 else 2 if share < 0.9 else 3}",
        "ended" if text[-1] in SENTENCE_ENDS else "open",
        f"place:{5 * place // blocks}",
    ]
    if not place:
        found.append("first")
    if place == blocks - 1:
        found.append("last")
    if "©" in text:
        found.append("rights")
    if "|" in text or "·" in text or "»" in text:
        found.append("bars")
    return found


def features_of(blocks: list[Block]) -> list[list[str]]:
    return [[*sorted(b.context), *shape_of(b, i, len(blocks))] for i, b in enumerate(blocks)]


def decode(scores: list[float], model: Model) -> list[bool]:
    """The most likely labels of blocks with these scores of being main text (ties: not main text)."""
    if not scores:
        return []
    (stay0, enter), (leave, stay1) = model.moves
    other, main = 0.0, model.start + scores[0]
    back: list[tuple[bool, bool]] = []
    for score in scores[1:]:
        to_other, to_main = main + leave > other + stay0, main + stay1 > other + enter
        back.append((to_other, to_main))
        other, main = max(main + leave, other + stay0), max(main + stay1, other + enter) + score
    label = main > other
    labels = [label]
    for to_other, to_main in reversed(back):
        label = to_main if label else to_other
        labels.append(label)
    return labels[::-1]


def block_scores(blocks: list[Block], weights: dict[str, float]) -> list[float]:
    """Each block's summed weights; blocks of one context share its sum."""
    known: dict[frozenset[str], float] = {}
    out = []
    for i, block in enumerate(blocks):
        context = known.get(block.context)
        if context is None:
            context = known[block.context] = sum([weights.get(f, 0.0) for f in sorted(block.context)])
        out.append(context + sum([weights.get(f, 0.0) for f in shape_of(block, i, len(blocks))]))
    return out


def main_text(html: str | None, model: Model) -> tuple[str, int]:
    """A page's main text, one line a block, and how many blocks the page has."""
    blocks = leaf_blocks(html) if html else []
    labels = decode(block_scores(blocks, model.weights), model)
    return "\n".join([b.text for b, keep in zip(blocks, labels) if keep]), len(blocks)


class Pages(NamedTuple):
    """Labelled pages by falling length: ``place[page, t]`` numbers block ``t``, ``lengths``, each block's ``labels``, and its
    features as ``(block, feature)`` pairs."""

    place: np.ndarray
    lengths: np.ndarray
    labels: np.ndarray
    block: np.ndarray
    feature: np.ndarray


def arrange(pages: list[tuple[list[list[int]], list[int]]]) -> Pages:
    pages = sorted(pages, key=lambda p: -len(p[0]))
    lengths = np.array([len(rows) for rows, _ in pages])
    starts = np.cumsum(lengths) - lengths
    place = starts[:, None] + np.arange(lengths.max(initial=1))[None]
    blocks = [f for rows, _ in pages for f in rows]
    block = np.repeat(np.arange(len(blocks)), [len(f) for f in blocks])
    return Pages(place, lengths, np.array([m for _, marks in pages for m in marks]), block, np.array([f for fs in blocks for f in fs], int))


def gradient(pages: Pages, weights: np.ndarray, moves: np.ndarray, start: float) -> tuple[float, np.ndarray, np.ndarray, float]:
    """Log-likelihood of the labels of ``pages`` and its gradient by weights, moves and start."""
    score = np.bincount(pages.block, weights[pages.feature], minlength=len(pages.labels))
    emit = np.stack([np.zeros_like(score), score], 1)
    longest = int(pages.lengths.max(initial=1))
    live = [int((pages.lengths > t).sum()) for t in range(longest)]
    at = [pages.place[:n, t] for t, n in enumerate(live)]
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    forward[at[0]] = emit[at[0]] + np.array([0.0, start])
    for t in range(1, longest):
        before = forward[at[t - 1][: live[t]]]
        forward[at[t]] = np.logaddexp(before[:, :1] + moves[0], before[:, 1:] + moves[1]) + emit[at[t]]
    final = pages.place[np.arange(len(pages.lengths)), pages.lengths - 1]
    whole = np.logaddexp(forward[final, 0], forward[final, 1])
    pair = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        here = at[t][: live[t + 1]]
        after = emit[at[t + 1]] + backward[at[t + 1]]
        backward[here] = np.logaddexp(after[:, :1] + moves[:, 0], after[:, 1:] + moves[:, 1])
        pair += np.exp(forward[here][:, :, None] + moves[None] + after[:, None, :] - whole[: live[t + 1], None, None]).sum(axis=0)
    page = np.repeat(np.arange(len(pages.lengths)), pages.lengths)
    excess = pages.labels - np.exp(forward[:, 1] + backward[:, 1] - whole[page])
    by_feature = np.bincount(pages.feature, excess[pages.block], minlength=len(weights))
    first, inner = at[0], np.flatnonzero(np.append(page[1:] == page[:-1], False))
    seen = np.zeros((2, 2))
    np.add.at(seen, (pages.labels[inner], pages.labels[inner + 1]), 1)
    path = score @ pages.labels + start * pages.labels[first].sum() + (seen * moves).sum()
    return float(path - whole.sum()), by_feature, seen - pair, float(excess[first].sum())


def _climb(pages: Pages, theta: np.ndarray, size: int, steps: int) -> np.ndarray:
    """``theta`` (weights, moves, start) after so many steps up the regularised likelihood of ``pages``, each scaled by past slopes."""
    theta, past = theta.copy(), np.full(len(theta), 1e-8)
    for step in range(steps):
        _, by_feature, by_move, by_start = gradient(pages, theta[:size], theta[size : size + 4].reshape(2, 2), theta[-1])
        slope = np.concatenate([by_feature, by_move.ravel(), [by_start]]) / len(pages.lengths) - RIDGE * theta
        past = 0.9 * past + 0.1 * slope**2
        theta += RATE * (1 - step / steps) * slope / np.sqrt(past + 1e-6)
    return theta


def train(
    labelled: DataFrame, *, html: str = "html", main: str = "main", shares: int = SHARES, rounds: int = ROUNDS, steps: int = STEPS,
    least_pages: int = LEAST_PAGES,
) -> Model:
    """Fits the field on ``labelled`` pages: ``html`` and, for each leaf block in page order, whether it is ``main`` text (0 or 1).

    Pages are meant to be a bounded set; each of ``shares`` groups holds its share in one task. Pages whose labels do not
    fit their blocks, null pages and pages without a block are left out; none left raises. Shares go by a hash of the page,
    so the result does not depend on partitions. Features of fewer than ``least_pages`` pages are not kept.
    """
    spark = labelled.sparkSession
    small_batches(spark)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features, marks, keys = [], [], []
            for page, wanted, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = features_of(leaf_blocks(page))
                if found and len(found) == len(wanted):
                    features.append(found)
                    marks.append(wanted)
                    keys.append(key)
            kinds = (pa.list_(pa.list_(pa.string())), pa.list_(pa.int32()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((features, marks, keys), kinds)], names=["features", "marks", "key"])

    given = labelled.where(F.col(html).isNotNull() & F.col(main).isNotNull()).select(
        F.col(html).alias("html"), F.transform(main, lambda x: F.coalesce(x.cast("int"), F.lit(0))).alias("main"), F.xxhash64(html).alias("key")
    )
    pages = durable(given.mapInArrow(parse, "features array<array<string>>, marks array<int>, key bigint"))
    once = pages.select(F.explode(F.array_distinct(F.flatten("features"))).alias("f")).groupBy("f").count().where(F.col("count") >= least_pages)
    names = sorted(r["f"] for r in once.collect())
    if not names:
        raise ValueError("there is no labelled page to learn from")
    number = {f: i for i, f in enumerate(names)}
    theta = np.zeros(len(names) + 5)

    for _ in range(rounds):
        begin = theta

        def climb(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("key", kind="stable")
            share = [([[number[f] for f in block if f in number] for block in rows], list(marks)) for rows, marks in zip(group["features"], group["marks"])]
            return pd.DataFrame({"n": [len(share)], "theta": [_climb(arrange(share), begin, len(number), steps).tolist()]})

        # A set number of partitions keeps the shares side by side.
        dealt = pages.withColumn("share", F.pmod("key", F.lit(shares))).repartition(shares, "share")
        mixed = dealt.groupBy("share").applyInPandas(climb, "n bigint, theta array<double>").collect()
        mixed = sorted(mixed, key=lambda r: (r["n"], r["theta"]))
        theta = sum(r["n"] * np.array(r["theta"]) for r in mixed) / sum(r["n"] for r in mixed)
    size = len(names)
    return Model({f: float(w) for f, w in zip(names, theta[:size])}, theta[size : size + 4].reshape(2, 2).tolist(), float(theta[-1]))


def extract(pages: DataFrame, model: Model, *keep: str, html: str = "html") -> DataFrame:
    """The columns ``keep`` (all by default, but ``html`` itself) and ``text``, ``n_chars``, ``n_blocks`` of every page.

    Null and empty pages, and pages without main text, give an empty text. Equal pages give equal texts, repeated rows
    stay. Whole pages are read. Columns of the three names are replaced.
    """
    small_batches(pages.sparkSession)
    named = ("text", "n_chars", "n_blocks")
    kept = [c for c in (keep or [c for c in pages.columns if c != html]) if c not in named]
    rows = pages.select(*kept, F.col(html).alias("_page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page.as_py(), model) for page in batch.column(len(kept))]
            text, blocks = [t for t, _ in found], [n for _, n in found]
            extra = [pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()), pa.array(blocks, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *extra], names=[*kept, *named])

    added = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_blocks", T.IntegerType())]
    schema = T.StructType([*rows.select(*kept).schema.fields, *added])
    return rows.mapInArrow(run, schema)
