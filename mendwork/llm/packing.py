"""Vector best-fit packing of token pieces into sequences.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece lengths, since
pieces attend only to themselves). A piece is put where it fits under all three and scores best.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendwork.functions.durable import durable
from mendwork.llm.batches import small_batches
from mendwork.llm.encoding import default_tokenizer, encoder

# Pieces that one task packs together: a few MB, and enough that the one unfilled sequence at its end is nothing.
GROUP_PIECES = 1 << 17


class Capacity(NamedTuple):
    """What one sequence holds. The defaults of ``docs`` and ``attention`` are what ``tokens`` alone allows."""

    tokens: int = 2048
    docs: int | None = None
    attention: int | None = None

    def vector(self) -> np.ndarray:
        docs = self.tokens if self.docs is None else self.docs
        attention = self.tokens**2 if self.attention is None else self.attention
        if min(self.tokens, docs, attention) < 1:
            raise ValueError("capacities are positive")
        return np.array([self.tokens, docs, attention], np.int64)


def best_fit(
    lengths: np.ndarray,
    capacity: Capacity = Capacity(),
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece. Longest pieces go first; equal lengths are one class with one demand vector.

    ``norm`` picks the bin whose residual, as shares of the capacities, has the smallest weighted norm after
    placement; ``dot`` the bin whose residual has the largest weighted dot product with the demand. Under
    ``norm`` a bin that took a piece stays the best while it has room, so a class fills bins in one order; under
    ``dot`` every piece is placed by itself. Ties go to the older bin.
    """
    full = capacity.vector()
    scale = np.asarray(weights, float) / full.astype(float) ** 2
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    room = np.zeros((0, 3), np.int64)  # of bins that may still take a piece
    name = np.zeros(0, np.int64)
    made = 0
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for members in np.split(order, cuts) if len(order) else []:
        length = int(lengths[members[0]])
        need = np.array([length, 1, length * length], np.int64)
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity")
        need_or_one = np.maximum(need, 1)
        at = 0
        while at < len(members):
            fits = np.flatnonzero((room >= need).all(axis=1))
            if not len(fits):
                break
            if rule == "norm":
                left = room[fits] - need
                ranked = fits[np.argsort((left.astype(float) ** 2) @ scale, kind="stable")]
                takes = (room[ranked] // need_or_one)[:, need > 0].min(axis=1)
            else:
                ranked = fits[[np.argmax((room[fits].astype(float) * need) @ scale)]]
                takes = np.ones(1, np.int64)
            takes = np.minimum(takes, np.maximum(len(members) - at - (np.cumsum(takes) - takes), 0))
            took = np.repeat(ranked, takes)
            turn = np.arange(len(took)) - np.repeat(np.cumsum(takes) - takes, takes)
            chosen = members[at : at + len(took)]
            bins[chosen] = name[took]
            offsets[chosen] = full[0] - room[took, 0] + turn * length
            room[ranked] -= takes[:, None] * need
            at += len(took)
        rest = members[at:]
        if len(rest):
            per = int((full // need_or_one)[need > 0].min())
            place = np.arange(len(rest))
            bins[rest], offsets[rest] = made + place // per, place % per * length
            opened = -(-len(rest) // per)
            took = np.full(opened, per)
            took[-1] = len(rest) - per * (opened - 1)
            room = np.concatenate([room, full - took[:, None] * need])
            name = np.concatenate([name, made + np.arange(opened)])
            made += opened
        live = (room > 0).all(axis=1)
        room, name = room[live], name[live]
    return bins, offsets


def cut_pieces(
    docs: DataFrame,
    *,
    tokens: int = 2048,
    tokenizer: str | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of every whole document: its ids and the end id, cut into ``tokens`` ids where it is longer.

    Only the first piece may be shorter. Columns: ``doc_id``, ``piece`` (from 0), ``start`` (ids of the document
    before the piece), ``length``, ``ids_crc32`` and, with ``keep_ids``, the ``ids``. Null texts are empty: one
    piece with the end id. One pass over the texts, without a shuffle.
    """
    small_batches(docs.sparkSession)
    path = tokenizer or default_tokenizer()
    out = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        + ([("ids", pa.list_(pa.int64()))] if keep_ids else [])
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for name, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode.document(words.as_py())
                edges = [0, *range(len(ids) % tokens or tokens, len(ids) + 1, tokens)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = np.ascontiguousarray(ids[a:b])
                    rows.append((name, k, a, b - a, zlib.crc32(part), *([part.astype(np.int64)] if keep_ids else [])))
            columns = list(zip(*rows)) or [()] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    sql = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<bigint>" if keep_ids else "")
    return docs.select(F.col(doc_id).cast("bigint"), F.col(text)).mapInArrow(cut, sql)


def pack_pieces(
    pieces: DataFrame,
    *,
    capacity: Capacity = Capacity(),
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3),
    rule: str = "norm",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``pieces`` (any columns, one of them ``length``) with ``sequence_id`` and ``offset``.

    Pieces are dealt into groups of about ``group_pieces`` by the hash of a row number, whatever their document,
    so copies and hot documents spread evenly; each group is packed by :func:`best_fit` on its own and wastes
    less than one sequence. Only row number and length are shuffled into groups; the result is joined back on
    the row number. ``pieces`` is stored once, so the row numbers hold on both sides. An empty table packs into
    no sequence; ties and repeated rows are separate pieces.
    """
    numbered = durable(pieces.withColumn("_row", F.monotonically_increasing_id()))
    groups = max(1, -(-numbered.count() // group_pieces))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_row", ignore_index=True)
        bins, offsets = best_fit(group["length"].to_numpy(np.int64), capacity, weights, rule)
        return pd.DataFrame({"_row": group["_row"], "sequence_id": group["_group"] * (1 << 32) + bins, "offset": offsets})

    dealt = numbered.select("_row", "length", F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("_group"))
    placed = dealt.groupBy("_group").applyInPandas(pack, "_row bigint, sequence_id bigint, offset bigint")
    return numbered.join(placed, "_row").drop("_row")


def pack_documents(docs: DataFrame, *, capacity: Capacity = Capacity(), tokenizer: str | None = None, **columns: str) -> DataFrame:
    """Whole documents, cut only where longer than a sequence, packed into sequences.

    One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.
    Null ids are kept as such, null texts are empty, and other columns are not read.
    """
    return pack_pieces(cut_pieces(docs, tokens=capacity.tokens, tokenizer=tokenizer, **columns), capacity=capacity)
