"""Line dedup: windows of three consecutive lines that occur more than once lose all but their first occurrence."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendwork.functions.durable import durable
from mendwork.functions.ranking import join_null_safe
from mendwork.llm.batches import small_batches

WINDOW_LINES = 3


def _window_hashes(lines: Column, size: int) -> Column:
    """``(pos, h1, h2)`` of every window that holds more than white space; a shorter text is one window of all lines.

    Each half of the 128-bit hash chains over the lines from a start of its own.
    """

    def at(i: Column) -> Column:
        parts = [F.get(lines, i + k) for k in range(size)]
        blank = F.concat_ws("", *parts).rlike(r"^\s*$")
        halves = [F.xxhash64(F.lit(salt), F.least(F.size(lines), F.lit(size)), *parts) for salt in (1, 2)]
        return F.struct(i.alias("pos"), halves[0].alias("h1"), halves[1].alias("h2"), blank.alias("blank"))

    last = F.greatest(F.size(lines) - size, F.lit(0))
    return F.filter(F.transform(F.sequence(F.lit(0), last), at), lambda w: ~w["blank"])


def repeated_positions(docs: DataFrame, *, size: int = WINDOW_LINES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Where repeated windows start, but for the first occurrence of each: ``doc_id``, ``th`` (text hash), ``starts``.

    The first occurrence is the one with the smallest (id, text hash, line); null ids come last. Windows are
    counted before they are shuffled, and joined to the repeated ones by a join that splits hot keys.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("th"), F.split(text, "\n").alias("lines"))
    found = rows.where("lines is not null").select("doc_id", "th", F.explode(_window_hashes(F.col("lines"), size)).alias("w"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", F.col("w.pos").alias("pos"))
    windows = durable(found.select(F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2"), place.alias("place")))
    firsts = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).where("n > 1")
    later = windows.join(firsts.select("h1", "h2", "first"), ["h1", "h2"]).where(F.col("place") > F.col("first"))
    return later.groupBy("place.doc_id", "place.th").agg(F.collect_set("place.pos").alias("starts"))


def remove_repeated(docs: DataFrame, *, size: int = WINDOW_LINES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lines removed that later occurrences of repeated windows cover, and ``n_lines``, ``n_removed``.

    Covered positions of overlapping windows are merged. Every removed line has an earlier occurrence that stays.
    A text of fewer than ``size`` lines is one window of its own length; windows of white space alone do not count.
    Null texts stay null (no lines); a text that loses all lines becomes empty. Rows that repeat both id and text
    are one document and keep the same lines. Columns named ``n_lines`` or ``n_removed`` are replaced.
    """
    small_batches(docs.sparkSession)
    starts = repeated_positions(docs, size=size, doc_id=doc_id, text=text).withColumnsRenamed({"doc_id": "_id", "th": "_th", "starts": "_starts"})
    keyed = docs.drop("n_lines", "n_removed").withColumns({"_id": F.col(doc_id), "_th": F.xxhash64(text)})
    joined = join_null_safe(keyed, starts, ["_id", "_th"], "left").drop("_id", "_th")
    names = [c for c in joined.columns if c != "_starts"]
    counts = [T.StructField(n, T.IntegerType()) for n in ("n_lines", "n_removed")]
    schema = T.StructType([*joined.select(*names).schema.fields, *counts])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text)
        for batch in batches:
            kept, total, gone = [], [], []
            for whole, begin in zip(batch.column(at), batch.column(len(names))):
                whole, begin = whole.as_py(), begin.as_py()
                lines = [] if whole is None else whole.split("\n")
                covered = np.zeros(len(lines) + size + 1, np.int64)
                if begin:
                    # Each start opens a cover and closes it ``size`` lines on; the running sum merges overlaps.
                    np.add.at(covered, np.asarray(begin), 1)
                    np.add.at(covered, np.asarray(begin) + size, -1)
                    stays = np.cumsum(covered)[: len(lines)] == 0
                    kept.append("\n".join([x for x, k in zip(lines, stays) if k]))
                    gone.append(len(lines) - int(stays.sum()))
                else:
                    kept.append(whole)
                    gone.append(0)
                total.append(len(lines))
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int32()), pa.array(gone, pa.int32())], names=[*names, "n_lines", "n_removed"])

    return joined.select(*names, "_starts").mapInArrow(cut, schema)
