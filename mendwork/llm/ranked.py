"""Ranked lexical search: the exact best documents of every item by a dual-tree search over coordinate maxima.

Documents and items are sparse vectors over the terms that items hold: a document's coordinate is its saturated term
frequency, an item's the term's weight times its repeats; a score is their inner product. Documents are dealt into
shards of about ``SHARD_POSTINGS`` coordinates, items into blocks of ``BLOCK_ITEMS``; each (block, shard) is one task's
unit. There a binary hierarchy over the items and one over the documents hold in each node the largest value
of every coordinate among its members, so the inner product of two nodes bounds all scores between their members. Pairs
of nodes are taken by falling bound and split; a pair whose bound is below the weakest k-th score of its items is dropped
with all its members. All numbers are whole, so bounds and scores are exact.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mendwork.functions.durable import durable
from mendwork.functions.ranking import add_position, join_null_safe, rank_per
from mendwork.llm.batches import small_batches

# fixed values: what ends a term (ASCII but for digits and letters), and A-Z in lower case
_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_FOLD = bytes(32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
# Slots of the map of term hashes that tells tasks which terms items may hold: 128 KB whatever the items are.
SLOTS = 1 << 20
SHARD_POSTINGS = 1 << 19
BLOCK_ITEMS = 256
LEAF_ITEMS, LEAF_DOCS, MOST_LEAVES = 8, 32, 512
# One shard in so many is searched first; its k-th scores are where the others start.
FIRST_SHARDS = 8
# Sums below this are exact in doubles.
EXACT = 1 << 53

COUNTED = "row bigint, id bigint, n bigint, terms array<string>, tfs array<bigint>"
FOUND = "item bigint, doc_id bigint, score bigint"


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII digits and letters and of everything beyond ASCII, A-Z lower-cased, of a text in UTF-8."""
    return text.translate(_FOLD).split(b" ") if text else []


def count_terms(rows: DataFrame, row_id: str, text: str, slots: bytes | None = None) -> DataFrame:
    """``row`` (a number of its own), ``id``, ``n`` (terms with repeats), and distinct ``terms`` with their counts ``tfs``.

    Null texts and texts without a term give no row. With ``slots``, a bit map of term hashes, only terms whose
    bit is set are listed; ``n`` counts all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = None if slots is None else np.unpackbits(np.frombuffer(slots, np.uint8), bitorder="little").tobytes()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows, ids, totals, terms, tfs, ends = [], [], [], [], [], [0]
            for key, whole in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                counts = Counter(terms_of(whole))
                counts.pop(b"", None)
                if counts:
                    ids.append(key)
                    totals.append(counts.total())
                    kept = counts if live is None else {t: c for t, c in counts.items() if live[zlib.crc32(t) & (SLOTS - 1)]}
                    terms += kept.keys()
                    tfs += kept.values()
                    ends.append(len(terms))
                    rows.append(row)
                    row += 1
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(ids, pa.int64()), pa.array(totals, pa.int64()), *lists], names=["row", "id", "n", "terms", "tfs"])

    return rows.select(F.col(row_id).cast("bigint").alias("id"), F.coalesce(text, F.lit("")).alias("text")).mapInArrow(run, COUNTED)


def _slots(terms: DataFrame) -> bytes:
    """The bit map of the hashes of ``terms``: at most 32 rows of 4 KB reach the driver."""
    place = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit(SLOTS - 1))
    parts = terms.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    whole = np.zeros(SLOTS + 32768, np.uint8)
    for number, bits in parts:
        # Bucket 1 holds places 1 to 32768, bucket 0 place 0 alone; bit positions count from 0 within a bucket.
        found = np.flatnonzero(np.unpackbits(np.frombuffer(bytes(bits), np.uint8), bitorder="little"))
        whole[found + (number - 1) * 32768 + 1 if number > 0 else 0] = 1
    return np.packbits(whole[:SLOTS], bitorder="little").tobytes()


class Tree:
    """A binary hierarchy over ordered members: ``maxima[node]`` bounds every member of ``node``; leaves come last.

    Node ``i`` has the children ``2 i + 1`` and ``2 i + 2``; ``first[node]:last[node]`` are its members.
    """

    def __init__(self, member: np.ndarray, column: np.ndarray, value: np.ndarray, members: int, columns: int, leaf: int, dtype: type):
        leaves = 1 << max(0, int(np.ceil(np.log2(max(1, -(-members // leaf))))))
        step = -(-members // leaves)
        self.maxima = np.zeros((2 * leaves - 1, columns), dtype)
        np.maximum.at(self.maxima, (leaves - 1 + member // step, column), value)
        bounds = np.minimum(np.arange(leaves + 1) * step, members)
        self.first, self.last = np.zeros(2 * leaves - 1, np.int64), np.zeros(2 * leaves - 1, np.int64)
        self.first[leaves - 1 :], self.last[leaves - 1 :] = bounds[:-1], bounds[1:]
        for node in range(leaves - 2, -1, -1):
            left, right = 2 * node + 1, 2 * node + 2
            np.maximum(self.maxima[left], self.maxima[right], out=self.maxima[node])
            self.first[node], self.last[node] = self.first[left], self.last[right]
        self.inner = leaves - 1

    def children(self, node: int) -> list[int]:
        return [c for c in (2 * node + 1, 2 * node + 2) if self.first[c] < self.last[c]]


def _by_heaviest(member: np.ndarray, column: np.ndarray, weight: np.ndarray, members: int) -> np.ndarray:
    """For each member its place in an order in which those with the same heaviest coordinate lie together."""
    order = np.lexsort((column, -weight, member))
    head = order[np.unique(member[order], return_index=True)[1]]
    place = np.empty(members, np.int64)
    place[np.lexsort((-weight[head], column[head]))] = np.arange(members)
    return place


def search_block(items: tuple, docs: tuple, floors: np.ndarray, doc_ids: np.ndarray, k: int) -> tuple[list[list[tuple[int, int]]], int]:
    """Per item the best ``(score, doc)`` of at most ``k`` documents, and how many scores were computed.

    ``items`` and ``docs`` are coordinates ``(member, column, value)`` of members and columns counted from 0;
    ``floors[i]`` is a score that item ``i``'s k-th document is known to reach. Documents are ordered by falling
    score, then ``doc_ids``.
    """
    columns = int(items[1].max()) + 1
    n_items, n_docs = len(floors), len(doc_ids)
    heaviest = np.zeros(columns, np.int64)
    np.maximum.at(heaviest, items[1], items[2])
    dtype = np.float64 if int(heaviest.sum()) * int(docs[2].max()) < EXACT and int(np.bincount(items[0], items[2]).max()) * int(docs[2].max()) < EXACT else np.int64
    item_at = _by_heaviest(*items, n_items)
    doc_at = _by_heaviest(docs[0], docs[1], docs[2] * heaviest[docs[1]], n_docs)
    item_of, doc_of = np.argsort(item_at), np.argsort(doc_at)
    coords = item_at[items[0]], items[1], items[2]
    queries = Tree(*coords, n_items, columns, LEAF_ITEMS, dtype)
    matrix = np.zeros((n_items, columns), dtype)
    matrix[coords[0], coords[1]] = coords[2]
    order = np.argsort(doc_at[docs[0]], kind="stable")
    member, column, value = doc_at[docs[0]][order], docs[1][order], docs[2][order]
    texts = Tree(member, column, value, n_docs, columns, max(LEAF_DOCS, -(-n_docs // MOST_LEAVES)), dtype)
    starts = np.searchsorted(member, np.arange(n_docs + 1))
    ids = doc_ids[doc_of]
    kth = np.maximum(floors[item_of], 1)
    best_score = [np.zeros(0, np.int64)] * n_items
    best_doc = [np.zeros(0, np.int64)] * n_items
    heap, scored = [], 0

    def push(q: int, d: int) -> None:
        bound = int(queries.maxima[q] @ texts.maxima[d])
        if bound >= kth[queries.first[q] : queries.last[q]].min():
            heapq.heappush(heap, (-bound, q, d))

    push(0, 0)
    while heap:
        bound, q, d = heapq.heappop(heap)
        a, z = queries.first[q], queries.last[q]
        if -bound < kth[a:z].min():
            continue
        if d < texts.inner and (q >= queries.inner or texts.last[d] - texts.first[d] >= z - a):
            for child in texts.children(d):
                push(q, child)
        elif q < queries.inner:
            for child in queries.children(q):
                push(child, d)
        else:
            first, last = texts.first[d], texts.last[d]
            used = np.flatnonzero(queries.maxima[q])
            local = np.full(columns, -1)
            local[used] = np.arange(len(used))
            span = slice(starts[first], starts[last])
            col = local[column[span]]
            dense = np.zeros((last - first, len(used)), dtype)
            hit = col >= 0
            dense[member[span][hit] - first, col[hit]] = value[span][hit]
            scores = (matrix[a:z][:, used] @ dense.T).astype(np.int64)
            scored += scores.size
            for i in range(a, z):
                found = np.flatnonzero(scores[i - a] >= kth[i])
                if len(found):
                    s, m = np.append(best_score[i], scores[i - a][found]), np.append(best_doc[i], found + first)
                    top = np.lexsort((ids[m], -s))[:k]
                    best_score[i], best_doc[i] = s[top], m[top]
                    if len(top) == k:
                        kth[i] = max(kth[i], s[top[-1]])
    out: list[list[tuple[int, int]]] = [[] for _ in range(n_items)]
    for i in range(n_items):
        out[item_of[i]] = [(int(s), int(doc_of[m])) for s, m in zip(best_score[i], best_doc[i])]
    return out, scored


def _search(items: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``FOUND`` rows of every (block, shard) of ``docs``; ``items`` are dealt to all shards."""

    def run(block: pa.Table, shard: pa.Table) -> pa.Table:
        names = ["item", "doc_id", "score"]
        kinds = [pa.int64()] * 3
        if not block.num_rows or not shard.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names=names)
        col = {n: block.column(n).to_numpy() for n in ("item", "code", "weight", "floor")}
        codes, code_at = np.unique(col["code"], return_inverse=True)
        items_, first, item_at = np.unique(col["item"], return_index=True, return_inverse=True)
        rows, first_row, row_at = np.unique(shard.column("row").to_numpy(), return_index=True, return_inverse=True)
        doc_ids = shard.column("id").take(pa.array(first_row))
        order_ids = doc_ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        coords = row_at, np.searchsorted(codes, shard.column("code").to_numpy()), shard.column("value").to_numpy()
        best, _ = search_block((item_at, code_at, col["weight"]), coords, col["floor"][first], order_ids, k)
        flat = [(int(items_[i]), d, s) for i, found in enumerate(best) for s, d in found]
        item, doc, score = zip(*flat) if flat else ((), (), ())
        return pa.Table.from_arrays([pa.array(item, pa.int64()), doc_ids.take(pa.array(doc, pa.int64())).combine_chunks(), pa.array(score, pa.int64())], names=names)

    return items.groupBy("block", "shard").cogroup(docs.groupBy("block", "shard")).applyInArrow(run, FOUND)


def search(
    docs: DataFrame, items: DataFrame, *, k: int = 10, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
    item_text: str = "text", shard_postings: int = SHARD_POSTINGS, block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: every item's ``k`` best documents with a score above 0.

    With N documents that hold a term, L terms in them, n in one of them: a term of document frequency df weighs
    floor(1000 ln((2 N + 2) / (2 df + 1))); with m = 25 + (75 n N) div L, a document scores weight times
    (10^9 tf) div (1000 tf + 8 m), summed over an item's terms, repeats included. Equal scores rank by id, null ids last.

    Null texts and texts without a term match nothing. Rows of documents count each, repeated or not; items that repeat
    both id and text are one, other texts under the same id are ranked on their own. Empty tables give no row. Other
    columns are ignored. Whole texts are read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    asked = items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text")).distinct()
    asked = add_position(asked, [F.col("item_id").asc_nulls_last(), F.col("text")], name="item")
    names = asked.select("item", "item_id")
    wanted = durable(count_terms(asked, "item", "text").select(F.col("id").alias("item"), F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
        .select("item", ((F.col("item") - 1) / block_items).cast("bigint").alias("block"), F.col("t.terms").alias("term"), F.col("t.tfs").alias("repeats")))
    counted = durable(count_terms(docs, doc_id, doc_text, _slots(wanted)))
    n, total = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    terms = wanted.select("term").distinct()
    listed = counted.select("row", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("t")).select("row", "id", "n", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
    df = listed.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n + 2.0) / (2 * F.col("df") + 1).cast("double")))
    coded = add_position(terms.join(df, "term").select("term", weight.alias("w")), [F.col("term")], name="code")
    weighed = durable(wanted.join(coded, "term").where("w > 0").select("item", "block", "term", "code", (F.col("repeats") * F.col("w")).alias("weight")))
    by_block = durable(weighed.select("term", "code", "block").distinct())
    mean = F.expr(f"25 + (75 * n * {n}L) div {max(total, 1)}L")
    value = F.expr("(1000000000L * tf) div (1000 * tf + 8 * m)")
    postings = durable(listed.join(by_block, "term").withColumn("m", mean).select("block", "row", "id", "code", value.alias("value")).where("value > 0"))
    shards = max(1, -(-postings.count() // shard_postings))
    dealt = postings.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    first = F.col("shard") % FIRST_SHARDS == 0

    def block_rows(rows: DataFrame, part: list[int]) -> DataFrame:
        return rows.withColumn("shard", F.explode(F.sequence(F.lit(part[0]), F.lit(part[1]), F.lit(part[2]))))

    starting = block_rows(weighed.withColumn("floor", F.lit(0).cast("bigint")), [0, shards - 1, FIRST_SHARDS] if shards > 1 else [0, 0, 1])
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    found = durable(rank_per(_search(starting, dealt.where(first), k), ["item"], best, k, "rank"))
    if shards > 1:
        floors = found.where(F.col("rank") == k).select("item", F.col("score").alias("floor"))
        raised = durable(weighed.join(floors, "item", "left").withColumn("floor", F.coalesce("floor", F.lit(0).cast("bigint"))))
        others = _search(block_rows(raised, [0, shards - 1, 1]).where(~first), dealt.where(~first), k)
        found = rank_per(found.drop("rank").unionByName(others), ["item"], best, k, "rank")
    return join_null_safe(found, names, ["item"]).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
