"""SimHash near-duplicates: fingerprints of word shingles, linked by a self-join of binary tries.

Fingerprints that differ in at most ``budget`` of 64 bits agree on all but ``budget`` of any set of bit blocks, so
each is dealt into one bucket for every choice of agreeing blocks. A bucket's sorted fingerprints are a binary
trie: a node is a range with a common prefix. Pairs of nodes are walked together; the bits in which their prefixes
differ are counted, and a pair is dropped once it exceeds the budget, or once both nodes are known to be in one
component. What leaves a bucket is a spanning forest, never all pairs; forests are merged by alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendwork.functions.durable import durable
from mendwork.llm.batches import small_batches

BITS = 64
SEED = 42
# Fingerprints a task walks at once; larger buckets are split into pairs of salted parts.
BUCKET_ROWS = 1 << 16
# Rows expected in a bucket when fingerprints are even: beyond it, buckets agree on more blocks.
EVEN_ROWS = 1 << 12
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_FRONT = 1 << 17
_LEAF_PAIRS = 64


def shingles(text: str | None, shingle_words: int) -> list[bytes]:
    """Runs of ``shingle_words`` lower-cased words, repeats included; a shorter text is one run."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) < shingle_words:
        return [joined]
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    return [joined[a:b] for a, b in zip([0, *[e + 1 for e in ends]], ends[shingle_words - 1 :])]


def shingle_hashes(text: str | None, shingle_words: int) -> np.ndarray:
    import xxhash

    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(s, SEED) for s in shingles(text, shingle_words)], "<u8")


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes; zero for none."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """The unsigned 64-bit SimHash of a whole text; zero for a text without words."""
    return majority(shingle_hashes(text, shingle_words))


def fingerprints(docs: DataFrame, *keys: str, text: str = "text", shingle_words: int = 4) -> DataFrame:
    """``keys`` and ``fp``, the fingerprint as a signed long. Null texts have no words. No shuffle."""
    small_batches(docs.sparkSession)
    schema = T.StructType([*docs.select(*keys).schema.fields, T.StructField("fp", T.LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(len(keys))], np.uint64)
            columns = [*batch.columns[: len(keys)], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "fp"])

    return docs.select(*keys, F.col(text)).mapInArrow(hashed, schema)


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First row of each range whose bit at ``depth`` (from the top) is set, by bisection of all ranges at once."""
    low, high = lo.copy(), hi.copy()
    bit = np.uint64(1) << (63 - depth).astype(np.uint64)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        one = (keys[np.minimum(mid, len(keys) - 1)] & bit) != 0
        high = np.where(open_ & one, mid, high)
        low = np.where(open_ & ~one, mid + 1, low)
    return low


def _prefix(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Bits that all keys of a sorted range share; 64 for a single key."""
    differ = keys[lo] ^ keys[hi - 1]
    for shift in (1, 2, 4, 8, 16, 32):
        differ |= differ >> np.uint64(shift)
    return BITS - np.bitwise_count(differ).astype(np.int64)


def trie_components(keys: np.ndarray, starts: np.ndarray, budget: int) -> np.ndarray:
    """Component of every key: the smallest row linked to it within its bucket.

    ``keys`` are unsigned and sorted inside each bucket; ``starts`` are the buckets' first rows. The frontier of
    node pairs is a stack of slices, so its memory stays bounded.
    """
    n = len(keys)
    root = np.arange(n)
    ends = np.append(starts[1:], n)
    run_end = np.arange(1, n + 1)
    stack = [(starts, ends, starts, ends)]

    def unite(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal root, run_end
        pairs = np.unique(np.sort(np.stack([root[a], root[b]], axis=1), axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        if not len(pairs):
            return
        parent = root.copy()

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in pairs.tolist():
            x, y = top(x), top(y)
            parent[max(x, y)] = min(x, y)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        root = parent
        last = np.append(np.flatnonzero(np.diff(root)), n - 1)
        run_end = last[np.searchsorted(last, np.arange(n))] + 1

    while stack:
        alo, ahi, blo, bhi = stack.pop()
        if len(alo) > _FRONT:
            stack.append((alo[_FRONT:], ahi[_FRONT:], blo[_FRONT:], bhi[_FRONT:]))
            alo, ahi, blo, bhi = alo[:_FRONT], ahi[:_FRONT], blo[:_FRONT], bhi[:_FRONT]
        one = (run_end[alo] >= ahi) & (run_end[blo] >= bhi) & (root[alo] == root[blo])
        pa_, pb = _prefix(keys, alo, ahi), _prefix(keys, blo, bhi)
        shared = np.minimum(pa_, pb)
        differ = keys[alo] ^ keys[blo]
        cut = np.where(shared == 0, np.uint64(0), differ >> (BITS - np.maximum(shared, 1)).astype(np.uint64))
        keep = ~one & (np.bitwise_count(cut) <= budget)
        alo, ahi, blo, bhi, pa_, pb = (x[keep] for x in (alo, ahi, blo, bhi, pa_, pb))
        size_a, size_b = ahi - alo, bhi - blo
        leaf = size_a * size_b <= _LEAF_PAIRS
        if leaf.any():
            pairs = (size_a * size_b)[leaf]
            node = np.repeat(np.flatnonzero(leaf), pairs)
            turn = np.arange(len(node)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            a, b = alo[node] + turn // size_b[node], blo[node] + turn % size_b[node]
            near = np.bitwise_count(keys[a] ^ keys[b]) <= budget
            unite(a[near], b[near])
        deep = ~leaf
        if not deep.any():
            continue
        alo, ahi, blo, bhi, pa_, pb = (x[deep] for x in (alo, ahi, blo, bhi, pa_, pb))
        same = alo == blo
        # The node with the shorter prefix branches first; a node paired with itself gives three pairs.
        swap = ~same & (pb < pa_)
        alo, blo, ahi, bhi = np.where(swap, blo, alo), np.where(swap, alo, blo), np.where(swap, bhi, ahi), np.where(swap, ahi, bhi)
        mid = _split(keys, alo, ahi, np.minimum(pa_, pb))
        s, d = same, ~same
        across = tuple(np.concatenate(x) for x in (
            (alo[s], alo[d], mid[d]), (mid[s], mid[d], ahi[d]), (mid[s], blo[d], blo[d]), (ahi[s], bhi[d], bhi[d])))
        within = tuple(np.concatenate(x) for x in ((alo[s], mid[s]), (mid[s], ahi[s])))
        if len(across[0]):
            stack.append(across)
        if len(within[0]):
            stack.append((*within, *within))
    return root


def _masks(blocks: int, budget: int) -> list[int]:
    """Masks of the blocks that must agree, one for each choice of ``blocks - budget`` of them."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(block, blocks - budget)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def links(nodes: DataFrame, *, budget: int = 4, bucket_rows: int = BUCKET_ROWS, even_rows: int = EVEN_ROWS) -> DataFrame:
    """Edges ``(u, v)`` that connect the distinct ``fp`` of ``nodes`` exactly as all pairs within ``budget`` would.

    Blocks are as few as keep an even bucket below ``even_rows``. A bucket above ``bucket_rows`` is dealt by hash
    into parts, and each pair of parts is a task of its own: every pair of fingerprints still meets.
    """
    count = nodes.count()
    blocks = budget + 1
    while blocks < 2 * budget and count >> (BITS * (blocks - budget) // blocks) > even_rows:
        blocks += 1
    tables = F.array(
        *[F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(_masks(blocks, budget))]
    )
    dealt = nodes.select("fp", F.explode(tables).alias("b")).select("fp", "b.table", "b.key")
    loads = dealt.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
    loads = durable(loads.select("table", "key", F.ceil(2 * F.col("n") / bucket_rows).cast("int").alias("parts")))
    if loads.isEmpty():
        spread = dealt.withColumn("part", F.lit(0).cast("bigint"))
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        other = F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)
        code = F.when(F.col("parts").isNull(), F.lit(0).cast("bigint")).otherwise(
            F.least("own", "other").cast("bigint") * F.col("parts") + F.greatest("own", "other")
        )
        spread = (
            dealt.join(loads, ["table", "key"], "left")
            .withColumn("own", own)
            .withColumn("other", F.explode(other))
            .select("fp", "table", "key", code.alias("part"))
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def done(rows: np.ndarray) -> pa.RecordBatch:
            fp = rows[:, 3].view(np.uint64)
            bucket = np.cumsum(np.append(0, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))
            order = np.lexsort((fp, bucket))
            keys, bucket = fp[order], bucket[order]
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            root = trie_components(keys, starts, budget)
            off = np.flatnonzero(root != np.arange(len(root)))
            ends = [pa.array(keys[off].view(np.int64)), pa.array(keys[root[off]].view(np.int64))]
            return pa.RecordBatch.from_arrays(ends, names=["u", "v"])

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1))
            if sum(map(len, held)) >= bucket_rows:
                rows = np.concatenate(held)
                last = rows[-1, :3]
                cut = len(rows) - int(np.argmin((rows[::-1, :3] == last).all(axis=1))) if not (rows[:, :3] == last).all() else 0
                held = [rows[cut:]]
                if cut:
                    yield done(rows[:cut])
        if held and sum(map(len, held)):
            yield done(np.concatenate(held))

    keyed = spread.select(F.col("table").cast("bigint"), "key", "part", "fp")
    together = keyed.repartition("table", "key", "part").sortWithinPartitions("table", "key", "part")
    return together.mapInArrow(walk, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the edges ``(u, v)``: the smallest node it is connected to.

    Alternating large and small stars: neighbours are re-hung on the smallest neighbour until nothing changes, in
    a number of rounds that grows with the logarithm of the largest component. Every round is stored.
    """

    def smallest(of: DataFrame) -> DataFrame:
        return of.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))

    def state(of: DataFrame) -> tuple:
        return tuple(of.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    downward: Column = F.col("u") > F.col("v")
    now = durable(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = state(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where("v > u").join(smallest(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = durable(large.where(downward).distinct())
        low = smallest(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = durable(small.where(downward).distinct())
        if (new := state(now)) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = new


def _mapped(prints: DataFrame, rep: Column, budget: int, bucket_rows: int) -> DataFrame:
    """``(fp, component)`` of every distinct fingerprint; a component is named by the smallest ``rep`` in it."""
    nodes = durable(prints.groupBy("fp").agg(F.min(rep).alias("rep")))
    roots = components(links(nodes.select("fp"), budget=budget, bucket_rows=bucket_rows))
    hung = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root")
    )
    names = hung.groupBy("root").agg(F.min("rep").alias("component"))
    return hung.join(names, "root").select("fp", "component")


def near_duplicates(
    docs: DataFrame, *, budget: int = 4, shingle_words: int = 4, bucket_rows: int = BUCKET_ROWS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed) and ``component_id``, the smallest id reachable over links.

    Texts without words, null ones among them, have fingerprint zero and link like any other. A row with a null
    id takes part; its component is named by the smallest id that is not null (null if there is none). Repeated
    rows are in one component. Other columns are not read. An empty table gives an empty result.
    """
    prints = durable(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", shingle_words=shingle_words))
    mapped = _mapped(prints, F.col("doc_id"), budget, bucket_rows)
    return prints.join(mapped, "fp").select("doc_id", "fp", F.col("component").alias("component_id"))


def deduplicate(
    docs: DataFrame, *, budget: int = 4, shingle_words: int = 4, bucket_rows: int = BUCKET_ROWS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null ids last).

    Rows are told apart by a stored row number, so of rows that repeat an id one stays as well.
    """
    numbered = durable(docs.withColumn("_row", F.monotonically_increasing_id()))
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("_row").alias("row"))
    rows = numbered.select(order.alias("place"), F.col(text).alias("text"))
    prints = durable(fingerprints(rows, "place", shingle_words=shingle_words))
    kept = _mapped(prints, F.col("place"), budget, bucket_rows).select(F.col("component.row").alias("_row")).distinct()
    return numbered.join(kept, "_row", "left_semi").drop("_row")
