"""Near-duplicates by SimHash and the Jaccard similarity of their word shingles, decided on the shingles themselves.

Candidates come from the whole table, in two ways. The distinct SimHash fingerprints are joined by the binary tries of
:mod:`mendwork.llm.simhash`, which links all that differ in at most ``TRIE_BITS`` bits; texts of one fingerprint are linked too.
Texts of similarity 0.8 mostly differ in more bits than a trie can prune, so there are further ones: rows that agree in one of ``BANDS`` keys of ``BAND_ROWS`` minimum hashes each are
sorted by SimHash inside their key and meet the ``WINDOW`` rows before them, if their fingerprints are within ``NEAR_BITS``.
Two sets of similarity s share a key with probability 1 - (1 - s^5)^20: 0.9996 at 0.8. Then both texts are read, and
a pair links if its similarity is at least the wanted one. First each row is held against its nearest candidate;
of the other candidates only those are left that are not yet in one component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendwork.functions.durable import durable
from mendwork.functions.ranking import add_position
from mendwork.llm.batches import small_batches
from mendwork.llm.simhash import SEED, components, majority, shingle_hashes, shingles
from mendwork.llm.simhash import links as simhash_links

BANDS = 20
BAND_ROWS = 5
WINDOW = 3
# Of 64; sets of similarity 0.8 differ in about 10.
NEAR_BITS = 24
# Fingerprints this near are linked by the trie join, whatever their keys.
TRIE_BITS = 4
# Sorted rows that a task scans at once.
BLOCK = 1 << 15
_DRAWS = np.random.default_rng(SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS, 1), np.uint64, endpoint=False)
_TIMES, _PLUS = _DRAWS[0] | np.uint64(1), _DRAWS[1]


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One signed key a band of a set of hashes; no key for an empty set."""
    import xxhash

    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1 << 12):
        np.minimum(least, (hashes[at : at + (1 << 12)] * _TIMES + _PLUS).min(axis=1), out=least)
    found = [xxhash.xxh64_intdigest(rows.tobytes(), band) for band, rows in enumerate(least.reshape(BANDS, BAND_ROWS))]
    return np.array(found, np.uint64).view(np.int64)


def similar(a: str | None, b: str | None, fifths: int = 4, shingle_words: int = 5) -> bool:
    """Whether the shingle sets of two texts have a similarity of at least ``fifths`` / 5. Texts without words are alike."""
    x, y = set(shingles(a, shingle_words)), set(shingles(b, shingle_words))
    both = len(x & y)
    return 5 * both >= fifths * (len(x) + len(y) - both)


def _sketches(rows: DataFrame, shingle_words: int) -> DataFrame:
    """``place``, ``digest`` of the shingle set, ``fp`` and ``keys`` of ``(place, text)``. No shuffle."""
    small_batches(rows.sparkSession)
    schema = T.StructType(
        [
            rows.schema["place"],
            T.StructField("digest", T.BinaryType()),
            T.StructField("fp", T.LongType()),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, prints, keys = [], [], []
            for text in batch.column(1):
                hashes = shingle_hashes(text.as_py(), shingle_words)
                own = np.unique(hashes)
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                prints.append(majority(hashes))
                keys.append(band_keys(own))
            columns = [
                batch.column(0),
                pa.array(digests, pa.binary()),
                pa.array(np.array(prints, np.uint64).view(np.int64)),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "digest", "fp", "keys"])

    return rows.select("place", "text").mapInArrow(sketch, schema)


def candidates(nodes: DataFrame, *, window: int = WINDOW, near_bits: int = NEAR_BITS, block: int = BLOCK) -> DataFrame:
    """Distinct pairs ``(u, v, bits)`` of the ``row`` of ``nodes`` that share a key and are near in its sorted order.

    Rows are numbered by (key, fp, row), so a hot key spreads over many tasks. A block of numbers takes along the last
    ``window`` rows of the block before, so no pair is lost at its edge.
    """
    keyed = nodes.select("row", "fp", F.explode("keys").alias("key"))
    placed = add_position(keyed, [F.col("key"), F.col("fp"), F.col("row")], name="at")
    own = F.floor(F.col("at") / block)
    also = F.when(F.pmod("at", F.lit(block)) >= block - window, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = placed.select("key", "fp", "row", "at", F.explode(also).alias("block"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            rows, new = np.concatenate([held, rows]), len(held)
            held = rows[-window:]
            for back in range(1, min(window, len(rows) - 1) + 1):
                later = np.arange(max(new, back), len(rows))
                a, b = rows[later - back], rows[later]
                bits = np.bitwise_count((a[:, 2] ^ b[:, 2]).view(np.uint64)).astype(np.int64)
                good = (a[:, :2] == b[:, :2]).all(axis=1) & (bits <= near_bits)
                ends = [pa.array(a[good, 3]), pa.array(b[good, 3]), pa.array(bits[good])]
                yield pa.RecordBatch.from_arrays(ends, names=["u", "v", "bits"])

    together = dealt.repartition("block").sortWithinPartitions("block", "at").select("block", "key", "fp", "row")
    return together.mapInArrow(scan, "u bigint, v bigint, bits bigint").distinct()


def trie_links(nodes: DataFrame, *, budget: int = TRIE_BITS) -> DataFrame:
    """Pairs ``(u, v, bits)`` of the ``row`` of ``nodes`` that connect all whose ``fp`` are reachable over steps of ``budget`` bits.

    A fingerprint stands for its smallest row; its other rows hang on that one, and what the trie join links are these.
    """
    named = durable(nodes.groupBy("fp").agg(F.min("row").alias("first")))
    same = nodes.select("row", "fp").join(named, "fp").where(F.col("row") > F.col("first")).select(F.col("first").alias("u"), F.col("row").alias("v"), F.lit(0).cast("bigint").alias("bits"))
    end = lambda e: named.select(F.col("fp").alias(e), F.col("first").alias(f"{e}_row"))
    met = simhash_links(named.select("fp"), budget=budget).distinct().join(end("u"), "u").join(end("v"), "v")
    bits = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))).cast("bigint")
    near = met.select(F.least("u_row", "v_row").alias("u"), F.greatest("u_row", "v_row").alias("v"), bits.alias("bits"))
    return same.unionByName(near)


def _verified(pairs: DataFrame, texts: DataFrame, fifths: int, shingle_words: int) -> DataFrame:
    """The ``(u, v)`` whose texts are similar enough."""
    small_batches(pairs.sparkSession)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similar(a.as_py(), b.as_py(), fifths, shingle_words) for a, b in zip(batch.column(2), batch.column(3))]
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:2], names=["u", "v"])

    first = pairs.join(texts.select(F.col("row").alias("u"), F.col("text").alias("a")), "u")
    both = first.join(texts.select(F.col("row").alias("v"), F.col("text").alias("b")), "v")
    return both.select("u", "v", "a", "b").mapInArrow(check, "u bigint, v bigint")


def deduplicate(
    docs: DataFrame, *, fifths: int = 4, shingle_words: int = 5, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component of texts of at least ``fifths`` / 5 similarity: the smallest id (null ids last).

    Rows are told apart by a stored row number, so of rows that repeat an id one stays as well. Rows with the same
    shingle set are one node from the start; texts without words, null ones among them, are one such set.
    """
    numbered = durable(docs.withColumn("_row", F.monotonically_increasing_id()))
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("_row").alias("row"))
    sketches = _sketches(numbered.select(order.alias("place"), F.col(text).alias("text")), shingle_words)
    grouped = sketches.groupBy("digest").agg(F.min(F.struct("place", "fp", "keys")).alias("n"))
    nodes = durable(grouped.select(F.col("n.place.row").alias("row"), F.col("n.place").alias("place"), "n.fp", "n.keys"))
    pairs = durable(candidates(nodes, window=window).unionByName(trie_links(nodes)).distinct())
    ends = pairs.select(F.explode(F.array("u", "v")).alias("row")).distinct()
    texts = durable(numbered.select(F.col("_row").alias("row"), F.col(text).alias("text")).join(ends, "row"))
    nearest = pairs.groupBy("v").agg(F.min(F.struct("bits", "u")).alias("n")).select("n.u", "v")
    edges = durable(_verified(nearest, texts, fifths, shingle_words))
    roots = components(edges)
    at = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
    apart = pairs.select("u", "v").join(at("u"), "u", "left").join(at("v"), "v", "left")
    apart = apart.where(F.coalesce("u_root", "u") != F.coalesce("v_root", "v")).select("u", "v")
    more = durable(_verified(apart, texts, fifths, shingle_words))
    roots = components(edges.union(more)).withColumnRenamed("node", "row")
    hung = nodes.select("row", "place").join(roots, "row", "left").select("place", F.coalesce("root", "row").alias("root"))
    kept = hung.groupBy("root").agg(F.min("place").alias("place")).select(F.col("place.row").alias("_row"))
    return numbered.join(kept, "_row", "left_semi").drop("_row")
