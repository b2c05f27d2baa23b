"""Token ids in files: fixed-size id blocks transposed into bit or byte planes, each compressed, with an index.

A token folder holds three tables.

``chunks``
    One row per chunk of whole documents: ``shard``, ``chunk``, ``unit``, ``block_ids``, ``n_ids``, ``planes``
    (one zstandard frame per plane) and, as the chunk index, ``doc_ids`` and ``lengths`` (ids of each document,
    end id included). Ids are laid out in blocks of ``block_ids``, the last padded with zeros; a plane holds the
    same bit (or byte) of every id, block after block.
``shards``
    One row per shard: its ids, and the ids of all shards before it.
``format``
    One row: version, tokenizer path.

Documents are in ascending order of id: shards in order, chunks in order, documents in order within a chunk.
Every file is written by Spark's own committer, so a lost or repeated task leaves no half-written file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mendwork.llm.batches import small_batches
from mendwork.llm.encoding import default_tokenizer, encoder

BLOCK_IDS = 4096
CHUNK_IDS = 1 << 18
LEVEL = 3
_WIDTH = {"byte": 4, "bit": 32}

CHUNK_SCHEMA = (
    "shard int, chunk int, unit string, block_ids int, n_ids bigint, doc_ids array<bigint>, "
    "lengths array<bigint>, planes array<binary>"
)
_CHUNK_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("chunk", pa.int32()), ("unit", pa.string()), ("block_ids", pa.int32()),
        ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
        ("planes", pa.list_(pa.binary())),
    ]
)


def to_planes(ids: np.ndarray, unit: str = "byte", block_ids: int = BLOCK_IDS) -> list[bytes]:
    """Planes of ``ids`` (unsigned 32-bit), lowest bit or byte first, over zero-padded blocks."""
    width = _WIDTH[unit]
    blocks = -(-len(ids) // block_ids)
    padded = np.zeros(blocks * block_ids, "<u4")
    padded[: len(ids)] = ids
    if unit == "byte":
        return [np.ascontiguousarray(padded.view(np.uint8).reshape(-1, width)[:, p]).tobytes() for p in range(width)]
    return [np.packbits((padded >> np.uint32(p)).astype(np.uint8) & 1, bitorder="little").tobytes() for p in range(width)]


def from_planes(planes: list[bytes], n_ids: int, unit: str = "byte") -> np.ndarray:
    """The ids that :func:`to_planes` was given."""
    if unit == "byte":
        ids = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).reshape(-1).view("<u4")
        return ids[:n_ids]
    ids = np.zeros(len(planes[0]) * 8, "<u4")
    for bit, plane in enumerate(planes):
        ids |= np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little").astype("<u4") << np.uint32(bit)
    return ids[:n_ids]


def write_tokens(
    docs: DataFrame,
    folder: str,
    *,
    tokenizer: str | None = None,
    unit: str = "byte",
    block_ids: int = BLOCK_IDS,
    chunk_ids: int = CHUNK_IDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every whole text, append the end id, and write a token folder in ascending order of ``doc_id``.

    Null texts are empty and give the end id alone. A null ``doc_id`` sorts last; rows that repeat an id follow
    each other in an order fixed by their text. Other columns are not read, whatever their names. An empty
    table gives a folder without chunks.
    ``docs`` is range partitioned by (id, text hash) once; a shard is what one task wrote, and only one chunk
    (``chunk_ids`` ids, or one longer document) is in memory at a time.
    """
    if unit not in _WIDTH or block_ids % 8:
        raise ValueError("unit is 'byte' or 'bit'; block_ids is a multiple of 8")
    small_batches(docs.sparkSession)
    path = tokenizer or default_tokenizer()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press, encode = zstandard.ZstdCompressor(level=LEVEL), encoder(path)
        shard, chunk = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def full() -> pa.RecordBatch:
            planes = [press.compress(p) for p in to_planes(np.concatenate(parts), unit, block_ids)]
            row = [shard, chunk, unit, block_ids, held, names, [len(p) for p in parts], planes]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _CHUNK_ARROW)], schema=_CHUNK_ARROW)

        for batch in batches:
            for name, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode.document(words.as_py())
                names.append(name)
                parts.append(ids)
                held += len(ids)
                if held >= chunk_ids:
                    yield full()
                    names, parts, held, chunk = [], [], 0, chunk + 1
        if parts:
            yield full()

    keyed = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("words"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("words").asc(), F.col("words").asc()]
    ordered = keyed.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    chunks = ordered.mapInArrow(write, CHUNK_SCHEMA)
    chunks.write.mode("overwrite").option("compression", "uncompressed").parquet(f"{folder}/chunks")
    spark = docs.sparkSession
    totals = spark.read.schema(CHUNK_SCHEMA).parquet(f"{folder}/chunks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    # One row per shard that was written, so the running total is over as many rows as there were tasks.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("shard", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before")).write.mode(
        "overwrite"
    ).parquet(f"{folder}/shards")
    spark.range(1).select(F.lit(1).alias("version"), F.lit(path).alias("tokenizer")).write.mode("overwrite").parquet(
        f"{folder}/format"
    )


def read_tokens(spark: SparkSession, folder: str, *, keep_ids: bool = True) -> DataFrame:
    """Documents of a token folder: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` (end id
    included), ``ids_crc32`` (unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers) and, with
    ``keep_ids``, the ``ids``. Chunks hold whole documents, so every chunk is decoded on its own.
    """
    fields = [
        ("doc_id", pa.int64()), ("shard", pa.int32()), ("chunk", pa.int32()), ("at", pa.int64()),
        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
    ] + ([("ids", pa.list_(pa.int64()))] if keep_ids else [])
    out = pa.schema(fields)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                ids = from_planes([unpress.decompress(p) for p in chunk["planes"]], chunk["n_ids"], chunk["unit"])
                lengths = np.asarray(chunk["lengths"], np.int64)
                ends = np.cumsum(lengths)
                parts = [ids[e - n : e] for n, e in zip(lengths, ends)]
                n = len(parts)
                columns = [chunk["doc_ids"], [chunk["shard"]] * n, [chunk["chunk"]] * n, ends - lengths, lengths]
                columns.append([zlib.crc32(np.ascontiguousarray(p)) for p in parts])
                if keep_ids:
                    columns.append([p.astype(np.int64) for p in parts])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(f"{folder}/chunks")
    kept = chunks.select("shard", "chunk", "unit", "n_ids", "doc_ids", "lengths", "planes")
    sql = "doc_id bigint, shard int, chunk int, at bigint, n_tokens bigint, ids_crc32 bigint" + (
        ", ids array<bigint>" if keep_ids else ""
    )
    found = kept.mapInArrow(decode, sql)
    earlier = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = chunks.select("shard", "chunk", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("in_shard"))
    shards = spark.read.schema("shard int, n_ids bigint, before bigint").parquet(f"{folder}/shards")
    starts = places.join(shards.select("shard", "before"), "shard")
    return found.join(starts, ["shard", "chunk"]).select(
        "doc_id",
        (F.col("before") + F.col("in_shard") + F.col("at")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if keep_ids else []),
    )
