"""A positional inverted index: which documents hold which words where, and web-style queries over it.

Postings are rows (token, document, positions), stored by a hash of the token: a query reads the buckets of its own
words only, and within them the row groups whose token range covers a word. Files are ranges of (bucket, token, document) of a
bounded number of postings, so no task writes or reads a whole bucket, or a whole hot list. A query starts from the list of
its rarest word and joins the others to what is left; phrases are decided on positions. Texts are split when the
index is built and never again.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendwork.functions.durable import CODEC, durable
from mendwork.functions.text import build_tokens, dealt_out, parse_query, token_positions

BUCKETS = 64
# Postings a file holds, about.
PART_ROWS = 1 << 20


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def _less(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda x: x - F.lit(by))


def postings_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``token``, ``doc_id``, ``positions`` (from 1, rising): one row for each word of each document."""
    placed = token_positions(build_tokens(dealt_out(docs, key, text), key, text), key)
    return placed.groupBy("token", F.col(key).alias("doc_id")).agg(F.sort_array(F.collect_list("position")).alias("positions"))


def _store(postings: DataFrame, path: str, buckets: int, part_rows: int) -> None:
    """Appends postings and their lexicon to the index under ``path``."""
    rows = durable(postings.withColumn("bucket", _bucket(F.col("token"), buckets)))
    lexicon = rows.groupBy("bucket", "token").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("positions")).alias("n_words"))
    # As many tasks as there are files' worth of postings.
    files = max(1, -(-rows.count() // part_rows))
    place = ["bucket", "token", "doc_id"]
    dealt = rows.repartitionByRange(files, *place).sortWithinPartitions(*place)
    dealt.select("token", "doc_id", "positions", "bucket").write.partitionBy("bucket").mode("append").option("compression", CODEC).parquet(f"{path}/postings")
    lexicon = lexicon.repartitionByRange("bucket", "token").sortWithinPartitions("bucket", "token")
    lexicon.write.partitionBy("bucket").mode("append").option("compression", CODEC).parquet(f"{path}/lexicon")


class TextIndex(NamedTuple):
    """An index in a folder all executors share."""

    spark: SparkSession
    path: str
    buckets: int
    key_type: str

    def postings(self, *tokens: str) -> DataFrame:
        """Postings of ``tokens`` (all, if none are named): ``token``, ``doc_id``, ``positions``."""
        schema = f"token string, doc_id {self.key_type}, positions array<int>, bucket int"
        return self._rows("postings", schema, tokens).select("token", "doc_id", "positions")

    def lexicon(self, *tokens: str) -> DataFrame:
        """``token``, ``n_docs``, ``n_words`` of ``tokens`` (all, if none are named)."""
        rows = self._rows("lexicon", "token string, n_docs bigint, n_words bigint, bucket int", tokens)
        return rows.groupBy("token").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_words").alias("n_words"))

    def _rows(self, table: str, schema: str, tokens: tuple[str, ...]) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        if not tokens:
            return rows
        # The buckets of a query's few words are worked out first, so only their folders are listed and read.
        wanted = self.spark.createDataFrame([(t,) for t in tokens], "token string")
        buckets = sorted({r[0] for r in wanted.select(_bucket(F.col("token"), self.buckets)).collect()})
        return rows.where(F.col("bucket").isin(buckets) & F.col("token").isin(*tokens))

    def add(self, docs: DataFrame, key: str = "doc_id", text: str = "text", part_rows: int = PART_ROWS) -> TextIndex:
        """Adds documents that the index does not hold yet, as new files beside the old ones."""
        _store(postings_of(docs, key, text), self.path, self.buckets, part_rows)
        return self

    def matches(self, query: str) -> DataFrame:
        """``doc_id`` of every document that matches a web-style query (see ``functions.text.parse_query``), once each."""
        branches = parse_query(query)
        words = sorted({w for branch in branches for _, wanted in branch for w in wanted})
        if not words:
            return self.postings().select("doc_id").limit(0)
        # One number for each word of the query.
        n_docs = {r["token"]: r["n_docs"] for r in self.lexicon(*words).collect()}
        found = [self._branch(branch, n_docs) for branch in branches]
        found = [f for f in found if f is not None]
        if not found:
            return self.postings().select("doc_id").limit(0)
        return reduce(DataFrame.unionByName, found).distinct() if len(found) > 1 else found[0]

    def _branch(self, branch: list[tuple[bool, list[str]]], n_docs: dict[str, int]) -> DataFrame | None:
        """Documents that hold all positive terms of a branch and no negated one; None where a word is in no document."""
        held = self._holding([wanted for negated, wanted in branch if not negated], n_docs)
        for negated, wanted in branch:
            without = self._holding([wanted], n_docs) if negated and held is not None else None
            if without is not None:
                held = held.join(without, "doc_id", "left_anti")
        return held

    def _holding(self, terms: list[list[str]], n_docs: dict[str, int]) -> DataFrame | None:
        """Documents that hold all ``terms``: lists are joined from the rarest on, and positions kept for phrases only."""
        words = {w for wanted in terms for w in wanted}
        if not all(n_docs.get(w) for w in words):
            return None
        placed = {w for wanted in terms if len(wanted) > 1 for w in wanted}
        rows: DataFrame | None = None
        at: dict[str, str] = {}
        for i, word in enumerate(sorted(words, key=lambda w: (n_docs[w], w))):
            own = self.postings(word)
            if word in placed:
                at[word] = f"_at{i}"
            own = own.select("doc_id", F.col("positions").alias(at[word])) if word in placed else own.select("doc_id")
            rows = own if rows is None else rows.join(own, "doc_id")
        for wanted in terms:
            if len(wanted) > 1:
                starts = [_less(F.col(at[w]), i) for i, w in enumerate(wanted)]
                rows = rows.where(F.size(reduce(F.array_intersect, starts)) > 0)
        return rows.select("doc_id")


def build(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, part_rows: int = PART_ROWS
) -> TextIndex:
    """An index of ``docs`` under ``path``, a folder of its own that all executors share.

    ``key`` is unique. A null text has no words. With more documents, more ``buckets`` keep files apart.
    """
    _store(postings_of(docs, key, text), path, buckets, part_rows)
    return TextIndex(docs.sparkSession, path, buckets, docs.select(key).dtypes[0][1])
