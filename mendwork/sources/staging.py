"""Staging files: the CSV inputs of the repairs, and a profile of what landed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendwork.constants import Urns
from mendwork.functions.columns import canonical_organization, urn_parts

LABEL_SCHEMA = "dialog_id STRING, source_ts TIMESTAMP, actor_id STRING, system_label STRING"
ACTOR_SCHEMA = (
    "dialog_id STRING, dialog_activity_id STRING, source_ts TIMESTAMP, actor_id STRING, "
    "actor_name STRING, activity_type STRING"
)


def _rounded_time(text: Column) -> Column:
    """A time of any accepted spelling, to the nearest microsecond; the plain cast cuts digits off."""
    seventh = F.regexp_extract(text, r"\.[0-9]{6}([0-9])", 1)
    micros = F.unix_micros(text.cast("timestamp")) + F.when(seventh >= "5", F.lit(1)).otherwise(F.lit(0))
    return F.timestamp_micros(micros)


def _read(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """CSV with a header line and doubled quotes; a bad or missing value fails the read.

    Columns are taken by position. An empty field is missing, quoted or not. Times are kept to the microsecond; a
    seventh digit rounds.
    """
    as_text = ", ".join(f"{field.split()[0]} STRING" for field in schema.split(", "))
    df = (
        spark.read.schema(as_text)
        .option("header", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv([paths] if isinstance(paths, str) else list(paths))
    )
    kinds = dict(field.split() for field in schema.split(", "))
    required = [
        F.coalesce(
            _rounded_time(F.col(c)) if kinds[c] == "TIMESTAMP" else F.col(c),
            F.raise_error(F.lit(f"staging column {c} is missing a value")).cast(kinds[c]),
        ).alias(c)
        for c in df.columns
    ]
    return df.select(*required)


def read_label_staging(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """dialog_id, source_ts, actor_id, system_label. Takes ``2026-01-17 02:53:52.533 +0100`` and ISO times."""
    return _read(spark, path, LABEL_SCHEMA)


def normalize_actors(staging: DataFrame, urns: Urns = Urns()) -> DataFrame:
    """Legacy organisation identifiers become canonical before anything else looks at them."""
    return staging.withColumn("actor_id", canonical_organization(F.col("actor_id"), urns))


def read_actor_staging(spark: SparkSession, paths: str | Sequence[str], urns: Urns = Urns()) -> DataFrame:
    """One staging set from one or many actor CSV files."""
    return normalize_actors(_read(spark, paths, ACTOR_SCHEMA), urns)


def staging_profile(staging: DataFrame, category: str, urn: str = "actor_id") -> DataFrame:
    """Row count, rows per category and rows per four-part identifier prefix: section, item, rows.

    One pass: rows are first counted per (category, prefix), which is small, and the report reads that.
    """
    counts = staging.groupBy(F.col(category).alias("_c"), urn_parts(F.col(urn), 4).alias("_u")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    sections = F.explode(
        F.array(
            F.struct(F.lit("total").alias("section"), F.lit(None).cast("string").alias("item")),
            F.struct(F.lit("category").alias("section"), F.col("_c").alias("item")),
            F.struct(F.lit("urn_prefix").alias("section"), F.col("_u").alias("item")),
        )
    ).alias("_s")
    profile = counts.select(sections, "_n").groupBy("_s.section", "_s.item").agg(F.sum("_n").alias("rows"))
    return profile.orderBy("section", F.col("rows").desc(), "item")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
