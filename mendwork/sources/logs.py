"""Plan logs and run records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mendwork.operators.analytics import split_blocks

# fixed value: where a plan log lies under its run folder
PLAN_PATH = r"/raw/([^/]+)/pass_0*([0-9]+)/run_0*([0-9]+)/([^/]+)/explain\.json$"
PLAN_PATTERN = re.compile(PLAN_PATH)


def read_plan_logs(spark: SparkSession, root: str, file_name: str = "explain.json") -> DataFrame:
    """JSON plan logs of a folder tree: case_id, pass, run_index, variant, path, plan.

    One file is one plan of one run; the tree is listed and read by many tasks.
    """
    path = F.col("_metadata.file_path")
    files = (
        spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=file_name)
        .select(path.alias("path"), F.col("value").alias("plan"))
    )

    def part(i: int) -> Column:
        return F.regexp_extract("path", PLAN_PATH, i)

    return files.where(part(1) != "").select(
        part(1).alias("case_id"),
        part(2).cast("int").alias("pass"),
        part(3).cast("int").alias("run_index"),
        part(4).alias("variant"),
        "path",
        "plan",
    )


# fixed values: columns of a run manifest, in order
MANIFEST_SCHEMA = (
    "run_id STRING, pass INT, case_id STRING, run_index INT, variant STRING, variant_order INT, "
    "permission_group_count INT, party_count INT, service_count INT, hot_party STRING, "
    "unprefixed_party_identifier STRING, estimated_dialog_count BIGINT, estimated_dialog_count_band STRING, as_of STRING, "
    "sql_file STRING, raw_output_file STRING, stderr_file STRING, payload_file STRING, started_at STRING, "
    "finished_at STRING, exit_code INT"
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest of a benchmark run, CSV with a header: one row for each execution of a variant."""
    return spark.read.schema(MANIFEST_SCHEMA).option("header", True).option("escape", '"').csv(path)


def _number(column: str, kind: str) -> Column:
    text = F.nullif(F.nullif(F.trim(F.col(column)), F.lit("")), F.lit("None"))
    value = text.try_cast("double")
    return (value if kind == "double" else F.floor(value).cast(kind)).alias(column)


# fixed values: columns of run rows and run records
RUN_TEXT = ("category", "case", "variant", "cache_status", "sql_order")
RUN_INTEGERS = (
    "party_count", "service_count", "shared_read", "shared_hit", "shared_dirtied", "iteration_seed", "round",
    "sql_position", "sql_count",
)
RUN_COLUMNS = (
    "category", "case", "party_count", "service_count", "variant", "exec_ms", "shared_read", "shared_hit",
    "shared_dirtied", "cache_status", "iteration_seed", "round", "sql_position", "sql_count", "sql_order",
)
RECORD_SCHEMA = (
    "global_run_index BIGINT, iteration INT, position_in_round INT, design STRING, sql_id STRING, "
    "sql_file STRING, party STRING, success BOOLEAN, returncode INT, wall_time_ms DOUBLE, "
    "execution_time_ms DOUBLE, error STRING"
)


def read_run_records(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """``json``: run records, one object per line. ``csv``: run rows with a header, ``None`` and empty as null."""
    if fmt == "json":
        return spark.read.schema(RECORD_SCHEMA).json(path)
    if fmt == "csv":
        raw = spark.read.option("header", True).option("escape", '"').csv(path)
        present = [c for c in RUN_COLUMNS if c in raw.columns]
        return raw.select(
            *[
                F.col(c) if c in RUN_TEXT else _number(c, "bigint" if c in RUN_INTEGERS else "double")
                for c in present
            ]
        )
    raise ValueError(f"unknown format {fmt!r}")


def read_plan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of combined plan-text logs: file, chunk, at, line.

    A chunk is one split of the file, named by its start offset; ``at`` orders the lines inside it. Long
    logs stay splittable.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )


def split_plan_text(spark: SparkSession, path: str) -> DataFrame:
    """(case, variant) blocks of combined plan-text logs, one row per line."""
    return split_blocks(read_plan_lines(spark, path))
