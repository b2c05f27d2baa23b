"""Exports and sample files."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Microseconds are kept; the CSV defaults cut times to milliseconds.
LOCAL_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ZONED_TIME = LOCAL_TIME + "XXX"


def export_batch_log(log: DataFrame, path: str, key: str = "batch_id") -> None:
    """The batch log as CSV files with headers, whose names are in batch order."""
    (
        log.orderBy(key)
        .write.mode("overwrite")
        .option("header", True)
        .option("timestampFormat", ZONED_TIME)
        .option("timestampNTZFormat", LOCAL_TIME)
        .csv(path)
    )


def write_sample_outputs(
    sample: DataFrame, counts: DataFrame, strata: DataFrame, metadata: Mapping[str, object], root: str, key: str = "party"
) -> None:
    """Party list, sample, full counts, strata summary and a metadata document under ``root``."""
    columns = [key, "dialog_count", "stratum"]
    sample.select(F.col(key).cast("string")).orderBy(key).write.mode("overwrite").text(f"{root}/parties")
    csv = {"sample": sample.select(*columns).orderBy(key), "party_counts": counts.select(*columns).orderBy(key)}
    csv["strata_summary"] = strata.select("stratum", "available", "selected").orderBy("stratum")
    for name, df in csv.items():
        df.write.mode("overwrite").option("header", True).csv(f"{root}/{name}")
    text = json.dumps(dict(metadata), ensure_ascii=False, default=str)
    spark = sample.sparkSession
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{root}/metadata")

