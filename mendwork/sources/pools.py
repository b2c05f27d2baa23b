"""Party-to-services pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mendwork.functions.durable import durable


def _without_escapes(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\.", "")


def _depth_change(text: Column) -> Column:
    """Opened less closed brackets outside strings, of a text that begins outside one."""
    bare = F.regexp_replace(_without_escapes(text), r'"[^"]*+(?:"|$)', "")
    return F.length(F.regexp_replace(bare, r"[^\[{]", "")) - F.length(F.regexp_replace(bare, r"[^\]}]", ""))


def json_array_elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of files that are one JSON array each, as ``v`` (VARIANT) and ``text`` of what could not be parsed (``v`` null).

    The files are split by bytes and cut at every closing brace, so one file is read by many tasks. Whether a piece starts
    inside a string, and how deep, follows from the pieces before it: quotes and brackets are summed within a split under
    both assumptions about its start, and a table with one row a split says which holds and where its depth begins. Pieces up to
    a brace that closes an element of the array belong together, across splits too.
    """
    pieces = durable(
        spark.read.option("lineSep", "}").text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("chunk"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("piece")
        )
    )
    quotes = F.length(F.regexp_replace(_without_escapes(F.col("piece")), '[^"]', ""))
    chunk, before, upto = ["file", "chunk"], (Window.unboundedPreceding, -1), (Window.unboundedPreceding, 0)
    within = Window.partitionBy(*chunk).orderBy("at")
    read = pieces.withColumns({"_q": quotes, "_d0": _depth_change(F.col("piece")), "_d1": _depth_change(F.concat(F.lit('"'), "piece"))})
    read = read.withColumn("_inside", F.coalesce(F.sum("_q").over(within.rowsBetween(*before)), F.lit(0)) % 2)

    def moved(start: int) -> Column:
        """Depth change of a piece and the brace after it, if its split starts inside a string (1) or not (0)."""
        inside = (F.col("_inside") + start) % 2
        closes = ((inside + F.col("_q")) % 2 == 0).cast("int")
        return F.when(inside == 0, F.col("_d0")).otherwise(F.col("_d1")) - closes

    read = read.withColumns({"_m0": moved(0), "_m1": moved(1)})
    read = read.withColumns({f"_r{s}": F.sum(f"_m{s}").over(within.rowsBetween(*upto)) for s in (0, 1)})
    splits = read.groupBy(*chunk).agg(F.sum("_q").alias("_q"), F.sum("_m0").alias("_m0"), F.sum("_m1").alias("_m1"), F.max("at").alias("_last"))
    in_file = Window.partitionBy("file").orderBy("chunk")
    splits = splits.withColumn("_start", F.coalesce(F.sum("_q").over(in_file.rowsBetween(*before)), F.lit(0)) % 2)
    own = F.when(F.col("_start") == 0, F.col("_m0")).otherwise(F.col("_m1"))
    splits = durable(
        splits.withColumn("_own", own).select(
            *chunk, "_start", F.coalesce(F.sum("_own").over(in_file.rowsBetween(*before)), F.lit(0)).alias("_depth"),
            F.when(F.lead("chunk").over(in_file).isNull(), F.col("_last")).alias("_end"),
        )
    )
    known = read.join(splits, chunk)
    inside = (F.col("_inside") + F.col("_start") + F.col("_q")) % 2
    depth = F.col("_depth") + F.when(F.col("_start") == 0, F.col("_r0")).otherwise(F.col("_r1"))
    closes = ((inside == 0) & (depth == 1)).cast("int")
    # The text after the file's last brace has none of its own.
    last = F.coalesce(F.col("at") == F.col("_end"), F.lit(False))
    ended = known.select(*chunk, "at", F.when(last, F.col("piece")).otherwise(F.concat("piece", F.lit("}"))).alias("piece"), last.alias("last"), closes.alias("closes"))
    ended = ended.withColumn("_no", F.coalesce(F.sum("closes").over(within.rowsBetween(*before)), F.lit(0)))
    counts = ended.groupBy(*chunk).agg(F.sum("closes").alias("_n"))
    counts = durable(counts.select(*chunk, F.coalesce(F.sum("_n").over(in_file.rowsBetween(*before)), F.lit(0)).alias("_earlier")))
    numbered = ended.join(counts, chunk).withColumn("no", F.col("_earlier") + F.col("_no"))
    whole = numbered.groupBy("file", "no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "at", "piece"))), lambda p: p["piece"]), "").alias("text"), F.max("last").alias("last")
    )
    opened = F.when(F.col("no") == 0, F.regexp_replace("text", r"^\s*\[", "")).otherwise(F.regexp_replace("text", r"^\s*,", ""))
    text = F.when(F.col("last"), F.regexp_replace(opened, r"\]\s*$", "")).otherwise(opened)
    found = whole.select(text.alias("text")).where(F.col("text").rlike(r"\S"))
    parsed = found.withColumn("_all", F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), "text", F.lit("]"))), "$", "array<variant>"))
    good = parsed.where("_all is not null").select(F.explode("_all").alias("v"), F.lit(None).cast("string").alias("text"))
    return good.unionByName(parsed.where("_all is null").select(F.lit(None).cast("variant").alias("v"), "text"))


def _entries(spark: SparkSession, path: str, lines: bool) -> DataFrame:
    if lines:
        return spark.read.option("singleVariantColumn", "v").json(path).withColumn("text", F.lit(None).cast("string"))
    return json_array_elements(spark, path)


def read_party_service_pool(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Pool (party, estimated_count, services) and the rejected entries as JSON text.

    The file is one JSON array of ``{"Party", "Services", "EstimatedDialogCount"}``, or one object per line
    with ``lines=True``; either is read by many tasks. Text that is no JSON is rejected as it stands. Entries without services drop out; services are
    de-duplicated and sorted. An entry whose party is not a non-empty text, or whose services are not a list
    of non-empty texts, is rejected.
    """
    entries = _entries(spark, path, lines)

    def kind(part: str):
        return F.schema_of_variant(F.try_variant_get("v", f"$.{part}", "variant"))

    party = F.try_variant_get("v", "$.Party", "string")
    services = F.try_variant_get("v", "$.Services", "array<string>")
    no_services = F.coalesce(F.size(services) == 0, F.lit(False))
    party_ok = F.coalesce((kind("Party") == "STRING") & (party != ""), F.lit(False))
    services_ok = no_services | F.coalesce(
        (kind("Services") == "ARRAY<STRING>") & ~F.exists(services, lambda s: F.coalesce(s == "", F.lit(True))),
        F.lit(False),
    )
    checked = entries.select(
        "v",
        "text",
        party.alias("party"),
        F.try_variant_get("v", "$.EstimatedDialogCount", "bigint").alias("estimated_count"),
        F.array_sort(F.array_distinct(services)).alias("services"),
        (party_ok & services_ok).alias("_ok"),
        no_services.alias("_empty"),
    )
    pool = checked.where(F.col("_ok") & ~F.col("_empty")).select("party", "estimated_count", "services")
    return pool, checked.where(~F.col("_ok")).select(F.coalesce("text", F.to_json("v")).alias("entry"))
