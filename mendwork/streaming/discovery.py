"""Stream form of cursor discovery: new activity files become candidate contributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mendwork.functions.columns import Moment, moment
from mendwork.operators.unopened import batch_contribution, scoped_activities


def discover_stream(
    spark: SparkSession,
    activity_dir: str,
    dialogs_path: str,
    out_dir: str,
    checkpoint_dir: str,
    repair_name: str,
    start: Moment,
    end: Moment,
    schema: str,
) -> StreamingQuery:
    """Read all available activity files once and write one contribution set per micro-batch.

    The query's checkpoint is the cursor: a restarted run goes on with the files it has not seen. Dialog
    flags are read anew for each micro-batch. A contribution goes to the folder of its batch id, replacing
    it, so a replayed micro-batch does not count twice.
    """
    activities = spark.readStream.schema(schema).parquet(activity_dir)

    def contribute(batch: DataFrame, batch_id: int) -> None:
        dialogs = batch.sparkSession.read.parquet(dialogs_path)
        found = batch_contribution(scoped_activities(batch, dialogs, start, end), repair_name)
        found.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return (
        activities.writeStream.foreachBatch(contribute)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def stream_candidates(spark: SparkSession, out_dir: str, now: Moment) -> DataFrame:
    """Candidates of all contributions: earliest (time, id), summed counts.

    Files arrive in any order, so the smallest (time, id) wins, whichever batch brought it.
    """
    first = F.min(F.struct("first_activity_created_at", "first_activity_id")).alias("_first")
    return (
        spark.read.parquet(out_dir)
        .groupBy("repair_name", "dialog_id")
        .agg(first, F.sum("source_activity_count").alias("source_activity_count"))
        .select(
            "repair_name",
            "dialog_id",
            "_first.first_activity_created_at",
            "_first.first_activity_id",
            "source_activity_count",
            moment(now).alias("discovered_at"),
            F.when(F.lit(False), moment(now)).alias("processed_at"),
            F.when(F.lit(False), moment(now)).alias("updated_at"),
            F.lit(None).cast("string").alias("skipped_reason"),
        )
    )
