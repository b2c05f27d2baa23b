"""Arrow batches for whole texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPARK_DEFAULT = "10000"
TEXT_RECORDS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of 1000 rows, unless the session asks for a size of its own.

    Spark's default of 10,000 rows is meant for narrow rows; of whole documents it is tens of MB a batch, held by
    the JVM and by Python at once.
    """
    if spark.conf.get(RECORDS, SPARK_DEFAULT) == SPARK_DEFAULT:
        spark.conf.set(RECORDS, TEXT_RECORDS)
