"""Session settings for local runs and tests. Clusters bring their own session."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "mendwork", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    # One disk: a scratch folder is shared by all there is.
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
