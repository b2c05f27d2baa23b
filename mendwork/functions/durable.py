"""Cutting lineage in shared storage, so a lost executor never forces a different re-computation."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    A purely local master (``local[...]``) has one disk, so a scratch folder is named there when none is set.
    On any other master a missing setting is an error: a machine-local folder would lose stage files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set spark.checkpoint.dir to a folder all executors share (master is {master})")
    scratch = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(scratch)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stage_dir(spark: SparkSession) -> str:
    """The folder under which this application keeps its stage files."""
    return f"{shared_dir(spark)}/mendwork-{spark.sparkContext.applicationId}"


def new_stage(spark: SparkSession) -> str:
    """An unused path for one stage file."""
    return f"{stage_dir(spark)}/{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, whichever store it is in."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _files(spark, path)
    return files.exists(where)


def clear_stages(spark: SparkSession) -> None:
    """Remove every stage file of this application; frames that read them are unusable afterwards."""
    where, files = _files(spark, stage_dir(spark))
    files.delete(where, True)


def remove(spark: SparkSession, path: str) -> None:
    """Remove one stage file whose successor is written; frames that read it are unusable afterwards."""
    where, files = _files(spark, path)
    files.delete(where, True)


# Codec of stage files: a stage is written once and read a few times, and disk and network are shared by all tasks.
CODEC = "zstd"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used where one computed frame feeds two branches that must agree (range-partition positions), and
    between the stages of a repair. Parquet keeps column pruning and real file sizes, so later joins are
    planned on measured sizes.
    """
    spark = df.sparkSession
    path = new_stage(spark)
    df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
