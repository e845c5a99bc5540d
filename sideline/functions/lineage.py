"""Intermediate tables in the folder that all executors share."""

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sideline-"))
    return sc.getCheckpointDir()


_folders: list[str] = []


def discard(spark: SparkSession) -> None:
    """Remove every intermediate table of this process; frames that read them are then unusable.

    Call it when a run's results have been published. A process that ends normally does so by itself.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(_folders.pop())
        path.getFileSystem(hadoop).delete(path, True)


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession() if _folders else None
    if spark is not None and not spark.sparkContext._jsc.sc().isStopped():
        discard(spark)


def owned(folder: str) -> str:
    """Note a folder that goes with the intermediate tables."""
    _folders.append(folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Every later read sees the same rows, whatever executor is lost in between, and reads only the
    columns it needs.
    """
    spark = df.sparkSession
    folder = owned(f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
