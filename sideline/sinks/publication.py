"""Data sets of a run, published together or not at all."""

import uuid
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline.operators.quality import QualityError
from sideline.sinks.artifacts import write_dataset
from sideline.sources import checksum

_RUNS, _POINTER, _MANIFEST = "runs", "current", "manifest"


class Dataset(NamedTuple):
    """A frame and the columns that partition it."""

    rows: DataFrame
    by: tuple = ()


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    where, files = _files(spark, path)
    out = files.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _point_to(spark: SparkSession, folder: str, run: str) -> None:
    """Make ``run`` the published one: a new pointer file takes the place of the old one in one rename."""
    _write_text(spark, f"{folder}/{_POINTER}.{run}", run)
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = hadoop.Path(f"{folder}/{_POINTER}.{run}"), hadoop.Path(f"{folder}/{_POINTER}")
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    qualified = _files(spark, folder)[1].makeQualified(source).toUri()
    hadoop.FileContext.getFileContext(qualified, conf).rename(source, target, options)


def current_run(spark: SparkSession, folder: str) -> str | None:
    """Name of the published run; None before the first."""
    where, files = _files(spark, f"{folder}/{_POINTER}")
    if not files.exists(where):
        return None
    return spark.read.text(f"{folder}/{_POINTER}", wholetext=True).first()["value"].strip()


def run_folder(spark: SparkSession, folder: str) -> str:
    run = current_run(spark, folder)
    if run is None:
        raise QualityError(f"nothing has been published in {folder}")
    return f"{folder}/{_RUNS}/{run}"


def publish(spark: SparkSession, datasets: Mapping[str, Dataset], folder: str, fmt: str = "parquet", keep: int = 2) -> str:
    """Publish all data sets of a run; returns the run's name.

    Every run has a folder of its own, which no reader looks at until the pointer names it: all data
    sets are written, then a manifest of their files, and moving the pointer is one rename at the
    end. A run that fails on the way is removed and the run before stays published and readable,
    whatever has been written by then. The ``keep`` newest runs stay, so that a reader that has
    looked up the one before can finish.
    """
    folder = folder.rstrip("/")
    run = uuid.uuid4().hex
    target = f"{folder}/{_RUNS}/{run}"
    try:
        for name, (rows, by) in datasets.items():
            write_dataset(rows, f"{target}/data", name, fmt, by)
        checksum.folder_manifest(spark, f"{target}/data").write.parquet(f"{target}/{_MANIFEST}")
    except BaseException:
        where, files = _files(spark, target)
        files.delete(where, True)
        raise
    _point_to(spark, folder, run)
    _forget(spark, folder, run, keep)
    return run


def _forget(spark: SparkSession, folder: str, run: str, keep: int) -> None:
    where, files = _files(spark, f"{folder}/{_RUNS}")
    there = sorted(files.listStatus(where), key=lambda s: -s.getModificationTime())
    others = [s.getPath() for s in there if s.getPath().getName() != run]
    for path in others[max(0, keep - 1):]:
        files.delete(path, True)


def read_dataset(spark: SparkSession, folder: str, name: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A data set of the published run."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(f"{run_folder(spark, folder)}/data/{name}")


def published_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the published run that are missing, extra or changed since."""
    where = run_folder(spark, folder)
    return checksum.manifest_problems(checksum.folder_manifest(spark, f"{where}/data"), spark.read.parquet(f"{where}/{_MANIFEST}"))


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset, files, bytes) of the published run, from its manifest."""
    pinned = spark.read.parquet(f"{run_folder(spark, folder)}/{_MANIFEST}")
    return pinned.groupBy(F.substring_index("file", "/", 1).alias("dataset")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
