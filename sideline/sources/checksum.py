"""Checksums of source files, manifests of folders, and the manifest of an accepted file."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline.operators.quality import QualityError
from sideline.sources.governed import Consumption


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    """sha256 of the bytes of each file: (sourceFile, sha256, length)."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("sourceFile"), F.sha2("content", 256).alias("sha256"), "length"
    )


def require_checksum(spark: SparkSession, path: str, expected: str) -> str:
    """Raise before anything is written when the bytes of a file are not the pinned ones."""
    row = file_checksums(spark, path).first()
    if row is None or row["sha256"] != expected:
        got = None if row is None else row["sha256"]
        raise QualityError(f"source {path} has sha256 {got}, pinned is {expected}")
    return row["sha256"]


def folder_root(spark: SparkSession, path: str) -> str:
    """Full address of a folder, as file listings spell it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def folder_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256, length) of all files below a folder; ``file`` is the path inside the folder.

    Every file is read by the task that hashes it. Files whose names start with _ or . are left out
    by the reader, as Spark's own sources do.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # listings write file:/a where addresses may be file:///a
    plain = F.regexp_replace("path", "^file:/+", "file:/")
    root = re.sub("^file:/+", "file:/", folder_root(spark, path))
    start = len(root.rstrip("/")) + 2
    return files.select(F.substring(plain, start, 1 << 20).alias("file"), F.sha2("content", 256).alias("sha256"), "length")


def manifest_problems(found: DataFrame, pinned: DataFrame) -> DataFrame:
    """(file, problem, expected, found) where a folder and its manifest differ.

    ``found`` and ``pinned`` have file and sha256. Problems: missing (listed, not there), extra (there,
    not listed), changed, and listed twice with different digests. One full hash join by file, so
    both sides may be of any size; equal repeated entries of a manifest are one.
    """
    listed = pinned.groupBy("file").agg(F.min("sha256").alias("expected"), F.max("sha256").alias("other"))
    there = found.select("file", F.col("sha256").alias("found"))
    both = listed.join(there, "file", "full")
    problem = (
        F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra")
        .when(F.col("expected") != F.col("other"), "listed twice").when(F.col("expected") != F.col("found"), "changed")
    )
    return both.select("file", problem.alias("problem"), "expected", "found").where("problem IS NOT NULL")


def require_manifest(spark: SparkSession, path: str, pinned: DataFrame) -> DataFrame:
    """The manifest of a folder, if it is the pinned one; raises with all kinds of differences otherwise.

    Call it before anything is written: nothing of a folder that differs should be used.
    """
    found = folder_manifest(spark, path)
    counts = manifest_problems(found, pinned).groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file"))
    wrong = counts.orderBy("problem").collect()
    if wrong:
        said = "; ".join(f"{r['n']} {r['problem']} (first {r['file']})" for r in wrong)
        raise QualityError(f"{path} is not what its manifest lists: {said}")
    return found


def manifest(used: Consumption, checksum: str) -> DataFrame:
    """One row: row and team counts with the echoed metadata and the checksum."""
    up = used.upstream
    counts = used.rows.groupBy("team").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rowCount"), F.count(F.lit(1)).alias("teamCount")
    )
    return counts.withColumns(
        {
            "sourceArtifactPath": F.lit(up["sourceArtifactPath"]),
            "sha256": F.lit(checksum),
            "season": F.lit(up["season"]).cast("int"),
            "generatedAt": F.lit(up["generatedAt"]).cast("string"),
            "provenanceStatus": F.lit(up["provenanceStatus"]),
            "governanceStatus": F.lit(up["governanceStatus"]),
            "governanceSource": F.lit(up["governanceSource"]),
            "governanceNotes": F.lit(up["governanceNotes"]).cast("string"),
        }
    )
