"""A training-corpus pipeline: quality, repeated lines, near duplicates, source mix, encoding.

Each stage takes (spark, docs, sf_dir) and its rows are written as Parquet before the next stage reads
them. A stage's ``docs`` is a stored table with the columns of documents. Stages handle null ids,
texts and sources as their operators say; an empty table goes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline.functions.lineage import written
from sideline.llm import jaccard_join, line_dedup, mixture, piece_lattice, quality
from sideline.llm.common import table

#: segmentations of every text, as many as op8 gives
SEGMENTATIONS = 2
#: no SQL: a trained classifier and a piece lattice; tests compare with plain Python
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score of label 1 is at least a half; the classifier learns from ``docs``."""
    model = quality.fit(table(spark, sf_dir, "labels"), docs)
    return docs.filter(quality.score_of(spark, F.col("text"), model) >= 0.5)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents repeat stay in one of them only."""
    done = line_dedup.dedup_lines(docs)
    cut = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", cut).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group linked at 0.8 on shingles of five words."""
    return jaccard_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document comes once per epoch that takes it."""
    return mixture.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of the best segmentation and whether they give the text back; scores and ids of all ``SEGMENTATIONS``, best first."""
    done = piece_lattice.encode(docs, SEGMENTATIONS, keep=("doc_id", "lang", "source", "n_chars"), restored="restored")
    best = F.element_at("ids", 1)
    return done.select(
        "doc_id", "lang", "source", "n_chars", F.size(best).cast("long").alias("n_pieces"), best.alias("piece_ids"), "restored",
        "scores", F.col("ids").alias("segmentations"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", one_of_near_copies),
    ("source mix", mix_sources),
    ("SentencePiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
