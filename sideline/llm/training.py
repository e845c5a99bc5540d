"""Training rows of the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.llm.common import held_out


def learning_ids(labels: DataFrame, column: str, id_col: str = "doc_id") -> DataFrame:
    """(id, y) outside the held-out fold; a document labelled twice counts by its larger label."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(column).isin(0, 1) & ~held_out(F.col(id_col)))
    return known.groupBy(F.col(id_col).alias("id")).agg(F.max(column).cast("int").alias("y"))


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows with the smallest id hashes: the same ones on every run."""
    return rows.orderBy(F.xxhash64("id"), "id").limit(most)


def texts_of(ids: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Whole texts of a bounded set of ids. One text per id: the smallest, if an id is repeated."""
    found = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(ids), "id")
    return found.groupBy(*[c for c in found.columns if c != "text"]).agg(F.min("text").alias("text"))
