"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline.llm import (
    fertility,
    importance,
    jaccard_join,
    knn_join,
    line_dedup,
    mixture,
    multi_index,
    piece_lattice,
    quality,
    tool_calls,
    toxicity,
    turn_repair,
    url_filter,
)
from sideline.llm.common import table

#: (host, path, verdict) of the entries that the page query lists
RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)

#: (tool, field, type, required) of the calls that the conversation query derives
SCHEMAS = (
    ("search", "query", "string", True), ("search", "turn", "integer", True), ("search", "limit", "integer", True),
    ("search", "exact", "boolean", False), ("fetch", "query", "string", True), ("fetch", "turn", "string", False),
    ("fetch", "limit", "integer", False),
)


def op1_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best vectors for every vector whose id is divisible by 20."""
    rows = table(spark, folder, "embeddings")
    return knn_join.top_k(rows.filter("vec_id % 20 = 0"), rows)


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents at 85 of 100 in common 4-word shingles."""
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed by source weights 5, 2, 1."""
    return mixture.mix(table(spark, folder, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.95."""
    return multi_index.near_duplicates(table(spark, folder, "embeddings"))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, folder, "documents")
    return quality.scores(docs, quality.fit(table(spark, folder, "labels"), docs))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines dropped per document, and the digest of the text that stays."""
    done = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict of every page."""
    listed = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, folder, "pages"), listed)


def op8_sentencepiece_nbest(spark: SparkSession, folder: str) -> DataFrame:
    """Two best segmentations of every document, and whether the ids give its text back."""
    docs = table(spark, folder, "documents")
    done = piece_lattice.encode(docs, 2, restored="restored")
    best = F.element_at("ids", 1)
    return done.select(
        "doc_id", F.size(best).cast("long").alias("n_pieces"), F.element_at("scores", 1).alias("score"),
        F.try_element_at("scores", F.lit(2)).alias("second_score"),
        F.sha2(F.array_join(best, " "), 256).alias("ids_sha256"), "restored")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, folder, "documents")
    return toxicity.scores(docs, toxicity.fit(table(spark, folder, "labels"), docs))


def op10_tool_call_linking(spark: SparkSession, folder: str) -> DataFrame:
    """Calls derived from all conversations, linked, ordered, checked and written as JSON."""
    calls, results = tool_calls.from_conversations(table(spark, folder, "conversations"))
    schemas = spark.createDataFrame(SCHEMAS, "name string, field string, type string, required boolean")
    return tool_calls.link(calls, results, schemas)


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of all documents, drawn towards the benchmark's n-grams."""
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_tokeniser_fertility(spark: SparkSession, folder: str) -> DataFrame:
    """Base rules and fertility bands of every document."""
    return fertility.judge(table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and audit of every damaged conversation."""
    return turn_repair.audit_of_damage(table(spark, folder, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_top_k": op1_exact_top_k,
        "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
        "op3_mix_sources": op3_mix_sources,
        "op4_embedding_near_dedup": op4_embedding_near_dedup,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_line_dedup": op6_line_dedup,
        "op7_url_filter": op7_url_filter,
        "op8_sentencepiece_nbest": op8_sentencepiece_nbest,
        "op9_toxicity": op9_toxicity,
        "op10_tool_call_linking": op10_tool_call_linking,
        "op11_importance_resampling": op11_importance_resampling,
        "op12_tokeniser_fertility": op12_tokeniser_fertility,
        "op13_conversation_repair": op13_conversation_repair,
    }
