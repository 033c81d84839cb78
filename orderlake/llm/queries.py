"""The operators over the given tables, each with its results as agreed."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import chat, conversation_repair, decontamination, exact_dedup, html_text, jaccard_join, mixing, packing, quality, secret_scan, token_rollup, toxicity, vector_codes
from orderlake.session import shared_folder, with_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equal texts."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets. A source is taken for an owner, and what it has in one language for a repository."""
    docs = _table(spark, sf_dir, "documents")
    repository = F.concat_ws("/", "source", "lang")
    return secret_scan.digest(secret_scan.secrets(docs, owner=F.col("source"), repository=repository))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of similar documents."""
    found = jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts by source, language and tokenizer, after all documents were inserted and then revised."""
    folder = f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}"
    return token_rollup.migrated(_table(spark, sf_dir, "documents"), folder).totals()


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what the mix takes of it."""
    counted = mixing.repetitions(_table(spark, sf_dir, "documents"))
    taken = F.col("copies") * F.col("size")
    return counted.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's perspective, turn by turn."""
    return chat.perspectives(_table(spark, sf_dir, "conversations"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's figures and verdict."""
    judged = quality.judged(_table(spark, sf_dir, "documents"))
    failed = quality.base_failed()
    return judged.select("doc_id", *quality.BASE, failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score."""
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.scored(docs, toxicity.trained(docs, _table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= toxicity.TOXIC).cast("int")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and then repaired."""
    turns = _table(spark, sf_dir, "conversations")
    return conversation_repair.repairs(conversation_repair.damaged(turns), ids=turns)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code, its error, and what all vectors of its label err."""
    coded, books = vector_codes.compressed(_table(spark, sf_dir, "embeddings"))
    digest = F.lit(books.sha256() if books else None).cast("string")
    return coded.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in passages of the benchmark."""
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: with_package(f)
    for f in (op1_exact_dedup, op2_html_text, op3_secret_scan, op4_jaccard_join, op5_token_rollup, op6_packing, op7_mixing, op8_chat, op9_quality, op10_toxicity, op11_conversation_repair, op12_vector_codes, op13_decontamination)
}
