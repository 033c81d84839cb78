"""A corpus from raw documents to packed training sequences.

Stages: toxic documents go; of equal texts one stays; of similar texts one stays; sources are mixed to their targets; what is
left is packed. Each stage reads what the one before it wrote, works on all of it, and returns the columns of documents, the
last one the places of pieces in sequences. Nulls, empty texts, ties, repeated rows and empty tables are as the operators
define them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlake.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from orderlake.llm.scratch import stored
from orderlake.session import with_package


def toxic_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model finds toxic go; it learns from the labels of documents that are there."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest identifier stays."""
    return exact_dedup.deduplicate(docs)


def near_copies_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest identifier stays."""
    return jaccard_join.one_of_each(docs)


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the targets of their sources ask for."""
    return mixing.mixed_documents(docs)


def sequences_packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", with_package(toxic_go)),
    ("exact_dedup", with_package(exact_copies_go)),
    ("near_dedup", with_package(near_copies_go)),
    ("mixing", with_package(sources_mixed)),
    ("packing", with_package(sequences_packed)),
]

#: SQL can express neither the model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
