"""Exact duplicates by sorting whole texts.

Splitters that Spark samples range-partition the normalised bytes: by their first ones, then by a hash of them all, then by a
hash of the identifier, so that splitters stay short and a text with very many copies spreads over as many ranges as it fills.
In each range an external sort places equal texts next to each other, and a sort aggregate compares neighbours in full and
keeps the smallest identifier of a run. What leaves a range is a digest of the text, its least identifier and its count, one
row for each of up to SHARES shares of a text; only these meet again.

Nulls, ties, repeated rows: a null text counts as empty; a null identifier comes after all others; of rows that repeat both
identifier and text, one stays. An empty table gives an empty result. Other columns may have any name and type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters at the start of a text by which ranges are cut; what follows decides through a hash.
LEADING = 16
#: Parts that the copies of one text are dealt to, so that ranges may cut between them.
SHARES = 4096


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _order(doc_id: Column) -> Column:
    """Nulls last. A struct makes the aggregate below a sort aggregate: it reads sorted rows and holds no table of texts."""
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"))


def _sorted_groups(rows: DataFrame, *aggregates: Column) -> DataFrame:
    """rows: norm, id and others. One row for each norm."""
    ranges = rows.repartitionByRange(F.substring("norm", 1, LEADING), F.xxhash64("norm"), "id")
    return ranges.groupBy("norm").agg(*aggregates)


def _runs(rows: DataFrame, *aggregates: Column) -> DataFrame:
    """rows: norm, id and others. One row for each norm and share of its identifiers. Rows of equal keys lie in one range, so the aggregate moves nothing."""
    keys = {"leading": F.substring("norm", 1, LEADING), "hash": F.xxhash64("norm"), "share": F.pmod(F.xxhash64("id"), F.lit(SHARES))}
    return rows.withColumns(keys).repartitionByRange(*keys).groupBy(*keys, "norm").agg(*aggregates)


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its group: doc_id, keep_id, group_size, kept, text_sha256. Exactly one row of a group is kept."""
    rows = docs.select(F.col(doc_id).alias("id"), normalised(F.col(text)).alias("norm"))
    runs = _runs(rows, F.min(_order(F.col("id"))).alias("least"), F.count("*").alias("copies"))
    runs = runs.select(F.sha2("norm", 256).alias("text_sha256"), "least", "copies")
    groups = runs.groupBy("text_sha256").agg(F.min("least")["id"].alias("keep_id"), F.sum("copies").alias("group_size"))
    repeats = rows.select("id", F.sha2("norm", 256).alias("text_sha256")).groupBy("id", "text_sha256").agg(F.count("*").alias("repeats"))
    joined = repeats.join(groups, "text_sha256").withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
    return joined.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns as they came."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(F.col(doc_id).alias("id"), normalised(F.col(text)).alias("norm"), whole.alias("row"))
    kept = _sorted_groups(rows, F.min_by("row", _order(F.col("id"))).alias("row"))
    return kept.select("row.*")
