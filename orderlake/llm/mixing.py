"""Mixing sources to target weights.

Tokens are summed by source; each source's target divided by its size is its rate of repetition. A document is emitted
floor(rate) times, plus once more if a number drawn from a hash of its identifier falls below the fraction. Targets share a
total by weight; none exceeds `most` times its source, and what is cut goes to the others by weight.

Nulls, ties, repeated rows: a null text has size 0; a null source is a source of its own, last in order; null identifiers
draw by their text. Repeated rows are documents of their own and draw alike. A source without words gets target 0, and
none of its documents is emitted. Empty tables give empty results. Other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.scratch import stored

#: Weights of sources in order of code points, repeating.
WEIGHTS = (3, 1, 2)
#: Size of the mix as a share of all documents.
SHARE = 1.5
#: No target exceeds so many times its source.
MOST = 2
SEED = "mix-1"


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def draw(doc_id: Column, text: Column) -> Column:
    """A number from 0 to 1 that the document alone determines."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), name)), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """sizes: source, size by document. By source: source_size, target.

    A source reaches its cap if the cap is at most its weight times what all sources not capped before it have left for each
    unit of weight; in order of cap by weight, this holds for the first ones and no others.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (placed - 1) % len(weights) + 1)
    totals = totals.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size").cast("double") * most)
    everything = Window.partitionBy()
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("mix", F.sum("source_size").over(everything).cast("double") * share)
    left = F.col("mix") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    totals = totals.withColumn("capped", F.col("cap") * left_weight <= F.col("weight") * left)
    free = F.col("mix") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(everything)
    free_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.try_divide(F.col("weight") * free, free_weight))
    return totals.select("source", "source_size", target.alias("target"))


def repetitions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """By document: row (the whole row), doc_id, size, source_size, target and copies, how often to emit it."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    drawn = draw(F.col(doc_id), F.col(text)).alias("drawn")
    sized = docs.select(whole, F.col(doc_id).alias("doc_id"), F.col(source).alias("of"), size_of(F.col(text)).alias("size"), drawn)
    targets = source_targets(docs.select(F.col(source).alias("source"), size_of(F.col(text)).alias("size")))
    # Written, so that Spark knows how large the table of sources is before it chooses a join; one too large to broadcast is
    # joined by sorting, where adaptive execution splits a hot source.
    joined = sized.join(stored(targets, "targets"), F.col("of").eqNullSafe(F.col("source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (F.col("drawn") < rate - F.floor(rate)).cast("long")
    return joined.select("row", "doc_id", "size", "source_size", "target", copies.alias("copies"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix: every document as often as it is taken, with its own columns."""
    counted = repetitions(docs, doc_id, text, source).where("copies > 0")
    return counted.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
