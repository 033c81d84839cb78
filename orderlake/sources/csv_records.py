"""Records of CSV files with line ends inside quotes, read by many tasks.

Such a file can be cut only where a record ends, and whether a line end lies inside quotes depends on all quotes before it.
But that is a parity: each block of the file counts its quotes by itself, the parities of the blocks, few rows, are summed in
order, and then every line knows whether a record starts with it. Lines that are a record by themselves go straight on; only
the lines of longer records are brought together, by the record's number. A line end ends a record exactly if the number of
quotes before it is even, as RFC 4180 has it, where quotes inside quoted values are doubled. Line ends of two characters, in a
file that has them, become one, as in Spark's own reader. A file whose quotes do not even
out fails, since its records cannot be told.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUOTE = '"'
BLOCK = ["file", "block"]


def quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(QUOTE), F.lit("")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where in the file it begins), place (order within the block), line, odd (whether its quotes are)."""
    text = spark.read.option("lineSep", "\n").text(path)
    read = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )
    return read.withColumn("odd", quotes(F.col("line")) % 2)


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, number (of the record in its file, from 1), record. Records without any character are left out."""
    before = F.coalesce(F.sum("odd").over(W.partitionBy(*BLOCK).orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    within = lines(spark, path).withColumn("inside", before % 2)
    in_order = W.partitionBy(*BLOCK).orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    # Lines that start a record up to this one, if the block starts outside quotes, and if inside.
    counted = within.withColumns({"if_outside": F.sum(1 - F.col("inside")).over(in_order), "if_inside": F.sum("inside").over(in_order)})

    # A file whose first line ends in two characters has such line ends throughout.
    two = F.min_by(F.endswith("line", F.lit("\r")), "place")
    blocks = counted.groupBy(*BLOCK).agg(
        F.sum("odd").alias("odd"), F.max("if_outside").alias("if_outside"), F.max("if_inside").alias("if_inside"), two.alias("two")
    )
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    entered = blocks.withColumn("entry", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    started = F.when(F.col("entry") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    total = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    entered = entered.select(
        F.col("file").alias("of"),
        F.col("block").alias("at"),
        "entry",
        F.coalesce(F.sum(started).over(earlier), F.lit(0)).alias("records_before"),
        (F.sum("odd").over(total) % 2).alias("open"),
        F.first("two").over(total).alias("two"),
    )

    placed = counted.join(entered, (F.col("file") == F.col("of")) & (F.col("block") == F.col("at")))
    own = F.when(F.col("entry") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    broken = F.raise_error(F.concat(F.lit("quotes do not even out in "), F.col("file")))
    number = F.when(F.col("open") == 0, F.col("records_before") + own).otherwise(broken.cast("bigint"))
    starts = (F.col("inside") + F.col("entry")) % 2 == 0
    placed = placed.select("file", "block", "place", "line", "two", number.alias("number"), (starts & (F.col("odd") == 0)).alias("whole"))

    whole = placed.filter("whole").select("file", "number", "two", F.col("line").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "line")))
    joined = placed.filter("not whole").groupBy("file", "number", "two").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("record"))
    plain = F.replace(F.regexp_replace("record", r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))
    ended = F.when(F.col("two"), plain).otherwise(F.col("record"))
    return whole.unionByName(joined).select("file", "number", ended.alias("record")).filter("record <> ''")


def read_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The columns as text, without each file's first record, which names them."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {"escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"}
    parsed = records(spark, path).filter("number > 1").select(F.from_csv("record", schema, options).alias("row"))
    return parsed.select(*(F.col(f"row.`{c}`").alias(c) for c in columns))
