"""Filters as bits, of a fixed size, merged by or.

A filter of hashes is never wrong about what is in it, but may take other hashes for one of them. A filter of whole numbers is
exact for numbers less than BITS above a least one, and holds no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a filter, 128 KiB of them, however many hashes there are: more make it pass more.
BITS = 1 << 20
WORD = 64


def _words(cells: DataFrame) -> DataFrame:
    """cells: cell, a number below BITS. One row with the filter: an array of whole numbers."""
    bit = F.expr(f"shiftleft(1L, cast(cell % {WORD} as int))")
    found = cells.select((F.col("cell") / WORD).cast("int").alias("word"), bit.alias("bits"))
    none = cells.sparkSession.range(BITS // WORD).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    merged = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return merged.agg(F.transform(in_order, lambda w: w["bits"]).alias("filter"))


def _bit(filter_words: Column, cell: Column) -> Column:
    word = F.element_at(filter_words, (F.floor(cell / WORD) + 1).cast("int"))
    return F.bit_get(word, (cell % WORD).cast("int")) == 1


def words(hashes: DataFrame, column: str) -> DataFrame:
    """One row with the filter of a column of hashes."""
    return _words(hashes.select(F.pmod(F.col(column), F.lit(BITS)).alias("cell")))


def _cell(number: Column, least: Column) -> Column:
    """A number's place in a filter that begins with the least one; null if it has none."""
    cell = F.try_subtract(number, least)
    return F.when((cell >= 0) & (cell < BITS), cell)


def exact_words(numbers: DataFrame, column: str, least: Column) -> DataFrame:
    """One row with the filter of a column of numbers."""
    return _words(numbers.select(_cell(F.col(column), least).alias("cell")).filter("cell is not null"))


def holds(filter_words: Column, number: Column, least: Column) -> Column:
    """Whether a number is in an exact filter; false for those too far from the least one."""
    cell = _cell(number, least)
    return F.when(cell.isNotNull(), _bit(filter_words, cell)).otherwise(False)


def may_hold(filter_words: Column, value: Column) -> Column:
    """Whether a hash may be in the filter; never false for one that is."""
    return _bit(filter_words, F.pmod(value, F.lit(BITS)))
