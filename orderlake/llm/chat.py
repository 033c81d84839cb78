"""Conversations as training texts from every participant's perspective.

For each participant the dialogue is rendered once with that speaker as the assistant and all others as named users; system
turns stay what they are. A mask says which characters the model learns: the speaker's own words and the end marks of its
turns. A rendering is a table of segments, one for each turn, with its place in the whole: however long a conversation is,
no task holds it. Turns are put in order by ranges, whatever their numbers are, and cut into blocks; places are running sums
in two steps, within blocks and over blocks.

Nulls, ties, repeated rows: a null text is an empty turn; a null role is the participant "unknown"; a null turn comes first;
equal turns are ordered by role and text, and repeated rows are turns of their own. Rows of a null conversation are one
conversation. A conversation of system turns alone has no perspective. Empty tables give empty results. Other columns may
have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm.scratch import stored

#: Turns of a block at most, as a power of two.
BLOCK_BITS = 8
#: Characters of a text that ranges are cut by.
LEADING = 64
SYSTEM = "system"
END = "<|end|>\n"


def in_blocks(said: DataFrame) -> DataFrame:
    """said: conv_id, turn, role, text. With place, rising in their order, and block, which holds places that follow one another."""
    ranges = said.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, LEADING))
    ordered = ranges.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    placed = stored(ordered.withColumn("place", F.monotonically_increasing_id()), "turns")
    return placed.withColumn("block", F.shiftrightunsigned("place", BLOCK_BITS))


def perspectives(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """By conversation, perspective and turn: segment, char_start, char_end, mask_start, mask_end (equal where nothing is learned)."""
    said = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    said = in_blocks(said)
    speakers = said.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("role").alias("speaker")).distinct()
    seen = said.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("role") == F.col("speaker")
    header = F.when(F.col("role") == SYSTEM, F.lit("<|system|>\n")).when(own, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), "role", F.lit("|>\n")))
    seen = seen.withColumn("header", header).withColumn("segment", F.concat("header", "text", F.lit(END)))
    seen = seen.withColumn("length", F.length("segment").cast("long"))
    rendering = ["conv_id", "speaker"]
    inside = Window.partitionBy(*rendering, "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    blocks = seen.groupBy(*rendering, "block").agg(F.sum("length").alias("block_length"))
    over = Window.partitionBy(*rendering).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("of"), F.col("speaker").alias("by"), F.col("block").alias("nth"), F.coalesce(F.sum("block_length").over(over), F.lit(0)).alias("before"))
    placed = seen.withColumn("within", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    placed = placed.join(blocks, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("speaker") == F.col("by")) & (F.col("block") == F.col("nth")))
    start = F.col("before") + F.col("within")
    learned = F.col("speaker") == F.col("role")
    return placed.select(
        "conv_id",
        "speaker",
        "turn",
        "segment",
        start.alias("char_start"),
        (start + F.col("length")).alias("char_end"),
        F.when(learned, start + F.length("header")).otherwise(start).alias("mask_start"),
        F.when(learned, start + F.col("length") - 1).otherwise(start).alias("mask_end"),
    )


def rendered(segments: DataFrame, most_chars: int) -> DataFrame:
    """Segments joined into windows of about so many characters: conv_id, speaker, window, text, and the masks as places in it. A segment belongs to the window in which it starts, so a window's size is bounded by most_chars and one turn."""
    window = F.floor(F.col("char_start") / most_chars)
    first = F.min("char_start")
    parts = F.sort_array(F.collect_list(F.struct("char_start", "segment", "mask_start", "mask_end")))
    joined = segments.withColumn("window", window).groupBy("conv_id", "speaker", "window").agg(parts.alias("parts"), first.alias("first"))
    masked = F.filter("parts", lambda p: p["mask_end"] > p["mask_start"])
    return joined.select(
        "conv_id",
        "speaker",
        "window",
        F.array_join(F.transform("parts", lambda p: p["segment"]), "").alias("text"),
        F.transform(masked, lambda p: F.struct((p["mask_start"] - F.col("first")).alias("start"), (p["mask_end"] - F.col("first")).alias("end"))).alias("masks"),
    )
