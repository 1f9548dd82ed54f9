"""Words of text lines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions.strings import java_split, utf16_length
from rillstone.operators.blocks import Blocks, running, running_count

# A line number and a position in one long: a position is an int that is not negative.
POSITION_BITS = 31
POSITIONS = 1 << POSITION_BITS
LINES = 1 << 32


def flat_map_split(df: DataFrame, column: str, sep: str = " ", keep: Sequence[str] = ()) -> DataFrame:
    """One row per word; inner and leading empty words count, trailing ones don't."""
    return df.select(*keep, F.explode(java_split(F.col(column), sep)).alias("word"))


def word_count(df: DataFrame, column: str, sep: str = " ") -> DataFrame:
    return flat_map_split(df, column, sep).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def word_count_history(df: DataFrame, column: str, line_no: str, blocks: Blocks, sep: str = " ") -> DataFrame:
    """The count after every single word, as a running job prints it: (line, pos, word, cnt).

    Line numbers of 32 bits and positions go into one column, which halves what the sort compares and moves. The
    lowest and highest number are read once, at once; others are sorted by both columns.
    """
    words = df.select(
        line_no, F.posexplode(java_split(F.col(column), sep)).alias("pos", "word")
    )
    low, high, known, all_lines = df.agg(F.min(line_no), F.max(line_no), F.count(line_no), F.count(F.lit(1))).first()
    if not known or known < all_lines or low < -LINES or high >= LINES:
        return running(words, ["word"], [line_no, "pos"], blocks, {"cnt": running_count()})
    line = F.col(line_no).cast("bigint")
    packed = words.select((line * POSITIONS + F.col("pos")).alias("__at"), "word")
    at_blocks = replace(blocks, column="__at", width=blocks.width * POSITIONS)
    counted = running(packed, ["word"], ["__at"], at_blocks, {"cnt": running_count()})
    return counted.select(
        F.shiftright("__at", POSITION_BITS).cast(df.schema[line_no].dataType).alias(line_no),
        F.col("__at").bitwiseAND(POSITIONS - 1).cast("int").alias("pos"), "word", "cnt",
    )


def lateral_split(df: DataFrame, column: str, sep: str, keep: Sequence[str], outer: bool = False) -> DataFrame:
    """Every row joined with the (word, length) rows of its own text.

    The outer form keeps a row whose text has no words, with nulls.
    """
    rows = F.transform(
        java_split(F.col(column), sep),
        lambda w: F.struct(w.alias("word"), utf16_length(w).alias("length")),
    )
    return df.select(*keep, F.inline_outer(rows) if outer else F.inline(rows))
