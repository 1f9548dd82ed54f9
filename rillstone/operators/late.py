"""Watermark bookkeeping in arrival order: late classes and side outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.blocks import Blocks, Running, running, running_max
from rillstone.operators.windows import least_record

ON_TIME, ALLOWED, TOO_LATE = "on_time", "allowed", "late"


def watermark_trace(
    df: DataFrame, time_ms: Column, order: Sequence[str], blocks: Blocks, bound_ms: int,
    shard: Sequence[str] = (), initial: DataFrame | None = None,
) -> DataFrame:
    """Add the watermark in force when each row arrives: the maximum event time before it
    less the bound, per source shard; null for a shard's first row."""
    out = running(df, shard, order, blocks, latest_time(time_ms), initial)
    return out.withColumn("watermark", F.col("latest_ms") - bound_ms).drop("latest_ms")


def latest_time(time_ms: Column) -> dict[str, Running]:
    return {"latest_ms": running_max(time_ms, before=True)}


def window_end_of(time_ms: Column, size_ms: int) -> Column:
    return time_ms - F.pmod(time_ms, F.lit(size_ms)) + size_ms


def late_class(window_end: Column, watermark: Column, lateness_ms: int) -> Column:
    """A row is on time while its window is open, allowed while its window is kept."""
    return (
        F.when(watermark.isNull() | (window_end > watermark), ON_TIME)
        .when(window_end + lateness_ms > watermark, ALLOWED)
        .otherwise(TOO_LATE)
    )


def late_classify(
    df: DataFrame, time_ms: Column, order: Sequence[str], blocks: Blocks, size_ms: int,
    bound_ms: int, lateness_ms: int, shard: Sequence[str] = (), initial: DataFrame | None = None,
) -> DataFrame:
    """Add the end of each row's tumbling window and the row's late class."""
    traced = watermark_trace(df, time_ms, order, blocks, bound_ms, shard, initial)
    end = window_end_of(time_ms, size_ms)
    return traced.select(
        "*", end.alias("window_end"), late_class(end, F.col("watermark"), lateness_ms).alias("late_class")
    )


def split_late(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that count, rows that came too late); together they are the input."""
    late = F.col("late_class") == TOO_LATE
    return classified.filter(~late), classified.filter(late)


def min_by_with_lateness(classified: DataFrame, key: str, value: str, tie: str) -> DataFrame:
    """Final window results when allowed-late rows update their window; null values are skipped as in the windows."""
    kept, _ = split_late(classified)
    fields = [c for c in kept.columns
              if c not in (key, value, tie, "window_end", "late_class", "watermark")]
    best = least_record(value, F.struct(F.col(value), F.col(tie), *fields)).alias("r")
    grouped = kept.groupBy(key, "window_end").agg(best)
    return grouped.select(key, "window_end", *[F.col("r")[c].alias(c) for c in (value, tie, *fields)])


def side_output_split(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """Tag rows above the threshold `high` and all others, nulls included, `low`."""
    return df.withColumn("route", F.when(F.col(value) > threshold, "high").otherwise("low"))
