"""Streaming pipelines over sensor readings, click-streams and text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.operators import topn, windows, words
from rillstone.streaming.processors import TopNPerWindow
from rillstone.streaming.runner import with_state


def with_event_time(df: DataFrame, seconds: str = "timestamp", name: str = "rt", delay: str = "20 milliseconds"
                    ) -> DataFrame:
    """Event time from epoch seconds, with a bound on how late rows may be.

    A deterministic filter put after this moves below the watermark, where it stops rows it
    rejects from advancing it; count conditionally instead.
    """
    return df.withColumn(name, F.timestamp_seconds(seconds)).withWatermark(name, delay)


def word_counts(lines: DataFrame, column: str = "text") -> DataFrame:
    """Running counts; run in update mode."""
    return words.word_count(lines, column)


def tumbling_min(df: DataFrame, size_ms: int, delay: str = "20 milliseconds") -> DataFrame:
    timed = with_event_time(df, delay=delay)
    return windows.tumble_min_by(timed, "id", "rt", size_ms, "temperature", "seq")


def tumbling_min_with_lateness(
    df: DataFrame, size_ms: int, bound_ms: int, lateness_ms: int
) -> DataFrame:
    """Minima that rows late by up to the lateness still improve. Run in update mode: a window
    is sent again whenever it changes, and its last version counts. Spark moves the watermark
    between batches, so rows are refused no earlier than the batch after it passed them."""
    return tumbling_min(df, size_ms, f"{bound_ms + lateness_ms} milliseconds")


def tumbling_avg(df: DataFrame, size_ms: int, delay: str = "2 seconds") -> DataFrame:
    timed = with_event_time(df, delay=delay)
    return windows.tumble_agg(
        timed, "id", "rt", size_ms,
        F.count("id").alias("cnt"), F.avg("temperature").alias("avg_temp"),
    )


def hop_views(df: DataFrame, size_ms: int = 3_600_000, slide_ms: int = 300_000,
              delay: str = "200 milliseconds") -> DataFrame:
    """Page views per item and sliding window; every row advances the watermark."""
    timed = with_event_time(df, name="ts", delay=delay)
    return windows.hop_count(timed, "itemId", "ts", size_ms, slide_ms, F.col("behavior") == "pv")


def rank_closed_windows(n: int = 5):
    """A batch transformation: in append mode all counts of a window come in the batch that
    closes it, so the window is ranked there, with a group limit before the shuffle."""
    return lambda batch: topn.hot_items(batch, n)


def closing(counts: DataFrame) -> DataFrame:
    return counts.withColumn("closed", F.timestamp_millis("window_end")).withWatermark("closed", "0 seconds")


def hot_items_by_timer(counts: DataFrame, n: int = 5) -> DataFrame:
    """The same ranking from keyed state and a timer at each window's end.

    `counts` is a stream of (itemId, window_end, cnt) rows. All of a window's rows meet in one task:
    give it those that `hot_items_by_share` left over.
    """
    return with_state(closing(counts), ["window_end"], TopNPerWindow(n), "eventTime")


def hot_items_by_share(counts: DataFrame, n: int = 5, shares: int = 16) -> DataFrame:
    """The n best of every share of a window's items, by timers: at most n * shares rows of a window are left."""
    dealt = closing(counts).withColumn("share", F.pmod(F.xxhash64("itemId"), F.lit(shares)).cast("int"))
    return with_state(dealt, ["window_end", "share"], TopNPerWindow(n), "eventTime")
