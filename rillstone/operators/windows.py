"""Event-time group windows: tumbling and sliding. All work on batch and streaming input."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND_MS = 1000


def duration(ms: int) -> str:
    return f"{ms} milliseconds"


def tumble_agg(df: DataFrame, key: str, time: str, size_ms: int, *aggs: Column) -> DataFrame:
    """Aggregates per key and tumbling window, with the exclusive window end in epoch ms."""
    grouped = df.groupBy(key, F.window(time, duration(size_ms)).alias("w")).agg(*aggs)
    return grouped.select(key, window_end_ms("w"), *[c for c in grouped.columns if c not in (key, "w")])


def window_end_ms(window: str = "w", name: str = "window_end") -> Column:
    return F.unix_millis(f"{window}.end").alias(name)


def tumble_min_by(df: DataFrame, key: str, time: str, size_ms: int, value: str, tie: str) -> DataFrame:
    """Per key and window: the whole record with the smallest value, the first one on ties.

    Null values are skipped; a window of nulls only gives its first record.
    """
    fields = [c for c in df.columns if c not in (key, time)]
    record = F.struct(F.col(value), F.col(tie), *[c for c in fields if c not in (value, tie)])
    grouped = df.groupBy(key, F.window(time, duration(size_ms)).alias("w")).agg(least_record(value, record).alias("r"))
    return grouped.select(key, window_end_ms("w"), *[F.col("r")[c].alias(c) for c in fields])


def least_record(value: str, record: Column) -> Column:
    """The least record among those with a value, or of all if none has one; `record` begins with the value."""
    return F.coalesce(F.min(F.when(F.col(value).isNotNull(), record)), F.min(record))


# Up to this many panes per window get a column each in the two-step sliding count.
MAX_PANE_COLUMNS = 64


def hop_count(
    df: DataFrame, key: str, time: str, size_ms: int, slide_ms: int, when: Column | None = None,
    name: str = "cnt",
) -> DataFrame:
    """Count per key and sliding window: (key, window_end, count).

    Records are counted once, in panes, and only pane counts reach the `size / slide` windows
    they belong to.

    On a stream a condition is counted rather than filtered: a filter would move below the
    watermark, and then only matching records would advance it.
    """
    if df.isStreaming:
        return _hop_from_panes(df, key, time, size_ms, slide_ms, when, name)
    if when is not None:
        df = df.filter(when)
    if size_ms % slide_ms == 0 and size_ms // slide_ms <= MAX_PANE_COLUMNS:
        return _hop_from_cycles(df, key, time, size_ms, slide_ms, name)
    return _hop_from_panes(df, key, time, size_ms, slide_ms, None, name)


def _hop_from_cycles(
    df: DataFrame, key: str, time: str, size_ms: int, slide_ms: int, name: str
) -> DataFrame:
    """Sliding counts from one row of running pane counts per key and cycle of one window size.

    The window that ends with a cycle's pane j holds the panes up to j of that cycle and the
    panes after j of the cycle before. So a cycle's row gives each of two cycles' windows a
    partial sum, and just one row per key and cycle is shuffled, however many records it has.
    """
    panes = range(size_ms // slide_ms)
    last = panes[-1]
    placed = df.filter(F.col(time).isNotNull()).select(key, F.unix_millis(time).alias("ms")).select(
        key,
        F.expr(f"(ms - pmod(ms, {size_ms})) div {size_ms}").alias("cycle"),
        F.expr(f"pmod(ms, {size_ms}) div {slide_ms}").alias("pane"),
    )
    upto = placed.groupBy(key, "cycle").agg(*[F.expr(f"count_if(pane <= {p}) as u{p}") for p in panes])

    own = ", ".join(f"u{p} as w{p}" for p in panes)
    following = ", ".join(f"u{last} - u{p} as w{p}" for p in panes)
    spread = upto.select(
        key,
        F.expr(f"inline(array(struct(cycle, {own}), struct(cycle + 1 as cycle, {following})))"),
    )
    summed = spread.groupBy(key, "cycle").agg(*[F.expr(f"sum(w{p}) as w{p}") for p in panes])
    sums = ", ".join(f"w{p}" for p in panes)
    each = summed.select(key, "cycle", F.posexplode(F.expr(f"array({sums})")).alias("pane", name))
    end = F.expr(f"cycle * {size_ms} + (pane + 1) * {slide_ms}")
    return each.filter(F.col(name) > 0).select(key, end.alias("window_end"), name)


def _hop_from_panes(
    df: DataFrame, key: str, time: str, size_ms: int, slide_ms: int, when: Column | None, name: str
) -> DataFrame:
    """Sliding counts as a window over windows: any size and slide, batch or stream."""
    pane_ms = gcd(size_ms, slide_ms)
    hits = F.count(F.lit(1)) if when is None else F.count_if(when)
    panes = (
        df.groupBy(key, F.window(time, duration(pane_ms)).alias("pane"))
        .agg(hits.alias("hits"))
        .filter("hits > 0")
    )
    hops = panes.groupBy(key, F.window("pane", duration(size_ms), duration(slide_ms)).alias("w"))
    return hops.agg(F.sum("hits").alias(name)).select(key, window_end_ms("w"), name)


def hop_count_direct(
    df: DataFrame, key: str, time: str, size_ms: int, slide_ms: int, name: str = "cnt"
) -> DataFrame:
    """The same counts in one step, every record copied to its windows: for comparison."""
    grouped = df.groupBy(key, F.window(time, duration(size_ms), duration(slide_ms)).alias("w"))
    return grouped.agg(F.count(F.lit(1)).alias(name)).select(key, window_end_ms("w"), name)
