"""Top-n per group, rankings, reports and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.operators.blocks import Blocks, running, running_count, running_max

# The smallest positive double, and the texts of the report.
SMALLEST_POSITIVE = 4.9e-324
RULE_ABOVE = "====================="
RULE_BELOW = "==============================="
WINDOW_END_LABEL = "窗口结束时间: "
RANK_LABEL = "No "
ITEM_LABEL = ": 商品ID= "
COUNT_LABEL = " 热门度= "


def top_n(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "row_num"
) -> DataFrame:
    """The first n rows per group with their rank.

    Catalyst puts a group limit of n in front of the shuffle, so a hot group sends at most
    n rows per task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def hot_items(counts: DataFrame, n: int = 5, item: str = "itemId", window: str = "window_end",
              count: str = "cnt") -> DataFrame:
    """The n most counted items of every window; equal counts are ordered by item."""
    return top_n(counts, [window], [F.desc(count), F.asc(item)], n)


def top_n_compat(df: DataFrame, key: str, value: str, order: str, blocks: Blocks) -> DataFrame:
    """The two-slot table aggregate in its original, order-dependent form.

    A new maximum replaces the first slot without moving the old one to the second; both
    slots start at the smallest positive double and are always emitted.
    """
    floor = F.lit(SMALLEST_POSITIVE)
    seen = running(df.select(key, order, value), [key], [order], blocks,
                   {"prev": running_max(F.col(value), before=True)})
    bar = F.greatest(floor, F.coalesce("prev", floor))
    slots = seen.groupBy(key).agg(
        F.greatest(floor, F.max(value)).alias("t1"),
        F.greatest(floor, F.coalesce(F.max(F.when(F.col(value) <= bar, F.col(value))), floor)).alias("t2"),
    )
    return slots.select(key, F.expr("stack(2, t1, 1, t2, 2) as (temp, temp_rank)"))


def format_report(ranked: DataFrame, item: str = "itemId", window: str = "window_end",
                  count: str = "cnt", rank: str = "row_num") -> DataFrame:
    """One text per window: a rule, the window end in UTC, one line per rank, a rule."""
    line = F.concat(
        F.lit(RANK_LABEL), F.col(rank).cast("string"),
        F.lit(ITEM_LABEL), F.col(item).cast("string"),
        F.lit(COUNT_LABEL), F.col(count).cast("string"),
    )
    # At most n ranked rows per window.
    texts = ranked.groupBy(window).agg(
        F.sort_array(F.collect_list(F.struct(F.col(rank).alias("r"), line.alias("line")))).alias("rows")
    )
    seconds = F.timestamp_seconds(F.floor(F.col(window) / 1000))
    header = F.concat(F.lit(WINDOW_END_LABEL), utc_text(seconds))
    body = F.concat_ws("\n", F.lit(RULE_ABOVE), header, F.col("rows.line"), F.lit(RULE_BELOW), F.lit(""))
    return texts.select(window, body.alias("report"))


def utc_text(ts: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss.S` in UTC whatever the session zone."""
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz")),
                         "yyyy-MM-dd HH:mm:ss.S")


def limit_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page_rows(df: DataFrame, order: Sequence[str], page: int, size: int, blocks: Blocks | None = None) -> DataFrame:
    """Page `page` (from 1) of `size` rows in the order of the given columns, an integer first.

    Rows that tie in all of them follow the hash of the whole row, so every page is cut from one
    total order and the pages hold each row once. Positions are counted block-wise at any
    depth; no task sees the rows before the page.
    """
    start = (page - 1) * size
    tied = df.withColumn("__tie", F.xxhash64(*df.columns))
    cut = blocks or Blocks.fit(df, order[0])
    numbered = running(tied, [], [*order, "__tie"], cut, {"__pos": running_count()})
    return numbered.filter((F.col("__pos") > start) & (F.col("__pos") <= start + size)).drop("__pos", "__tie")
