"""Per-record running aggregates of a keyed sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.blocks import (
    Blocks,
    over_preceding,
    running,
    running_count,
    running_first,
    running_max,
)


def rolling_max(df: DataFrame, key: str, value: str, order: str, blocks: Blocks,
                first_of: Sequence[str]) -> DataFrame:
    """Per record: the maximum so far; the `first_of` fields come from the key's first record."""
    measures = {f"__max_{value}": running_max(F.col(value))}
    measures |= {f"__first_{c}": running_first(F.col(c), [order]) for c in first_of}
    out = running(df, [key], [order], blocks, measures)
    replaced = {value: F.col(f"__max_{value}"), **{c: F.col(f"__first_{c}") for c in first_of}}
    return out.select(*[replaced.get(c, F.col(c)).alias(c) for c in df.columns])


def rolling_max_by(df: DataFrame, key: str, value: str, order: str, blocks: Blocks) -> DataFrame:
    """Per record: the whole record that holds the maximum so far; the first one on ties."""
    others = [c for c in df.columns if c not in (key, value, order)]
    best = F.struct(F.col(value), (-F.col(order)).alias("__neg"), *others)
    out = running(df.select(key, value, order, *others), [key], [order], blocks,
                  {"__best": running_max(best)})
    picked = {value: F.col("__best")[value], "best_" + order: -F.col("__best")["__neg"],
              **{c: F.col("__best")[c] for c in others}}
    return out.select(key, order, *[e.alias(c) for c, e in picked.items()])


def rolling_max_keep_last(df: DataFrame, key: str, value: str, order: str, blocks: Blocks) -> DataFrame:
    """Per record: the maximum so far with the record's own other fields."""
    out = running(df, [key], [order], blocks, {"__max": running_max(F.col(value))})
    return out.select(*[F.col("__max").alias(c) if c == value else F.col(c) for c in df.columns])


def keyed_running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: Blocks,
                        name: str = "n") -> DataFrame:
    """1-based count of the key's records so far."""
    return running(df, keys, order, blocks, {name: running_count()})


def over_rows(df: DataFrame, key: str, order: Sequence[str], blocks: Blocks, preceding: int,
              count_of: str, avg_of: str, initial: DataFrame | None = None) -> DataFrame:
    """Count and average over the current record and the `preceding` records before it."""

    def frame(w):
        return w.rowsBetween(-preceding, 0)

    return over_preceding(
        df, [key], order, blocks, preceding, [count_of, avg_of],
        {"cnt": lambda w: F.count(count_of).over(frame(w)),
         "avg_temp": lambda w: F.avg(avg_of).over(frame(w))},
        initial,
    )


def last_n_text(df: DataFrame, key: str, order: str, blocks: Blocks, n: int, value: Column,
                name: str = "last_values", initial: DataFrame | None = None) -> DataFrame:
    """The last n values of the key up to each record, joined by commas."""
    held = df.withColumn("__v", value)
    out = over_preceding(
        held, [key], [order], blocks, n - 1, ["__v"],
        {name: lambda w: F.concat_ws(",", F.collect_list("__v").over(w.rowsBetween(1 - n, 0)))},
        initial,
    )
    return out.drop("__v")
