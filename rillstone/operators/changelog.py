"""Updating results as a stream of deletions (`false`) and additions (`true`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.operators.blocks import Blocks, Running, over_preceding, running, running_count, running_sum
from rillstone.session import stored


def avg_count_measures(value: str) -> dict[str, Running]:
    """Sum, non-null count and count of a value up to the current record."""
    seen = F.col(value).isNotNull().cast("bigint")
    return {"sum": running_sum(F.col(value)), "seen": running_sum(seen), "n": running_count()}


def averages(
    df: DataFrame, key: str, value: str, order: str, blocks: Blocks, initial: DataFrame | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """(key, order, avg_temp, cnt) after every record, and those of the measures to keep."""
    state = running(df.select(key, order, value), [key], [order], blocks, avg_count_measures(value), initial)
    avg = F.col("sum") / F.nullif(F.col("seen"), F.lit(0))
    return state.select(key, order, avg.alias("avg_temp"), F.col("n").alias("cnt"), *keep)


def changes_of(results: DataFrame, key: str, order: str, blocks: Blocks, sent: DataFrame | None = None) -> DataFrame:
    """Deletions and additions that lead from each result of a key to its next.

    `results` must be stored: a sum of doubles computed again may differ in its last bits, and a
    deletion must be the very value that was added. `sent` holds each key's last result so far.
    """
    look = {c: (lambda w, c=c: F.lag(c.removeprefix("old_"), 1).over(w)) for c in ("old_avg_temp", "old_cnt")}
    both = over_preceding(results, [key], [order], blocks, 1, ["avg_temp", "cnt"], look, sent)

    def row(op: bool, prefix: str):
        return F.struct(F.lit(op).alias("op"), F.col(prefix + "avg_temp").alias("avg_temp"), F.col(prefix + "cnt").alias("cnt"))

    new, old = row(True, ""), row(False, "old_")
    same = old["avg_temp"].eqNullSafe(new["avg_temp"]) & old["cnt"].eqNullSafe(new["cnt"])
    changes = F.when(F.col("old_cnt").isNull(), F.array(new)).when(same, F.slice(F.array(new), 1, 0))
    return both.select(key, order, F.inline(changes.otherwise(F.array(old, new))))


def retract_changelog(df: DataFrame, key: str, value: str, order: str, blocks: Blocks) -> DataFrame:
    """Per record: delete the key's old (avg, count), add the new one.

    The first record of a key has nothing to delete, and an unchanged result is not sent.
    """
    return changes_of(stored(averages(df, key, value, order, blocks), "changelog"), key, order, blocks)


def fold_changelog(changes: DataFrame, key: str, order: str) -> DataFrame:
    """The table a changelog describes: each key's last addition.

    Every key that changes is added again at the same place of the order.
    """
    # one aggregate a column: fixed-size values are hash-aggregated, structs sorted
    return changes.filter("op").groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in ("avg_temp", "cnt")])
