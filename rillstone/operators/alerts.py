"""Alerts on keyed sequences, in batch form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.operators.blocks import Blocks, over_preceding, running, running_max, running_sum
from rillstone.session import shared_dir, stored


def temp_jump_alert(
    df: DataFrame, key: str, value: str, order: str, blocks: Blocks, threshold: float = 10.0,
    initial: DataFrame | None = None,
) -> DataFrame:
    """(key, last, current) where consecutive values differ by the threshold or more."""
    with_last = over_preceding(
        df.select(key, order, value), [key], [order], blocks, 1, [value],
        {"last_temp": lambda w: F.lag(value).over(w)}, initial,
    )
    jumped = F.abs(F.col(value) - F.col("last_temp")) >= threshold
    return with_last.filter(jumped).select(key, order, "last_temp", F.col(value).alias("cur_temp"))


def _run_marks(
    df: DataFrame, key: str, value: str, time: str, order: str, blocks: Blocks
) -> DataFrame:
    """(key, run, time, rose, closes): the records of every run without a fall.

    A run begins with a record lower than the one before it. Such a record opens its own run
    and also appears, with `closes`, at the end of the run before.
    """
    steps = over_preceding(
        df.select(key, time, order, value), [key], [order], blocks, 1, [value],
        {"__last": lambda w: F.lag(value).over(w)},
    )
    fell = F.coalesce(F.col(value) < F.col("__last"), F.lit(False))
    rose = F.coalesce(F.col(value) > F.col("__last"), F.lit(False))
    tagged = steps.select(key, order, time, fell.alias("fell"), rose.alias("rose"))
    runs = running(stored(tagged, "steps"), [key], [order], blocks,
                   {"own": running_sum(F.col("fell").cast("bigint"))})
    belongs = F.when(F.col("fell"), F.array("own", F.col("own") - 1)).otherwise(F.array("own"))
    marks = runs.select(key, time, "rose", "own", F.explode(belongs).alias("run"))
    return marks.select(key, "run", time, "rose", (F.col("own") > F.col("run")).alias("closes"))


def _run_spans(marks: DataFrame, key: str, time: str) -> DataFrame:
    """(key, run, start, last_rise, fall) of every run that rises."""
    rise = F.when(F.col("rose") & ~F.col("closes"), F.col(time))
    spans = marks.groupBy(key, "run").agg(
        F.min(rise).alias("start"),
        F.max(rise).alias("last_rise"),
        F.min(F.when(F.col("closes"), F.col(time))).alias("fall"),
    )
    return spans.filter(F.col("start").isNotNull())


def _fired(starts: DataFrame, key: str, interval: int) -> DataFrame:
    fire = F.col("start") + interval
    return starts.filter(F.col("fall").isNull() | (F.col("fall") > fire)).select(
        key, "start", fire.alias("fire")
    )


def rising_alert_first(
    df: DataFrame, key: str, value: str, time: str, order: str, blocks: Blocks, interval: int
) -> DataFrame:
    """The first alert of every run without a fall: (key, start, fire).

    Its timer starts at the run's first rise and fires `interval` time units later, unless the
    next run has begun by then.
    """
    marks = _run_marks(df, key, value, time, order, blocks)
    return _fired(_run_spans(marks, key, time), key, interval)


# Rises of a run have distinct times, so this bounds the rows of a block of one run.
RISE_BLOCK = 500_000


def rising_alerts(
    df: DataFrame, key: str, value: str, time: str, order: str, blocks: Blocks, interval: int
) -> DataFrame:
    """Every alert: after one has fired, the run's next rise starts a new timer.

    Runs whose rises span more than the interval may alert repeatedly. There each rise points
    to the first rise after its own timer; the starts are those reached from the first rise.
    They are found by doubling the pointers' length, in as many rounds as the logarithm of
    the longest chain, each round written to the shared folder.
    """
    spark = df.sparkSession
    home = shared_dir(spark, "rising")

    def kept(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{home}/{name}")
        return spark.read.parquet(f"{home}/{name}")

    at = [key, "run"]
    marks = kept(_run_marks(df, key, value, time, order, blocks), "marks")
    spans = kept(_run_spans(marks, key, time), "spans")
    repeating = F.col("last_rise") > F.col("start") + interval
    rises = marks.filter(F.col("rose") & ~F.col("closes")).select(*at, F.col(time).alias("t")).distinct()
    # Written once: read twice below, where its joins and sorts would all meet in the tasks of one stage.
    rises = kept(rises.join(spans.filter(repeating).select(*at), at, "left_semi"), "rises")

    reached = spans.filter(repeating).select(*at, F.col("start").alias("t"))
    jumps = kept(_next_rises(rises, at, interval), "jumps_0")
    found = [reached]
    turn = 0
    while not jumps.isEmpty():
        turn += 1
        # What the chain has so far leads, one jump on, to as many new starts.
        known = reduce(DataFrame.unionByName, found)
        found.append(kept(known.join(jumps, [*at, "t"]).select(*at, F.col("to").alias("t")), f"found_{turn}"))
        onward = jumps.select(*at, F.col("t").alias("to"), F.col("to").alias("far"))
        jumps = kept(jumps.join(onward, [*at, "to"]).select(*at, "t", F.col("far").alias("to")),
                     f"jumps_{turn}")
    starts = reduce(DataFrame.unionByName, found).withColumnRenamed("t", "start")
    repeated = starts.join(spans.drop("start"), at)
    once = spans.filter(~repeating)
    return _fired(once.unionByName(repeated), key, interval)


def _next_rises(rises: DataFrame, at: list[str], interval: int) -> DataFrame:
    """(.., t, to): for each rise the first one of its run later than `t + interval`.

    Rises and timer ends are put in falling order of time, where the rise sought is the last
    one seen; a timer's end comes before a rise at the same moment.
    """
    none = F.lit(None).cast("bigint")
    rise = F.struct((-F.col("t")).alias("back"), F.lit(1).alias("kind"), (-F.col("t")).alias("seen"), none.alias("t"))
    end = F.struct((-F.col("t") - interval).alias("back"), F.lit(0).alias("kind"), none.alias("seen"), F.col("t"))
    both = rises.select(*at, F.inline(F.array(rise, end)))
    near = running(both, at, ["back", "kind"], Blocks("back", RISE_BLOCK), {"near": running_max(F.col("seen"))})
    return near.filter("kind = 0 and near is not null").select(*at, "t", (-F.col("near")).alias("to"))


def timer_set(
    df: DataFrame, key: str, time: str, order: str, after: int, deleted_after: int
) -> DataFrame:
    """The timers left after all records, each record setting one at `t + after` and deleting
    one at `t + deleted_after`: (key, fire_ms).

    Setting is set-like, so per key and time only the last action in arrival order counts.
    """
    action = F.explode(
        F.array(
            F.struct(((F.col(time) + after) * 1000).alias("fire_ms"), F.lit(1).alias("live")),
            F.struct(((F.col(time) + deleted_after) * 1000).alias("fire_ms"), F.lit(0).alias("live")),
        )
    )
    actions = df.select(key, order, action.alias("a")).select(key, order, "a.*")
    last = actions.groupBy(key, "fire_ms").agg(F.max_by("live", order).alias("live"))
    return last.filter("live = 1").drop("live")
