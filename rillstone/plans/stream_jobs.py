"""The end-to-end jobs as streams, and the stateful operators with timers.

Each reads its table as it arrives, in several micro-batches, restarting from its checkpoint
between them, and is checked against the SQL of its batch twin.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import changelog, late, topn
from rillstone.plans.catalog import CATALOG, register, rounded
from rillstone.plans.event_windows import TOP_SQL, hot_counts
from rillstone.plans.jobs import csv_route_job
from rillstone.plans.streams import PARTS, arriving
from rillstone.schemas import EVENTS
from rillstone.session import shared_dir
from rillstone.sources import tables, text
from rillstone.sources.tables import SEQ_BLOCKS
from rillstone.streaming import ordered, pipelines
from rillstone.streaming.carried import changelog_step, late_step
from rillstone.sinks.writers import table_batch
from rillstone.streaming.runner import Replay, open_replay, run_batches, with_state


def end_row(spark):
    """An event long after all others, of a user and an item that are nobody's."""
    return spark.sql(
        """select * from (select -1L, timestamp_ntz'2999-01-01 00:00:00', -1L, 'end', 0D, '{"k": -1}')
           as t(event_id, ts, user_id, event_type, value, props)"""
    )


def replayed_in_parts(spark, sf, build, transform=None):
    replay = Replay(spark, f"{shared_dir(spark, 'arriving')}/events", EVENTS)
    parts = tables.in_parts(tables.table(spark, sf, "events"), F.col("event_id"), PARTS)
    return replay.run_parts(build, parts, end_row(spark), transform).drop("batch_id")


def in_batches(spark, sf, build):
    """A stream without state over the events as they arrive, one micro-batch for each part."""
    home = shared_dir(spark, "arriving")
    for part in tables.in_parts(tables.table(spark, sf, "events"), F.col("event_id"), PARTS):
        part.write.mode("append").parquet(f"{home}/events")
        rows = build(open_replay(spark, f"{home}/events", EVENTS))
        run_batches(rows, table_batch(f"{home}/out"), f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/out").drop("batch_id")


@register("job_hot_items_stream", CATALOG["job_hot_items"].oracle)
def job_hot_items_stream(spark, sf):
    """Click-stream lines to one ranking text per window, sent when the window closes."""

    def build(events):
        rows = tables.user_behavior_from(events)
        line = F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns])
        return pipelines.hop_views(text.parse_user_behavior_csv(rows.select(line.alias("value"))))

    def report(batch):
        return topn.format_report(pipelines.rank_closed_windows(5)(batch))

    return replayed_in_parts(spark, sf, build, report)


@register("rising_temp_alert_stream", CATALOG["rising_temp_alert_repeated"].oracle)
def rising_temp_alert_stream(spark, sf):
    """All alerts, from keyed state and event-time timers."""

    def build(events):
        timed = ordered.behind_watermark(tables.sensor_from(events), "0 seconds")
        return with_state(timed, ["id"], ordered.RisingAlertByTime(18_000), "eventTime")

    return replayed_in_parts(spark, sf, build).filter("id <> 'sensor_-1'")


@register("process_element_timers_stream", CATALOG["process_element_timers"].oracle)
def process_element_timers_stream(spark, sf):
    """The timers that fired."""

    def build(events):
        timed = ordered.behind_watermark(tables.sensor_from(events), "0 seconds")
        return with_state(timed, ["id"], ordered.ElementTimersByTime(10, 100), "eventTime")

    fired = replayed_in_parts(spark, sf, build).filter("what = 'timer' and id <> 'sensor_-1'")
    return fired.select("id", F.col("at_ms").alias("fire_ms"))


COUNTS = "itemId bigint, window_end bigint, cnt bigint"


@register("topn_list_state_timer", TOP_SQL)
def topn_list_state_timer(spark, sf):
    """The ranking of every window from list state, sent by a timer after the window's end.

    Two streams: the best of every share of a window's items, and the best of these.
    """
    last = spark.createDataFrame([(-1, 32_503_680_000_000, 1)], COUNTS)
    parts = tables.in_parts(hot_counts(spark, sf), F.col("window_end"), PARTS)
    first = Replay(spark, f"{shared_dir(spark, 'arriving')}/counts", COUNTS)
    best = first.run_parts(pipelines.hot_items_by_share, parts, last).select("itemId", "window_end", "cnt")
    second = Replay(spark, f"{shared_dir(spark, 'arriving')}/best", COUNTS)
    out = second.run_parts(pipelines.hot_items_by_timer, [best], last)
    return out.filter("itemId >= 0").select("window_end", "itemId", "cnt", "row_num")


@register("job_sensor_table_stream", CATALOG["job_sensor_table"].oracle)
def job_sensor_table_stream(spark, sf):
    """One sensor's readings, and the averages that the stream of changes of all others leads to."""
    one = in_batches(spark, sf, lambda events: tables.sensor_from(events).where("id = 'sensor_1'"))
    changes = arriving(
        spark, sf, changelog_step("id", "temperature", "seq", SEQ_BLOCKS), ["id"],
        lambda rows: rows.where("id <> 'sensor_1'"),
    )
    final = changelog.fold_changelog(changes, "id", "seq")
    return one.select(
        F.lit("one").alias("part"), "id", rounded("temperature").alias("val"), F.lit(1).cast("bigint").alias("cnt")
    ).unionByName(final.select(F.lit("averages").alias("part"), "id", rounded("avg_temp").alias("val"), "cnt"))


@register("job_sensor_late_stream", CATALOG["job_sensor_late"].oracle)
def job_sensor_late_stream(spark, sf):
    """Window minima with allowed lateness, and the rows that came too late, as they arrive."""
    step = late_step("timestamp", ["arrival_ms", "seq"], 15_000, 20, 60_000)
    classes = arriving(spark, sf, step, [], order=tables.arrival_ms())
    columns = ["id", "window_end", "temperature", "seq"]
    minima = late.min_by_with_lateness(classes, "id", "temperature", "seq")
    return minima.select(F.lit("minima").alias("part"), *columns).unionByName(
        late.split_late(classes)[1].select(F.lit("late").alias("part"), *columns)
    )


@register("job_kafka_csv_route_stream", CATALOG["job_kafka_csv_route"].oracle)
def job_kafka_csv_route_stream(spark, sf):
    def build(events):
        line = F.concat_ws(",", "id", F.col("timestamp").cast("string"), F.col("temperature").cast("string"))
        return csv_route_job(tables.sensor_from(events).select(line.alias("value")), "sensor_1")

    return in_batches(spark, sf, build)
