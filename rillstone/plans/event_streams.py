"""Streams whose rows arrive far out of order: event-time frames, allowed lateness, processing time.

The events arrive by `far_arrival_ms`, up to 17 hours out of their time order, in several micro-batches.
The watermark moves between these, so what is late follows from the batches before, which the SQL
computes on its own.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions.strings import java_hash
from rillstone.operators import alerts, changelog, late, topn, words
from rillstone.plans.catalog import CATALOG, SENSOR, register, rounded, rounded_sql, with_
from rillstone.plans.event_windows import OVER_SQL, tumble_sql
from rillstone.plans.stateful import JUMP_SQL
from rillstone.plans.stream_jobs import end_row, replayed_in_parts
from rillstone.plans.streams import arriving, sensor_stream
from rillstone.schemas import EVENTS
from rillstone.session import shared_dir
from rillstone.sinks.writers import manifest_batch, read_batches, read_manifest, table_batch
from rillstone.sources import tables
from rillstone.sources.tables import SEQ_BLOCKS
from rillstone.streaming import ordered, pipelines
from rillstone.streaming.carried import Carry, changelog_step, jump_step, resharded, run_carried, running_step, top_step
from rillstone.streaming.runner import Replay, open_replay, run_at_intervals, run_batches, with_state
from rillstone.operators.blocks import running_count

PARTS = 4
NONE_LATE_MS = 61_000_000
SOME_LATE_MS = 7_200_000
DAY_MS = 86_400_000
LATENESS_MS = 14_400_000

# Rows with the micro-batch (`part`) they arrive in, and the watermark in force then.
ARRIVALS = """, placed as (
  select *, "timestamp" * 1000 as time_ms from (
    select *, "timestamp" * 1000 + (seq * 7919) % 600000 * 100 as epoch_arrival from sensor)),
parted as (
  select *, (epoch_arrival - min(epoch_arrival) over ())
    // ((max(epoch_arrival) over () - min(epoch_arrival) over ()) // 4 + 1) as part
  from placed),
marks as (
  select part, max(max(time_ms)) over (order by part rows between unbounded preceding and 1 preceding) as latest
  from parted group by part),
arrived as (select p.*, coalesce(latest - {delay}, 0) as mark from parted p join marks using (part))
"""


def far_arrival_ms():
    seconds = tables.seconds_of(F.col("ts"))
    return seconds * 1000 + (F.col("event_id") * tables.ARRIVAL_STRIDE) % tables.ARRIVAL_SPREAD_MS * 100


def far_readings(events):
    return tables.sensor_from(events).withColumn(
        "arrival_ms", F.col("timestamp") * 1000 + (F.col("seq") * tables.ARRIVAL_STRIDE) % tables.ARRIVAL_SPREAD_MS * 100
    )


def arriving_late(spark, sf, build, parts=PARTS, idle_batches=True):
    """The events in parts by arrival, each a micro-batch, then a row at the end of time."""
    replay = Replay(spark, f"{shared_dir(spark, 'arriving')}/events", EVENTS, idle_batches=idle_batches)
    dealt = tables.in_parts(tables.table(spark, sf, "events"), far_arrival_ms(), parts)
    return replay.run_parts(build, dealt, end_row(spark)).filter("id <> 'sensor_-1'")


def over_by_time(delay_ms):
    def build(events):
        timed = ordered.behind_watermark(far_readings(events), f"{delay_ms} milliseconds")
        return with_state(timed, ["id"], ordered.OverRowsByTime(2), "eventTime")

    return build


@register("over_rows_agg_stream", OVER_SQL)
def over_rows_agg_stream(spark, sf):
    """Frames by event time over rows that arrive out of order; none is late."""
    out = arriving_late(spark, sf, over_by_time(NONE_LATE_MS)).filter("not late")
    return out.select("id", "seq", "rt_ms", "cnt", rounded("avg_temp").alias("avg_temp"))


@register(
    "over_rows_late_stream",
    with_(SENSOR) + ARRIVALS.format(delay=SOME_LATE_MS)
    + f"""select id, seq, time_ms as rt_ms, true as late, 0::bigint as cnt, null::double as avg_temp
    from arrived where time_ms <= mark
    union all
    select id, seq, time_ms, false, count(id) over ow, {rounded_sql('avg(temperature) over ow')}
    from arrived where time_ms > mark
    window ow as (partition by id order by time_ms, seq rows between 2 preceding and current row)""",
)
def over_rows_late_stream(spark, sf):
    """The same with a shorter wait: rows behind the watermark are given out as late."""
    out = arriving_late(spark, sf, over_by_time(SOME_LATE_MS))
    return out.select("id", "seq", "rt_ms", "late", "cnt", rounded("avg_temp").alias("avg_temp"))


@register(
    "allowed_lateness_stream",
    with_(SENSOR) + ARRIVALS.format(delay=20)
    + f""", ended as (select *, time_ms - time_ms % {DAY_MS} + {DAY_MS} as window_end from arrived),
    kept as (select *, window_end <= mark as again from ended where window_end + {LATENESS_MS} > mark),
    sent as (
      select id, window_end, again, epoch_arrival, seq,
        min((temperature, seq)) over (partition by id, window_end order by again, case when again then epoch_arrival else 0 end,
          case when again then seq else 0 end range between unbounded preceding and current row) as best,
        max(case when again then 0 else 1 end) over (partition by id, window_end) as on_time
      from kept),
    versions as (
      select id, window_end, 1 as version, any_value(best) as best from sent where not again group by 1, 2
      union all
      select id, window_end, on_time + row_number() over (partition by id, window_end order by epoch_arrival, seq), best
      from sent where again)
    select id, window_end, version::int as version, best[1] as temperature, best[2] as seq, false as late from versions
    union all
    select id, window_end, 0, temperature, seq, true from ended where window_end + {LATENESS_MS} <= mark""",
)
def allowed_lateness_stream(spark, sf):
    """Every version of every window: one at its end, and one for each row that is late but allowed."""

    def build(events):
        timed = ordered.behind_watermark(far_readings(events), "20 milliseconds")
        ended = timed.withColumn("window_end", F.expr(f"timestamp * 1000 - timestamp * 1000 % {DAY_MS} + {DAY_MS}"))
        return with_state(ended, ["id"], ordered.LatenessVersions(LATENESS_MS), "eventTime")

    return arriving_late(spark, sf, build).drop("batch_id")


@register("tumble_proc_min_by_stream", with_(SENSOR) + "select id, seq, temperature, true as least_of_window from sensor")
def tumble_proc_min_by_stream(spark, sf):
    """Minima by processing time: each window's is compared with the rows stamped into it."""

    def build(events):
        return with_state(tables.sensor_from(events), ["id"], ordered.ProcessingMinima(10), "processingTime")

    out = arriving_late(spark, sf, build, 3, idle_batches=False)
    rows = out.filter("what = 'row'")
    least = rows.groupBy("id", "window_end").agg(F.min(F.struct("temperature", "seq")).alias("want"))
    sent = out.filter("what = 'window'").select("id", "window_end", F.struct("temperature", "seq").alias("got"))
    both = least.join(sent, ["id", "window_end"], "left").select("id", "window_end", F.col("want").eqNullSafe(F.col("got")).alias("same"))
    inside = F.col("stamp_ms").between(F.col("window_end") - 10, F.col("window_end") - 1)
    return rows.join(both, ["id", "window_end"]).select("id", "seq", "temperature", (F.col("same") & inside).alias("least_of_window"))


# Rows with the part of the table they arrive in, when it arrives by event_id in three parts.
IN_PARTS = """, parted as (
  select *, (seq - min(seq) over ()) // ((max(seq) over () - min(seq) over ()) // 3 + 1) as part from sensor)"""


@register(
    "process_context",
    with_(SENSOR) + IN_PARTS + """, marks as (
      select part, max(max("timestamp" * 1000)) over (order by part) as watermark from parted group by part)
    select id, seq, "timestamp" * 1000 as at_ms, length(id)::int as len, 'event_time' as domain, watermark,
      true as has_clock from parted join marks using (part)""",
)
def process_context(spark, sf):
    """What a processor knows of a row: key, element time, time domain, watermark and processing time."""

    def build(events):
        timed = ordered.behind_watermark(tables.sensor_from(events), "0 seconds")
        return with_state(timed, ["id"], ordered.ElementTimersByTime(10, 100), "eventTime")

    rows = replayed_in_parts(spark, sf, build).filter("what = 'row' and id <> 'sensor_-1'")
    return rows.select("id", "seq", "at_ms", "len", "domain", "watermark", (F.col("processing_ms") > 0).alias("has_clock"))


READINGS_SQL = with_(SENSOR) + "select id, seq, temperature from sensor"


def event_parts(spark, sf, parts=3):
    return tables.in_parts(tables.table(spark, sf, "events"), F.col("event_id"), parts)


@register("checkpointed_run", READINGS_SQL)
def checkpointed_run(spark, sf):
    """A run that is stopped between writing a batch and committing it, and started again from its checkpoint."""
    home = shared_dir(spark, "manifest")
    commit = manifest_batch(f"{home}/out")
    stopped = []

    def stops_once(batch, batch_id):
        if batch_id == 1 and not stopped:
            stopped.append(batch_id)
            batch.write.parquet(f"{home}/out/data/left-behind")
            raise RuntimeError("stopped before the commit")
        commit(batch, batch_id)

    for number, part in enumerate(event_parts(spark, sf)):
        part.write.mode("append").parquet(f"{home}/events")
        rows = sensor_stream(spark, f"{home}/events").select("id", "seq", "temperature")
        try:
            run_batches(rows, stops_once, f"{home}/checkpoint")
        except Exception:
            if not stopped or number != 1:
                raise
            run_batches(rows, stops_once, f"{home}/checkpoint")
    return read_manifest(spark, f"{home}/out", "id string, seq bigint, temperature double").drop("batch_id")


@register("trigger_interval", READINGS_SQL)
def trigger_interval(spark, sf):
    """Batches started by an interval, one file each, until all files are done."""
    home = shared_dir(spark, "interval")
    for part in event_parts(spark, sf):
        part.write.mode("append").parquet(f"{home}/events")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{home}/events")
    rows = tables.sensor_from(stream).select("id", "seq", "temperature")
    run_at_intervals(rows, manifest_batch(f"{home}/out"), f"{home}/checkpoint", "100 milliseconds")
    return read_manifest(spark, f"{home}/out", "id string, seq bigint, temperature double").drop("batch_id")


@register("end_of_stream_flush", tumble_sql(3600))
def end_of_stream_flush(spark, sf):
    """Windows that are still open when the input ends are closed by the end row."""
    out = replayed_in_parts(spark, sf, lambda rows: pipelines.tumbling_avg(tables.sensor_from(rows), 3_600_000))
    return out.filter("id <> 'sensor_-1'").withColumn("avg_temp", rounded("avg_temp"))


@register(
    "subtask_counter_rescaled",
    with_(SENSOR) + IN_PARTS + """, base as (
      select shard % 3 as shard, sum(n) as n from (
        select seq % 4 as shard, count(*) as n from parted where part < 2 group by 1) group by 1)
    select (seq % 4)::int as shard, seq, row_number() over (partition by seq % 4 order by seq) - 1 as n
    from parted where part < 2
    union all
    select (seq % 3)::int, seq, (coalesce(b.n, 0) + row_number() over (partition by seq % 3 order by seq) - 1)::bigint
    from parted p left join base b on b.shard = p.seq % 3 where part >= 2""",
)
def subtask_counter_rescaled(spark, sf):
    """Counters per instance that are restored on fewer instances: four, and three for the last part."""
    home = shared_dir(spark, "rescaled")
    step = running_step(["shard"], ["seq"], SEQ_BLOCKS, lambda: {"n": running_count()})
    for number, part in enumerate(event_parts(spark, sf)):
        part.write.mode("append").parquet(f"{home}/events")
        shards = 4 if number < 2 else 3
        if number == 2:
            Carry(f"{home}/run/carry", ["shard"]).restate(spark, lambda state: resharded(state, "shard", 3))
        rows = sensor_stream(spark, f"{home}/events").select((F.col("seq") % shards).cast("int").alias("shard"), "seq")
        out = run_carried(rows, step, f"{home}/run", ["shard"])
    return out.withColumn("n", F.col("n") - 1)


@register("job_sensor_windows_stream", CATALOG["job_sensor_windows"].oracle)
def job_sensor_windows_stream(spark, sf):
    """Tumbling averages and event-time frames of readings as they arrive."""
    tumble = replayed_in_parts(spark, sf, lambda rows: pipelines.tumbling_avg(tables.sensor_from(rows), 10_000))
    tumble = tumble.filter("id <> 'sensor_-1'").select(
        F.lit("tumble").alias("part"), "id", F.col("window_end").alias("at_ms"), "cnt", rounded("avg_temp").alias("avg_temp")
    )
    over = arriving_late(spark, sf, over_by_time(NONE_LATE_MS)).filter("not late")
    return tumble.unionByName(
        over.select(F.lit("over").alias("part"), "id", F.col("rt_ms").alias("at_ms"), "cnt", rounded("avg_temp").alias("avg_temp"))
    )


def without_end(out):
    return out.filter("id <> 'sensor_-1'")


@register("job_sensor_functions_stream", CATALOG["job_sensor_functions"].oracle)
def job_sensor_functions_stream(spark, sf):
    """Hashes and words of every row, and each sensor's average and two highest values as its rows arrive."""

    def rows(df, part, word, value):
        return df.select(F.lit(part).alias("part"), "id", word.alias("word"), value.cast("double").alias("val"))

    def each(events):
        readings = tables.sensor_from(events)
        hashes = rows(readings, "hash", F.lit(""), java_hash(F.col("id")))
        return hashes.unionByName(rows(words.lateral_split(readings, "id", "_", ["id"]), "words", F.col("word"), F.col("length")))

    order = [F.desc("temperature"), F.asc("seq")]
    changing = changelog_step("id", "temperature", "seq", SEQ_BLOCKS)
    leading = top_step("id", order, ["temperature", "seq"], 2, "temp_rank")
    home = shared_dir(spark, "arriving")
    for part in event_parts(spark, sf):  # each part is written once, and a micro-batch of all three streams
        tables.spread(part, "event_id").write.mode("append").parquet(f"{home}/events")
        readings = sensor_stream(spark, f"{home}/events").select("id", "seq", "temperature")
        changes = run_carried(readings, changing, f"{home}/changes", ["id"])
        sent = run_carried(readings, leading, f"{home}/top", ["id"])
        run_batches(each(open_replay(spark, f"{home}/events", EVENTS)), table_batch(f"{home}/each/out"), f"{home}/each/checkpoint")
    averages = changelog.fold_changelog(changes, "id", "seq")
    # a row sent again is the same row; the last state of a key is the first rows of all that were sent
    top = topn.top_n(sent.select("id", "temperature", "seq").distinct(), ["id"], order, 2, "temp_rank")
    return (
        read_batches(spark, f"{home}/each/out", "part string, id string, word string, val double").drop("batch_id")
        .unionByName(rows(averages, "avg", F.lit(""), rounded("avg_temp")))
        .unionByName(rows(top, "top", F.col("temp_rank").cast("string"), F.col("temperature")))
    )


ALERT_ROWS_SQL = f"""
select 'jump' as part, id, seq as at, last_temp as a, cur_temp as b from ({JUMP_SQL})
union all select 'rising', id, start, fire::double, 0 from ({CATALOG["rising_temp_alert_repeated"].oracle})
union all select case when temperature > 30 then 'high' else 'low' end, id, seq, temperature, 0
  from ({with_(SENSOR)} select id, seq, temperature from sensor)"""


def alert_rows(jump, rising, routes):
    none = F.lit(0.0)
    return (
        jump.select(F.lit("jump").alias("part"), "id", F.col("seq").alias("at"), F.col("last_temp").alias("a"), F.col("cur_temp").alias("b"))
        .unionByName(rising.select(F.lit("rising").alias("part"), "id", F.col("start").alias("at"), F.col("fire").cast("double").alias("a"), none.alias("b")))
        .unionByName(routes.select(F.col("route").alias("part"), "id", F.col("seq").alias("at"), F.col("temperature").alias("a"), none.alias("b")))
    )


@register("job_sensor_alerts_rows", ALERT_ROWS_SQL)
def job_sensor_alerts_rows(spark, sf):
    """Every alert and every routed row of the alerts job."""
    readings = tables.sensor(spark, sf)
    jump = alerts.temp_jump_alert(readings, "id", "temperature", "seq", SEQ_BLOCKS, 10.0)
    rising = alerts.rising_alerts(readings, "id", "temperature", "timestamp", "seq", SEQ_BLOCKS, 18_000)
    return alert_rows(jump, rising, late.side_output_split(readings, "temperature", 30.0))


@register("job_sensor_alerts_stream", ALERT_ROWS_SQL)
def job_sensor_alerts_stream(spark, sf):
    """The same from streams: carried state, timers, and routes of each row."""

    def rising(events):
        timed = ordered.behind_watermark(tables.sensor_from(events), "0 seconds")
        return with_state(timed, ["id"], ordered.RisingAlertByTime(18_000), "eventTime")

    def routes(events):
        return late.side_output_split(tables.sensor_from(events).select("id", "seq", "temperature"), "temperature", 30.0)

    jump = arriving(spark, sf, jump_step("id", "temperature", "seq", SEQ_BLOCKS, 10.0), ["id"])
    return alert_rows(
        jump, without_end(replayed_in_parts(spark, sf, rising)), without_end(replayed_in_parts(spark, sf, routes))
    )
