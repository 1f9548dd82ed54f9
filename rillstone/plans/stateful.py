"""Batch twins of the stateful stream operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import alerts, late, rolling
from rillstone.operators.blocks import Blocks, running, running_count, running_max, running_sum
from rillstone.plans.catalog import SENSOR, register, rounded, rounded_sql, with_
from rillstone.session import stored
from rillstone.sources import tables
from rillstone.sources.tables import SEQ_BLOCKS

ARRIVAL = ["arrival_ms", "seq"]

TRACE = """, traced as (
  select *, "timestamp" * 1000 as time_ms, max("timestamp" * 1000) over (order by arrival_ms, seq
    rows between unbounded preceding and 1 preceding) - 20 as watermark
  from sensor)"""

CLASSES = TRACE + """, ends as (
  select *, time_ms - time_ms % 15000 + 15000 as window_end from traced),
classes as (
  select *, case when watermark is null or window_end > watermark then 'on_time'
    when window_end + 60000 > watermark then 'allowed' else 'late' end as late_class
  from ends)"""


def arrivals(spark, sf):
    return tables.sensor(spark, sf).select("id", "timestamp", "temperature", "seq", "arrival_ms")


def time_ms():
    return F.col("timestamp") * 1000


def classified(spark, sf):
    rows = arrivals(spark, sf)
    return late.late_classify(rows, time_ms(), ARRIVAL, Blocks.fit(rows, "arrival_ms"), 15_000, 20, 60_000)


@register("watermark_trace", with_(SENSOR) + TRACE + "select seq, time_ms, coalesce(watermark, -1) as watermark from traced")
def watermark_trace(spark, sf):
    rows = arrivals(spark, sf)
    traced = late.watermark_trace(rows, time_ms(), ARRIVAL, Blocks.fit(rows, "arrival_ms"), 20)
    mark = F.coalesce("watermark", F.lit(-1).cast("bigint"))
    return traced.select("seq", time_ms().alias("time_ms"), mark.alias("watermark"))


@register(
    "late_classify", with_(SENSOR) + CLASSES + "select id, seq, window_end, late_class from classes"
)
def late_classify(spark, sf):
    return classified(spark, sf).select("id", "seq", "window_end", "late_class")


@register(
    "late_rows", with_(SENSOR) + CLASSES + "select id, seq, temperature from classes where late_class = 'late'"
)
def late_rows(spark, sf):
    return late.split_late(classified(spark, sf))[1].select("id", "seq", "temperature")


@register(
    "allowed_lateness_upserts",
    with_(SENSOR)
    + CLASSES
    + """select id, window_end, temperature, seq, "timestamp" from classes where late_class <> 'late'
    qualify row_number() over (partition by id, window_end order by temperature, seq) = 1""",
)
def allowed_lateness(spark, sf):
    best = late.min_by_with_lateness(classified(spark, sf), "id", "temperature", "seq")
    return best.select("id", "window_end", "temperature", "seq", "timestamp")


@register(
    "side_output_split",
    with_(SENSOR)
    + """select id, seq, temperature, case when temperature > 30 then 'high' else 'low' end as route
    from sensor""",
)
def side_output_split(spark, sf):
    rows = tables.sensor(spark, sf).select("id", "seq", "temperature")
    return late.side_output_split(rows, "temperature", 30.0)


@register(
    "keyed_running_count",
    with_(SENSOR)
    + """select id, seq, count(*) over (partition by id order by seq rows unbounded preceding) as n
    from sensor""",
)
def keyed_running_count(spark, sf):
    rows = tables.sensor(spark, sf).select("id", "seq")
    return rolling.keyed_running_count(rows, ["id"], ["seq"], SEQ_BLOCKS)


STATE_KINDS_SQL = with_(SENSOR) + f"""
select id, seq, kind,
  count(*) over (partition by id order by seq rows unbounded preceding) as n,
  {rounded_sql('sum(temperature) over (partition by id, kind order by seq rows unbounded preceding)')}
    as kind_sum,
  max(temperature) over (partition by id order by seq rows unbounded preceding) as max_temp,
  string_agg(cast(seq as varchar), ',') over (partition by id order by seq
    rows between 2 preceding and current row) as last_seqs
from sensor"""


@register("keyed_state_kinds", STATE_KINDS_SQL)
def keyed_state_kinds(spark, sf):
    """Count (value state), last three (list state), sum per kind (map state), maximum (reducing)."""
    rows = tables.sensor(spark, sf).select("id", "seq", "kind", "temperature")
    per_id = running(
        rows, ["id"], ["seq"], SEQ_BLOCKS,
        {"n": running_count(), "max_temp": running_max(F.col("temperature"))},
    )
    per_kind = running(
        stored(per_id, "kinds"), ["id", "kind"], ["seq"], SEQ_BLOCKS, {"kind_sum": running_sum(F.col("temperature"))}
    )
    out = rolling.last_n_text(stored(per_kind, "kinds"), "id", "seq", SEQ_BLOCKS, 3, F.col("seq").cast("string"), "last_seqs")
    return out.select("id", "seq", "kind", "n", rounded("kind_sum").alias("kind_sum"), "max_temp", "last_seqs")


@register(
    "reducing_state",
    with_(SENSOR)
    + """select id, seq, max(temperature) over (partition by id order by seq rows unbounded preceding)
      as max_temp from sensor""",
)
def reducing_state(spark, sf):
    rows = tables.sensor(spark, sf).select("id", "seq", "temperature")
    out = running(rows, ["id"], ["seq"], SEQ_BLOCKS, {"max_temp": running_max(F.col("temperature"))})
    return out.select("id", "seq", "max_temp")


JUMP_SQL = with_(SENSOR) + """, steps as (
  select id, seq, lag(temperature) over (partition by id order by seq) as last_temp,
    temperature as cur_temp from sensor)
select * from steps where abs(cur_temp - last_temp) >= 10"""


@register("temp_jump_alert", JUMP_SQL)
def temp_jump_alert(spark, sf):
    return alerts.temp_jump_alert(tables.sensor(spark, sf), "id", "temperature", "seq", SEQ_BLOCKS, 10.0)


SHARDS = 4
SUBTASK_SQL = with_(SENSOR) + """
select cast(seq % 4 as int) as shard, seq,
  row_number() over (partition by seq % 4 order by seq) - 1 as n from sensor"""


@register("subtask_counter", SUBTASK_SQL)
def subtask_counter(spark, sf):
    rows = tables.sensor(spark, sf).select((F.col("seq") % SHARDS).cast("int").alias("shard"), "seq")
    counted = rolling.keyed_running_count(rows, ["shard"], ["seq"], SEQ_BLOCKS)
    return counted.withColumn("n", F.col("n") - 1)


@register(
    "process_element_timers",
    with_(SENSOR)
    + """, actions as (
      select id, seq, ("timestamp" + 10) * 1000 as fire_ms, 1 as live from sensor
      union all select id, seq, ("timestamp" + 100) * 1000, 0 from sensor)
    select id, fire_ms from (select * from actions
      qualify row_number() over (partition by id, fire_ms order by seq desc) = 1) where live = 1""",
)
def process_element_timers(spark, sf):
    return alerts.timer_set(tables.sensor(spark, sf), "id", "timestamp", "seq", 10, 100)


RUNS = """, steps as (
  select id, seq, "timestamp" as ts, temperature as v,
    lag(temperature) over (partition by id order by seq) as last from sensor),
runs as (
  select *, sum(case when v < last then 1 else 0 end) over (partition by id order by seq
    rows unbounded preceding) as run from steps),
spans as (
  select id, run, min(ts) as opened, min(case when v > last then ts end) as start
  from runs group by id, run),
ends as (
  select *, lead(opened) over (partition by id order by run) as fall from spans)"""


@register(
    "rising_temp_alert",
    with_(SENSOR)
    + RUNS
    + """select id, start, start + 600 as fire from ends
    where start is not null and (fall is null or fall > start + 600)""",
)
def rising_temp_alert(spark, sf):
    """The first alert of each run, ten minutes after its first rise."""
    return alerts.rising_alert_first(
        tables.sensor(spark, sf), "id", "temperature", "timestamp", "seq", SEQ_BLOCKS, 600
    )


@register(
    "rising_temp_alert_repeated",
    with_(SENSOR).replace("with ", "with recursive ", 1)
    + RUNS
    + """, chain as (
      select id, run, start from spans where start is not null
      union all
      select c.id, c.run, min(r.ts) from chain c join runs r using (id, run)
      where r.v > r.last and r.ts > c.start + 18000 group by c.id, c.run)
    select c.id, c.start, c.start + 18000 as fire from chain c join ends e using (id, run)
    where e.fall is null or e.fall > c.start + 18000""",
)
def rising_temp_alert_repeated(spark, sf):
    """All alerts, five hours after a rise."""
    return alerts.rising_alerts(
        tables.sensor(spark, sf), "id", "temperature", "timestamp", "seq", SEQ_BLOCKS, 18_000
    )
