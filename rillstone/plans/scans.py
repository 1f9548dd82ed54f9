"""Sources, views, sinks' row formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators.changelog import retract_changelog
from rillstone.plans.catalog import BEHAVIOR, MAIL, SENSOR, register, rounded, rounded_sql, with_
from rillstone.schemas import SENSOR as SENSOR_SCHEMA
from rillstone.session import shared_dir
from rillstone.sinks.formats import csv_value, rename_for_sink
from rillstone.sources import connectors, tables, text


@register(
    "scan_text",
    with_(BEHAVIOR)
    + """select "userId" || ',' || "itemId" || ',' || "categoryId" || ',' || behavior || ',' || "timestamp"
      as value from behavior""",
)
def scan_text(spark, sf):
    """The click-stream written as a text file set and scanned."""
    path = shared_dir(spark, "lines")
    tables.user_behavior_lines(spark, sf).write.text(path)
    return text.scan_text(spark, path)


@register("scan_csv_table", with_(SENSOR) + 'select id, "timestamp", temperature from sensor')
def scan_csv_table(spark, sf):
    path = shared_dir(spark, "csv")
    tables.sensor(spark, sf).select("id", "timestamp", "temperature").write.csv(path)
    text.scan_csv_table(spark, path, "input_table")
    return spark.sql("select * from input_table")


@register("parse_sensor_csv", with_(SENSOR) + 'select id, "timestamp", temperature from sensor')
def parse_sensor_csv(spark, sf):
    return text.parse_sensor_csv(tables.sensor_lines(spark, sf))


@register(
    "parse_sensor_quarantine",
    with_(SENSOR, MAIL)
    + """select false as good, null as id, null as ts, null as temperature,
    '{"appKey":"' || "appKey" || '","appVersion":"' || "appVersion" || '","deviceId":"' || "deviceId"
    || '","phoneNo":"' || "phoneNo" || '"}' as line from mail
    union all select true, id, cast("timestamp" as varchar), temperature, null from sensor""",
)
def parse_sensor_quarantine(spark, sf):
    mixed = tables.sensor_lines(spark, sf).unionAll(tables.mail_json(spark, sf))
    good, bad = text.split_bad_lines(mixed, SENSOR_SCHEMA)
    both = good.withColumn("good", F.lit(True)).unionByName(
        bad.withColumn("good", F.lit(False)), allowMissingColumns=True
    )
    return both.select("good", "id", F.col("timestamp").cast("string").alias("ts"), "temperature", "line")


@register("parse_user_behavior_csv", with_(BEHAVIOR) + "select * from behavior")
def parse_user_behavior_csv(spark, sf):
    return text.parse_user_behavior_csv(tables.user_behavior_lines(spark, sf))


@register(
    "shift_epoch_hours",
    with_(BEHAVIOR)
    + 'select "userId", "itemId", "categoryId", behavior, "timestamp" + 28800 as "timestamp" from behavior',
)
def shift_epoch_hours(spark, sf):
    return text.parse_user_behavior_csv(tables.user_behavior_lines(spark, sf), shift_hours=8)


@register(
    "scan_ddl_table",
    with_(SENSOR) + 'select id, temperature, "timestamp" * 1000 as ks_ms from sensor',
)
def scan_ddl_table(spark, sf):
    rows = text.with_computed_time(tables.sensor(spark, sf), "ks", "1 second")
    return rows.select("id", "temperature", F.unix_millis("ks").alias("ks_ms"))


@register(
    "scan_jdbc_preview",
    """with first as (
      select row_number() over (order by c_custkey) as row_no, * from customer
      order by c_custkey limit 10)
    select cast(row_no as int) as row_no, 'c_custkey' as "column", cast(c_custkey as varchar) as value from first
    union all select cast(row_no as int), 'c_name', c_name from first
    union all select cast(row_no as int), 'c_nationkey', cast(c_nationkey as varchar) from first
    union all select cast(row_no as int), 'c_acctbal', cast(c_acctbal as varchar) from first
    union all select cast(row_no as int), 'c_mktsegment', c_mktsegment from first""",
)
def scan_jdbc_preview(spark, sf):
    return connectors.preview(tables.table(spark, sf, "customer"), "c_custkey", 10)


@register("to_table", with_(SENSOR) + 'select id, "timestamp" as ts, temperature as temp from sensor')
def to_table(spark, sf):
    return tables.sensor(spark, sf).select(
        "id", F.col("timestamp").alias("ts"), F.col("temperature").alias("temp")
    )


@register("temp_view", with_(SENSOR) + 'select id, "timestamp", temperature from sensor')
def temp_view(spark, sf):
    view = text.as_view(tables.sensor(spark, sf).select("id", "timestamp", "temperature"), "sensor_view")
    return view.sparkSession.sql("select id, timestamp, temperature from sensor_view")


@register(
    "rowtime_attr",
    with_(SENSOR)
    + 'select id, "timestamp" as ts, temperature as temp, "timestamp" * 1000 as rt_ms from sensor',
)
def rowtime_attr(spark, sf):
    rows = tables.sensor(spark, sf).withColumn("rt", F.timestamp_seconds("timestamp"))
    return rows.select(
        "id",
        F.col("timestamp").alias("ts"),
        F.col("temperature").alias("temp"),
        F.unix_millis("rt").alias("rt_ms"),
    )


@register("proctime_attr", with_(SENSOR) + "select id, true as stamped from sensor")
def proctime_attr(spark, sf):
    stamped = tables.sensor(spark, sf).withColumn("pt", F.current_timestamp())
    return stamped.select("id", F.col("pt").isNotNull().alias("stamped"))


@register(
    "sink_kafka_table",
    with_(SENSOR)
    + """select id || ',' || cast("timestamp" as varchar) || ',' || cast(temperature as varchar) as value
    from sensor""",
)
def sink_kafka_table(spark, sf):
    return csv_value(tables.sensor(spark, sf).select("id", "timestamp", "temperature"))


@register(
    "rename_for_sink",
    with_(MAIL)
    + """select "appKey" as app_key, "appVersion" as app_version, "deviceId" as device_id,
    "phoneNo" as phone_no from mail""",
)
def rename(spark, sf):
    return rename_for_sink(text.json_to_mail(tables.mail_json(spark, sf)))


CHANGELOG_SQL = with_(SENSOR) + f"""
, run as (
  select id, seq, avg(temperature) over w as new_avg, count(*) over w as new_n
  from sensor window w as (partition by id order by seq rows unbounded preceding)),
pairs as (
  select *, lag(new_avg) over w as old_avg, lag(new_n) over w as old_n
  from run window w as (partition by id order by seq))
select id, seq, false as op, {rounded_sql('old_avg')} as avg_temp, old_n as cnt
from pairs where old_n is not null
union all
select id, seq, true, {rounded_sql('new_avg')}, new_n from pairs"""


@register("retract_changelog", CHANGELOG_SQL)
def changelog(spark, sf):
    changes = retract_changelog(tables.sensor(spark, sf), "id", "temperature", "seq", tables.SEQ_BLOCKS)
    return changes.withColumn("avg_temp", rounded("avg_temp"))
