"""End-to-end jobs: from raw lines to the outputs a user of the pipelines reads.

Each job function takes its input and returns its outputs by name; the catalogue entries
union them into one checked result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions.strings import java_hash
from rillstone.operators import alerts, changelog, late, rolling, topn, windows, words
from rillstone.operators.blocks import Blocks
from rillstone.plans.catalog import BEHAVIOR, HOPS, MAIL, SENSOR, WORDS, register, rounded, rounded_sql, with_
from rillstone.plans.event_windows import end_sql
from rillstone.plans.lateral import HASHED
from rillstone.plans.stateful import CLASSES, RUNS
from rillstone.schemas import CUSTOMER, SENSOR as SENSOR_SCHEMA
from rillstone.sinks.formats import csv_value, rename_for_sink
from rillstone.sources import connectors, tables, text
from rillstone.sources.tables import SEQ_BLOCKS
from rillstone.session import shared_dir
from rillstone.sinks.writers import BatchWriter, read_batches, table_batch
from rillstone.streaming.runner import open_replay, run_batches


def word_count_job(lines: DataFrame) -> DataFrame:
    return words.word_count(lines, "value")


@register("job_word_count", with_(WORDS) + "select word, count(*) as cnt from words group by word")
def job_word_count(spark, sf):
    return word_count_job(tables.lines(spark, sf))


def sensor_table_job(readings: DataFrame, sensor_id: str) -> dict[str, DataFrame]:
    """One sensor's readings, and the changing averages of all others with their final state."""
    text.as_view(readings, "job_sensor")
    spark = readings.sparkSession
    one = spark.sql(
        "select id, temperature from job_sensor where id = :id", args={"id": sensor_id}
    )
    others = readings.where(F.col("id") != sensor_id)
    changes = changelog.retract_changelog(others, "id", "temperature", "seq", SEQ_BLOCKS)
    return {"one": one, "changes": changes, "averages": changelog.fold_changelog(changes, "id", "seq")}


@register(
    "job_sensor_table",
    with_(SENSOR)
    + f"""select 'one' as part, id, {rounded_sql('temperature')} as val, cast(1 as bigint) as cnt
      from sensor where id = 'sensor_1'
    union all select 'averages', id, {rounded_sql('avg(temperature)')}, count(id) from sensor
      where id <> 'sensor_1' group by id""",
)
def job_sensor_table(spark, sf):
    out = sensor_table_job(tables.sensor(spark, sf), "sensor_1")
    one = out["one"].select(F.lit("one").alias("part"), "id", rounded("temperature").alias("val"),
                            F.lit(1).cast("bigint").alias("cnt"))
    return one.unionByName(
        out["averages"].select(F.lit("averages").alias("part"), "id", rounded("avg_temp").alias("val"), "cnt")
    )


def sensor_windows_job(readings: DataFrame) -> dict[str, DataFrame]:
    timed = readings.withColumn("rt", F.timestamp_seconds("timestamp"))
    tumble = windows.tumble_agg(
        timed, "id", "rt", 10_000, F.count("id").alias("cnt"), F.avg("temperature").alias("avg_temp")
    )
    over = rolling.over_rows(readings, "id", ["timestamp", "seq"], tables.time_blocks(readings), 2, "id", "temperature")
    return {"tumble": tumble, "over": over}


@register(
    "job_sensor_windows",
    with_(SENSOR)
    + f"""select 'tumble' as part, id, {end_sql(10)} as at_ms, count(id) as cnt,
      {rounded_sql('avg(temperature)')} as avg_temp from sensor group by 1, 2, 3
    union all select 'over', id, "timestamp" * 1000, count(id) over ow,
      {rounded_sql('avg(temperature) over ow')} from sensor
      window ow as (partition by id order by "timestamp", seq rows between 2 preceding and current row)""",
)
def job_sensor_windows(spark, sf):
    out = sensor_windows_job(tables.sensor(spark, sf))
    tumble = out["tumble"].select(F.lit("tumble").alias("part"), "id", F.col("window_end").alias("at_ms"),
                                  "cnt", rounded("avg_temp").alias("avg_temp"))
    over = out["over"].select(F.lit("over").alias("part"), "id", (F.col("timestamp") * 1000).alias("at_ms"),
                              "cnt", rounded("avg_temp").alias("avg_temp"))
    return tumble.unionByName(over)


def sensor_functions_job(readings: DataFrame) -> dict[str, DataFrame]:
    ranked = topn.top_n(readings, ["id"], [F.desc("temperature"), F.asc("seq")], 2, "temp_rank")
    return {
        "hash": readings.select("id", java_hash(F.col("id")).alias("hash")),
        "words": words.lateral_split(readings, "id", "_", ["id"]),
        "avg": readings.groupBy("id").agg(F.avg("temperature").alias("temp_avg")),
        "top": ranked.select("id", F.col("temperature").alias("temp"), "temp_rank"),
    }


@register(
    "job_sensor_functions",
    HASHED
    + f"""select 'hash' as part, id, '' as word, cast(hash as double) as val from hashes
    union all select 'words', id, word, length(word) from
      (select id, unnest(string_split(id, '_')) as word from sensor)
    union all select 'avg', id, '', {rounded_sql('avg(temperature)')} from sensor group by id
    union all select 'top', id, cast(r as varchar), temperature from (
      select *, row_number() over (partition by id order by temperature desc, seq) as r from sensor)
      where r <= 2""",
)
def job_sensor_functions(spark, sf):
    out = sensor_functions_job(tables.sensor(spark, sf))

    def rows(part, word, val):
        return out[part].select(F.lit(part).alias("part"), "id", word.alias("word"),
                                val.cast("double").alias("val"))

    none = F.lit("")
    return (
        rows("hash", none, F.col("hash"))
        .unionByName(rows("words", F.col("word"), F.col("length")))
        .unionByName(rows("avg", none, rounded("temp_avg")))
        .unionByName(rows("top", F.col("temp_rank").cast("string"), F.col("temp")))
    )


def sensor_alerts_job(readings: DataFrame, threshold: float, interval: int, split_at: float
                      ) -> dict[str, DataFrame]:
    return {
        "jump": alerts.temp_jump_alert(readings, "id", "temperature", "seq", SEQ_BLOCKS, threshold),
        "rising": alerts.rising_alert_first(
            readings, "id", "temperature", "timestamp", "seq", SEQ_BLOCKS, interval
        ),
        "routes": late.side_output_split(readings, "temperature", split_at),
    }


@register(
    "job_sensor_alerts",
    with_(SENSOR)
    + RUNS
    + """select 'jump' as part, id, count(*) as n from steps where abs(v - last) >= 10 group by id
    union all select 'rising', id, count(*) from ends
      where start is not null and (fall is null or fall > start + 600) group by id
    union all select case when temperature > 30 then 'high' else 'low' end, id, count(*)
      from sensor group by 1, 2""",
)
def job_sensor_alerts(spark, sf):
    out = sensor_alerts_job(tables.sensor(spark, sf), 10.0, 600, 30.0)

    def counted(df, part):
        return df.groupBy(part.alias("part"), "id").agg(F.count(F.lit(1)).alias("n"))

    jumps = counted(out["jump"], F.lit("jump"))
    rises = counted(out["rising"], F.lit("rising"))
    return jumps.unionByName(rises).unionByName(counted(out["routes"], F.col("route")))


def sensor_late_job(readings: DataFrame, blocks: Blocks) -> dict[str, DataFrame]:
    """Window minima with allowed lateness, and the rows that came too late."""
    classes = late.late_classify(
        readings, F.col("timestamp") * 1000, ["arrival_ms", "seq"], blocks, 15_000, 20, 60_000
    )
    return {
        "minima": late.min_by_with_lateness(classes, "id", "temperature", "seq"),
        "late": late.split_late(classes)[1],
    }


@register(
    "job_sensor_late",
    with_(SENSOR)
    + CLASSES
    + """select 'minima' as part, id, window_end, temperature, seq from classes where late_class <> 'late'
    qualify row_number() over (partition by id, window_end order by temperature, seq) = 1
    union all select 'late', id, window_end, temperature, seq from classes where late_class = 'late'""",
)
def job_sensor_late(spark, sf):
    readings = tables.sensor(spark, sf)
    out = sensor_late_job(readings, Blocks.fit(readings, "arrival_ms"))
    columns = ["id", "window_end", "temperature", "seq"]
    minima = out["minima"].select(F.lit("minima").alias("part"), *columns)
    return minima.unionByName(out["late"].select(F.lit("late").alias("part"), *columns))


def csv_route_job(topic: DataFrame, sensor_id: str) -> DataFrame:
    """CSV records of one sensor, passed on as CSV records."""
    rows = connectors.csv_values(topic, SENSOR_SCHEMA)
    return csv_value(rows.where(F.col("id") == sensor_id))


@register(
    "job_kafka_csv_route",
    with_(SENSOR)
    + """select id || ',' || cast("timestamp" as varchar) || ',' || cast(temperature as varchar) as value
    from sensor where id = 'sensor_1'""",
)
def job_kafka_csv_route(spark, sf):
    return csv_route_job(tables.sensor_lines(spark, sf), "sensor_1")


def hot_items_job(lines: DataFrame, n: int = 5, shift_hours: int = 0) -> DataFrame:
    """Click-stream lines to one ranking text per window."""
    rows = text.parse_user_behavior_csv(lines, shift_hours)
    timed = rows.withColumn("ts", F.timestamp_seconds("timestamp"))
    counts = windows.hop_count(timed, "itemId", "ts", 3_600_000, 300_000, F.col("behavior") == "pv")
    return topn.format_report(topn.hot_items(counts, n))


@register(
    "job_hot_items",
    with_(BEHAVIOR, HOPS)
    + """select window_end, '=====================' || chr(10) || '窗口结束时间: '
      || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
      || string_agg('No ' || row_num || ': 商品ID= ' || "itemId" || ' 热门度= ' || cnt,
                    chr(10) order by row_num)
      || chr(10) || '===============================' || chr(10) as report
    from ranked where row_num <= 5 group by window_end""",
)
def job_hot_items(spark, sf):
    return hot_items_job(tables.user_behavior_lines(spark, sf))


@register(
    "job_mail_ingest",
    with_(MAIL)
    + """select "appKey" as app_key, "appVersion" as app_version, "deviceId" as device_id,
    "phoneNo" as phone_no from mail""",
)
def job_mail_ingest(spark, sf):
    """A stream of JSON records into a table, one idempotent write per batch."""
    home = shared_dir(spark, "mail")
    for part in tables.in_parts(tables.table(spark, sf, "customer"), F.col("c_custkey"), MAIL_PARTS):
        part.write.mode("append").parquet(f"{home}/customer")
        mail = text.json_to_mail(tables.mail_json_from(open_replay(spark, f"{home}/customer", CUSTOMER)))
        run_batches(rename_for_sink(mail), table_batch(f"{home}/out"), f"{home}/checkpoint")
    return read_batches(spark, f"{home}/out", MAIL_COLUMNS).drop("batch_id")


# The customers arrive in so many micro-batches.
MAIL_PARTS = 3
MAIL_COLUMNS = "app_key string, app_version string, device_id string, phone_no string"


def mail_quarantine_batch(good: BatchWriter, bad: BatchWriter) -> BatchWriter:
    """Records that are JSON objects to one writer, all other lines to the other."""

    def write(batch: DataFrame, batch_id: int) -> None:
        mail, lines = text.split_bad_json(batch)
        good(rename_for_sink(mail), batch_id)
        bad(lines, batch_id)

    return write


@register(
    "job_mail_quarantine",
    with_(MAIL)
    + """select 'good' as part, "phoneNo" as phone_no, null as line from mail
    where cast("phoneNo" as bigint) % 7 <> 0
    union all select 'bad', null, '{bad ' || "phoneNo" from mail where cast("phoneNo" as bigint) % 7 = 0""",
)
def job_mail_quarantine(spark, sf):
    """The ingest job with every seventh record malformed."""
    home = shared_dir(spark, "mail")
    write = mail_quarantine_batch(table_batch(f"{home}/good"), table_batch(f"{home}/bad"))
    for part in tables.in_parts(tables.table(spark, sf, "customer"), F.col("c_custkey"), MAIL_PARTS):
        part.write.mode("append").parquet(f"{home}/customer")
        customers = open_replay(spark, f"{home}/customer", CUSTOMER)
        sound = tables.mail_json_from(customers.where("c_custkey % 7 <> 0"))
        broken = customers.where("c_custkey % 7 = 0").select(F.concat(F.lit("{bad "), "c_custkey").alias("value"))
        run_batches(sound.unionByName(broken), write, f"{home}/checkpoint")
    good = read_batches(spark, f"{home}/good", MAIL_COLUMNS)
    bad = read_batches(spark, f"{home}/bad", "line string")
    none = F.lit(None).cast("string")
    return good.select(F.lit("good").alias("part"), "phone_no", none.alias("line")).unionByName(
        bad.select(F.lit("bad").alias("part"), none.alias("phone_no"), "line")
    )
