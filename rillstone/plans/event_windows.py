"""Group windows, row-frame windows, ranking and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import rolling, topn, windows
from rillstone.plans.catalog import BEHAVIOR, HOPS, SENSOR, register, rounded, rounded_sql, with_
from rillstone.plans.scalars import hot_counts
from rillstone.sources import tables, text
from rillstone.sources.tables import SEQ_BLOCKS

HOUR_MS = 3_600_000


def timed(spark, sf):
    rows = tables.sensor(spark, sf).select("id", "timestamp", "temperature", "seq")
    return rows.withColumn("rt", F.timestamp_seconds("timestamp"))


def end_sql(size_s: int, seconds: str = '"timestamp"') -> str:
    return f"cast((floor({seconds} / {size_s}) * {size_s} + {size_s}) * 1000 as bigint)"


def tumble_sql(size_s: int) -> str:
    return with_(SENSOR) + (
        f"select id, {end_sql(size_s)} as window_end, count(id) as cnt, "
        f"{rounded_sql('avg(temperature)')} as avg_temp from sensor group by 1, 2"
    )


def tumble(spark, sf, size_ms):
    rows = timed(spark, sf)
    return windows.tumble_agg(
        rows, "id", "rt", size_ms,
        F.count("id").alias("cnt"), rounded(F.avg("temperature")).alias("avg_temp"),
    )


@register("tumble_event_agg", tumble_sql(10))
def tumble_10s(spark, sf):
    return tumble(spark, sf, 10_000)


@register("tumble_event_agg_1h", tumble_sql(3600))
def tumble_1h(spark, sf):
    return tumble(spark, sf, HOUR_MS)


@register("tumble_event_agg_sql", tumble_sql(10))
def tumble_in_sql(spark, sf):
    text.as_view(timed(spark, sf), "sensor_timed")
    return spark.sql(
        """select id, unix_millis(w.end) as window_end, count(id) as cnt,
             round(avg(temperature) + 1e-9D, 6) as avg_temp
           from (select *, window(rt, '10 seconds') as w from sensor_timed)
           group by id, w"""
    )


def min_by_sql(end: str) -> str:
    return with_(SENSOR) + (
        f'select id, window_end, "timestamp", temperature, seq from (select *, {end} as window_end from sensor) '
        "qualify row_number() over (partition by id, window_end order by temperature, seq) = 1"
    )


def min_by(spark, sf, size_ms):
    return windows.tumble_min_by(timed(spark, sf), "id", "rt", size_ms, "temperature", "seq")


@register("tumble_event_min_by", min_by_sql(end_sql(15)))
def min_by_15s(spark, sf):
    return min_by(spark, sf, 15_000)


@register("tumble_event_min_by_1h", min_by_sql(end_sql(3600)))
def min_by_1h(spark, sf):
    return min_by(spark, sf, HOUR_MS)


@register("tumble_event_min_by_20ms", min_by_sql('"timestamp" * 1000 + 20'))
def min_by_20ms(spark, sf):
    return min_by(spark, sf, 20)


@register(
    "tumble_proc_min_by",
    with_(SENSOR)
    + """select id, (arrival_ms // 10) * 10 + 10 as window_end, min(temperature) as temperature
    from sensor group by 1, 2""",
)
def tumble_proc_min_by(spark, sf):
    rows = tables.sensor(spark, sf).withColumn("ingest_ts", F.timestamp_millis("arrival_ms"))
    return windows.tumble_agg(rows, "id", "ingest_ts", 10, F.min("temperature").alias("temperature"))


HOP_SQL = with_(BEHAVIOR, HOPS) + 'select "itemId", window_end, cnt from hop_counts'


@register("hop_count", HOP_SQL)
def hop_count(spark, sf):
    """Every record is counted once, in its pane; the windows are made of pane counts."""
    return hot_counts(spark, sf)


@register("hop_count_panes", HOP_SQL)
def hop_count_panes(spark, sf):
    return hot_counts(spark, sf)


@register(
    "window_aux",
    with_(SENSOR)
    + f"select id, seq, {end_sql(10)} - 10000 as start_ms, {end_sql(10)} as end_ms, "
    f"{end_sql(10)} - 1 as last_ms from sensor",
)
def window_aux(spark, sf):
    w = timed(spark, sf).select("id", "seq", F.window("rt", "10 seconds").alias("w"))
    return w.select(
        "id",
        "seq",
        F.unix_millis("w.start").alias("start_ms"),
        F.unix_millis("w.end").alias("end_ms"),
        F.unix_millis(F.window_time("w")).alias("last_ms"),
    )


@register("window_enrich", HOP_SQL)
def window_enrich(spark, sf):
    return hot_counts(spark, sf).select("itemId", "window_end", "cnt")


TOP_SQL = with_(BEHAVIOR, HOPS) + (
    'select "itemId", window_end, cnt, cast(row_num as int) as row_num from ranked where row_num <= 5'
)


@register("hot_items_topn", TOP_SQL)
def hot_items_topn(spark, sf):
    return topn.hot_items(hot_counts(spark, sf), 5)


@register("hot_items_sql", TOP_SQL)
def hot_items_sql(spark, sf):
    """Ranking in SQL over a view of the window counts."""
    hot_counts(spark, sf).createOrReplaceTempView("window_counts")
    return spark.sql(
        """
        with placed as (
          select itemId, cnt, window_end,
                 row_number() over (partition by window_end order by cnt desc, itemId) as row_num
          from window_counts)
        select itemId, cnt, window_end, row_num from placed where row_num <= 5"""
    )


@register("hot_items_pure_sql", TOP_SQL)
def hot_items_pure_sql(spark, sf):
    """The whole query in SQL: panes are counted first, and windows over panes sum the counts."""
    rows = tables.user_behavior(spark, sf).withColumn("ts", F.timestamp_seconds("timestamp"))
    rows.createOrReplaceTempView("behaviors")
    return spark.sql(
        """
        with panes as (
          select itemId, window(ts, '5 minutes') as pane, count(itemId) as views
          from behaviors where behavior = 'pv' group by itemId, window(ts, '5 minutes')),
        hours as (
          select itemId, window(window_time(pane), '1 hour', '5 minutes') as hour, sum(views) as cnt
          from panes group by itemId, window(window_time(pane), '1 hour', '5 minutes')),
        placed as (
          select itemId, cnt, unix_millis(hour.end) as window_end,
                 row_number() over (partition by hour order by cnt desc, itemId) as row_num
          from hours)
        select itemId, cnt, window_end, row_num from placed where row_num <= 5"""
    )


OVER_SQL = with_(SENSOR) + (
    f"""select id, seq, "timestamp" * 1000 as rt_ms, count(id) over ow as cnt,
      {rounded_sql('avg(temperature) over ow')} as avg_temp from sensor
      window ow as (partition by id order by "timestamp", seq rows between 2 preceding and current row)"""
)


@register("over_rows_agg", OVER_SQL)
def over_rows_agg(spark, sf):
    # by event time; `seq` breaks ties
    rows = tables.sensor(spark, sf).select("id", "timestamp", "temperature", "seq")
    out = rolling.over_rows(rows, "id", ["timestamp", "seq"], tables.time_blocks(rows), 2, "id", "temperature")
    return out.select(
        "id", "seq", (F.col("timestamp") * 1000).alias("rt_ms"), "cnt", rounded("avg_temp").alias("avg_temp")
    )


@register("limit_rows", "select * from customer order by c_custkey limit 10")
def limit_rows(spark, sf):
    return topn.limit_rows(tables.table(spark, sf, "customer"), ["c_custkey"], 10)


@register("page_rows", "select * from orders order by o_orderkey limit 25 offset 50")
def page_rows(spark, sf):
    return topn.page_rows(tables.table(spark, sf, "orders"), ["o_orderkey"], 3, 25)


@register("page_rows_tied", "select * from orders order by o_custkey, o_orderkey limit 40 offset 80")
def page_rows_tied(spark, sf):
    """Paging by a column with ties, and the one that breaks them."""
    return topn.page_rows(tables.table(spark, sf, "orders"), ["o_custkey", "o_orderkey"], 3, 40)


@register(
    "sort_desc_by_count",
    with_(BEHAVIOR) + """select "itemId", count(*) as cnt from behavior group by 1 order by cnt desc, 1""",
)
def sort_desc_by_count(spark, sf):
    counts = tables.user_behavior(spark, sf).groupBy("itemId").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "itemId")
