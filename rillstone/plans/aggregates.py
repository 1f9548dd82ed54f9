"""Grouped and running aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions.extensions import Accumulator, aggregate_by_key, average_from_parts, reduce_by_key
from rillstone.operators import rolling, topn, words
from rillstone.operators.blocks import Blocks
from rillstone.plans.catalog import BEHAVIOR, SENSOR, WORDS, register, rounded, rounded_sql, with_
from rillstone.sources import tables
from rillstone.sources.tables import SEQ_BLOCKS

# A document holds at most some thousands of words, which bounds a block of any one word. Few words are frequent
# enough to be cut; all others need no summaries.
DOC_BLOCKS = Blocks("doc_id", 10_000, heavy_rows=1_000_000)


@register("word_count", with_(WORDS) + "select word, count(*) as cnt from words group by word")
def word_count(spark, sf):
    return words.word_count(tables.table(spark, sf, "documents"), "text")


@register(
    "stream_word_count_history",
    with_(WORDS)
    + """select doc_id, cast(pos as int) as pos, word,
      count(*) over (partition by word order by doc_id, pos rows unbounded preceding) as cnt from words""",
)
def word_count_history(spark, sf):
    return words.word_count_history(tables.table(spark, sf, "documents"), "text", "doc_id", DOC_BLOCKS)


@register("reduce_sum", with_(WORDS) + "select word, cast(sum(1) as bigint) as total from words group by word")
def reduce_sum(spark, sf):
    ones = words.flat_map_split(tables.table(spark, sf, "documents"), "text")
    return ones.groupBy("word").agg(F.sum(F.lit(1)).alias("total"))


AVG_COUNT_SQL = with_(SENSOR) + (
    f"select id, {rounded_sql('avg(temperature)')} as avg_temp, count(id) as cnt from sensor group by id"
)


@register("group_avg_count", AVG_COUNT_SQL)
def group_avg_count(spark, sf):
    grouped = tables.sensor(spark, sf).groupBy("id")
    return grouped.agg(rounded(F.avg("temperature")).alias("avg_temp"), F.count("id").alias("cnt"))


AVG_SQL = with_(SENSOR) + (
    f"select id, {rounded_sql('avg(temperature)')} as avg_temp from sensor {{}} group by id"
)


@register("group_avg", AVG_SQL.format(""))
def group_avg(spark, sf):
    return tables.sensor(spark, sf).groupBy("id").agg(rounded(F.avg("temperature")).alias("avg_temp"))


@register("filter_group_avg", AVG_SQL.format("where id <> 'sensor_1'"))
def filter_group_avg(spark, sf):
    kept = tables.sensor(spark, sf).where(F.col("id") != "sensor_1")
    return kept.groupBy("id").agg(rounded(F.avg("temperature")).alias("avg_temp"))


def readings(spark, sf):
    return tables.sensor(spark, sf).select("id", "timestamp", "temperature", "seq")


ROLLING_SQL = with_(SENSOR) + """
select id, {} as "timestamp", max(temperature) over w as temperature, seq
from sensor window w as (partition by id order by seq rows unbounded preceding)"""


@register("rolling_max", ROLLING_SQL.format('first_value("timestamp") over w'))
def rolling_max(spark, sf):
    return rolling.rolling_max(readings(spark, sf), "id", "temperature", "seq", SEQ_BLOCKS, ["timestamp"])


@register(
    "rolling_max_by",
    with_(SENSOR)
    + """, best as (
      select id, seq, max(temperature) over w as temperature
      from sensor window w as (partition by id order by seq rows unbounded preceding)),
    firsts as (
      select id, temperature, min(seq) as best_seq from sensor group by id, temperature)
    select b.id, b.seq, b.temperature, f.best_seq, s."timestamp"
    from best b join firsts f using (id, temperature) join sensor s on s.seq = f.best_seq""",
)
def rolling_max_by(spark, sf):
    return rolling.rolling_max_by(readings(spark, sf), "id", "temperature", "seq", SEQ_BLOCKS)


@register("rolling_reduce_keep_first_ts", ROLLING_SQL.format('first_value("timestamp") over w'))
def rolling_keep_first(spark, sf):
    return rolling.rolling_max(readings(spark, sf), "id", "temperature", "seq", SEQ_BLOCKS, ["timestamp"])


@register("rolling_reduce_keep_last_ts", ROLLING_SQL.format('"timestamp"'))
def rolling_keep_last(spark, sf):
    return rolling.rolling_max_keep_last(readings(spark, sf), "id", "temperature", "seq", SEQ_BLOCKS)


@register(
    "incremental_count_agg", with_(BEHAVIOR) + 'select "itemId", count(*) as cnt from behavior group by 1'
)
def incremental_count(spark, sf):
    return tables.user_behavior(spark, sf).groupBy("itemId").agg(F.count(F.lit(1)).alias("cnt"))


@register("udaf_avg", AVG_SQL.format(""))
def udaf_avg(spark, sf):
    grouped = tables.sensor(spark, sf).groupBy("id")
    return grouped.agg(rounded(average_from_parts(F.col("temperature"))).alias("avg_temp"))


@register(
    "udtaf_top2",
    with_(SENSOR)
    + """select id, temperature as temp, cast(row_number() over (partition by id
      order by temperature desc, seq) as int) as temp_rank from sensor qualify temp_rank <= 2""",
)
def udtaf_top2(spark, sf):
    rows = tables.sensor(spark, sf).select("id", "temperature", "seq")
    ranked = topn.top_n(rows, ["id"], [F.desc("temperature"), F.asc("seq")], 2, "temp_rank")
    return ranked.select("id", F.col("temperature").alias("temp"), "temp_rank")


@register(
    "udtaf_top2_compat",
    with_(SENSOR)
    + """, steps as (
      select id, temperature, coalesce(max(temperature) over (partition by id order by seq
        rows between unbounded preceding and 1 preceding), 4.9e-324) as prev from sensor)
    select id, greatest(4.9e-324, max(temperature)) as temp, cast(1 as int) as temp_rank
    from steps group by id
    union all
    select id, greatest(4.9e-324, coalesce(max(temperature) filter (temperature <= greatest(4.9e-324, prev)),
      4.9e-324)), 2 from steps group by id""",
)
def udtaf_top2_compat(spark, sf):
    rows = tables.sensor(spark, sf).select("id", "temperature", "seq")
    return topn.top_n_compat(rows, "id", "temperature", "seq", SEQ_BLOCKS)


@register(
    "reduce_function_surface",
    with_(SENSOR) + "select id, max(temperature) as temperature from sensor group by id",
)
def reduce_function(spark, sf):
    rows = tables.sensor(spark, sf)
    return reduce_by_key(rows, "id", "temperature", max, "temperature")


class AverageParts(Accumulator):
    """Sum and count, merged, divided at the end."""

    buffer = "total double, n bigint"
    returns = "double"

    def create(self):
        return (0.0, 0)

    def add(self, acc, value):
        return acc if value is None else (acc[0] + value, acc[1] + 1)

    def merge(self, a, b):
        return (a[0] + b[0], a[1] + b[1])

    def result(self, acc):
        return acc[0] / acc[1] if acc[1] else None


@register("aggregate_function_surface", AVG_SQL.format(""))
def aggregate_function(spark, sf):
    out = aggregate_by_key(tables.sensor(spark, sf), "id", "temperature", AverageParts(), "avg_temp")
    return out.select("id", rounded("avg_temp").alias("avg_temp"))
