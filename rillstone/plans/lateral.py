"""Lateral joins and user functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions import extensions
from rillstone.functions.extensions import register_sql_scalar, register_table_function
from rillstone.functions.strings import java_hash
from rillstone.operators.words import lateral_split
from rillstone.plans.aggregates import AverageParts
from rillstone.plans.catalog import SENSOR, register, rounded, rounded_sql, with_
from rillstone.sources import tables

HASHED = with_(SENSOR) + """, h as (
  select id, "timestamp" as ts, (list_reduce(
    list_transform(string_split(id, ''), lambda c: cast(unicode(c) as bigint)),
    lambda h, c: (h * 31 + c) % 4294967296) * 13) % 4294967296 as u from sensor)
, hashes as (
  select id, ts, cast(case when u >= 2147483648 then u - 4294967296 else u end as int) as hash from h)
"""


@register("udf_hash_code", HASHED + "select * from hashes")
def udf_hash_code(spark, sf):
    return tables.sensor(spark, sf).select(
        "id", F.col("timestamp").alias("ts"), java_hash(F.col("id")).alias("hash")
    )


@register("udf_surface", with_(SENSOR) + "select id, temperature * 9 / 5 + 32 as fahrenheit from sensor")
def udf_surface(spark, sf):
    register_sql_scalar(spark, "to_fahrenheit", "c double", "double", "c * 9 / 5 + 32")
    tables.sensor(spark, sf).createOrReplaceTempView("sensor_udf")
    return spark.sql("select id, to_fahrenheit(temperature) as fahrenheit from sensor_udf")


def parts_sql(source: str) -> str:
    return f"""
{source}, parts as (
  select id, ts, seq, unnest(string_split(id, '_')) as word,
    generate_subscripts(string_split(id, '_'), 1) as pos from src),
kept as (
  select * from parts
  qualify id = '' or pos <= max(case when word <> '' then pos else 0 end) over (partition by seq))"""


PLAIN = with_(SENSOR) + ', src as (select id, "timestamp" as ts, seq from sensor)'
# Sensors whose number ends in 7 get an id of separators only, which splits to no words.
BLANKED = with_(SENSOR) + (
    ", src as (select case when id like '%7' then '_' else id end as id, \"timestamp\" as ts, seq from sensor)"
)
INNER = "select id, ts, word, cast(length(word) as int) as length from kept"


def readings(spark, sf):
    return tables.sensor(spark, sf).select("id", F.col("timestamp").alias("ts"), "seq")


def blanked(spark, sf):
    rows = readings(spark, sf)
    return rows.withColumn("id", F.when(F.col("id").like("%7"), "_").otherwise(F.col("id")))


@register("udtf_split", parts_sql(PLAIN) + INNER)
def udtf_split(spark, sf):
    return lateral_split(readings(spark, sf), "id", "_", ["id", "ts"])


class SplitWords:
    """The splitting as a user table function."""

    def eval(self, value: str):
        parts = value.split("_")
        while len(parts) > 1 and parts[-1] == "":
            parts.pop()
        if parts != [""] or value == "":
            for part in parts:
                yield part, len(part)


@register("udtf_split_user", parts_sql(PLAIN) + INNER)
def udtf_split_user(spark, sf):
    register_table_function(spark, "split_words", SplitWords, "word string, length int")
    readings(spark, sf).createOrReplaceTempView("sensor_udtf")
    return spark.sql("select id, ts, word, length from sensor_udtf, lateral split_words(id)")


@register("lateral_inner", parts_sql(BLANKED) + INNER)
def lateral_inner(spark, sf):
    return lateral_split(blanked(spark, sf), "id", "_", ["id", "ts"])


@register(
    "lateral_left",
    parts_sql(BLANKED)
    + """select s.id, s.ts, k.word, coalesce(cast(length(k.word) as int), -1) as length
    from src s left join kept k using (seq)""",
)
def lateral_left(spark, sf):
    joined = lateral_split(blanked(spark, sf), "id", "_", ["id", "ts"], outer=True)
    return joined.withColumn("length", F.coalesce("length", F.lit(-1)))


@register(
    "udaf_surface",
    with_(SENSOR) + f"select id, {rounded_sql('avg(temperature)')} as avg_temp from sensor group by id",
)
def udaf_surface(spark, sf):
    """A user aggregate, called by its name in SQL, whose groups are folded in parts and merged."""
    extensions.register_two_level(spark, "user_avg", AverageParts())
    extensions.parted(tables.sensor(spark, sf)).createOrReplaceTempView("sensor_udaf")
    out = spark.sql(extensions.two_level_sql("user_avg", "id", "temperature", "sensor_udaf", "avg_temp"))
    return out.select("id", rounded("avg_temp").alias("avg_temp"))


class TopTwo(extensions.TableAccumulator):
    """The two highest values, a row each."""

    buffer = "first double, second double"
    returns = "temp double, temp_rank int"

    def create(self):
        return (None, None)

    def add(self, acc, value):
        return self.merge(acc, (value, None))

    def merge(self, a, b):
        best = sorted((v for v in (*a, *b) if v is not None), reverse=True)[:2]
        return (*best, None, None)[:2]

    def result(self, acc):
        return [(v, rank) for rank, v in enumerate(acc, 1) if v is not None]


@register(
    "table_aggregate_surface",
    with_(SENSOR)
    + """select id, temperature as temp, cast(r as int) as temp_rank from (
      select id, temperature, row_number() over (partition by id order by temperature desc, seq) as r from sensor)
    where r <= 2 and temperature is not null""",
)
def table_aggregate_surface(spark, sf):
    """A user aggregate that returns rows."""
    return extensions.table_aggregate_by_key(tables.sensor(spark, sf), "id", "temperature", TopTwo())
