"""Record adapters: sensor readings, click-streams, device JSON and text lines taken from
the analytics tables (`FIXTURES.md`)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions.timing import millis_of, seconds_of
from rillstone.operators.blocks import Blocks
from rillstone.schemas import TABLES

ARRIVAL_STRIDE = 7919
ARRIVAL_SPREAD_MS = 600_000

# `seq` numbers rows densely, so a width in `seq` is a bound on a block's rows.
SEQ_BLOCKS = Blocks("seq", 1_000_000, heavy_rows=1_000_000)


def time_blocks(rows: DataFrame) -> Blocks:
    """Blocks of event time for the keys that need them. Reads the time column once, at once."""
    return replace(Blocks.fit(rows, "timestamp"), heavy_rows=1_000_000)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, with its declared schema so that opening it runs no job."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def arrival_ms() -> Column:
    """When an event arrives, out of the order of the events' times."""
    return millis_of(F.col("ts")) + (F.col("event_id") * ARRIVAL_STRIDE) % ARRIVAL_SPREAD_MS


def sensor_from(events: DataFrame) -> DataFrame:
    """Sensor readings with arrival number `seq`, `kind`, and an out-of-order `arrival_ms`."""
    ts = F.col("ts")
    return events.select(
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        seconds_of(ts).alias("timestamp"),
        F.col("value").alias("temperature"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("kind"),
        arrival_ms().alias("arrival_ms"),
    )


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_from(table(spark, sf_dir, "events"))


def sensor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as `id,timestamp,temperature` text."""
    return sensor(spark, sf_dir).select(
        F.concat_ws(",", "id", F.col("timestamp").cast("string"), F.col("temperature").cast("string"))
        .alias("value")
    )


def user_behavior_from(events: DataFrame) -> DataFrame:
    item = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("user_id").alias("userId"),
        item.alias("itemId"),
        (item % 10).cast("int").alias("categoryId"),
        F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type")).alias("behavior"),
        seconds_of(F.col("ts")).alias("timestamp"),
    )


def user_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_behavior_from(table(spark, sf_dir, "events"))


def user_behavior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = user_behavior(spark, sf_dir)
    return rows.select(F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns]).alias("value"))


def mail_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mail_json_from(table(spark, sf_dir, "customer"))


def mail_json_from(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.to_json(
            F.struct(
                F.col("c_mktsegment").alias("appKey"),
                F.col("c_nationkey").cast("string").alias("appVersion"),
                F.col("c_name").alias("deviceId"),
                F.col("c_custkey").cast("string").alias("phoneNo"),
            )
        ).alias("value")
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("text").alias("value"))


def in_parts(table: DataFrame, order: Column, parts: int) -> list[DataFrame]:
    """The rows in consecutive ranges of an integer order of arrival, each to become a micro-batch.

    Rows without a place in the order come first.
    """
    numbered = table.withColumn("__at", order)
    low, high = numbered.agg(F.min("__at"), F.max("__at")).first()
    numbered = numbered.withColumn("__at", F.coalesce("__at", F.lit(low or 0)))
    step = ((high or 0) - (low or 0)) // parts + 1
    first = low or 0
    return [
        numbered.filter((F.col("__at") >= first + i * step) & (F.col("__at") < first + (i + 1) * step)).drop("__at")
        for i in range(parts)
    ]


def spread(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows dealt evenly over tasks, for input whose files have fewer pieces than there are cores."""
    return rows.repartition(*[F.col(c) for c in columns])


def replay_path(sf_dir: str, name: str) -> str:
    """The table as a streaming path. Written as a glob: a file source takes a folder or a
    glob, and this way the table may be one file or a folder."""
    return f"{sf_dir}/{name}.parque[t]"
