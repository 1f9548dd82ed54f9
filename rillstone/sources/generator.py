"""Seeded sensor readings: each sensor starts near 60 and drifts by a normal step per tick."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators.blocks import Blocks, running, running_sum


def gen_sensor_readings(
    spark: SparkSession, ticks: int, sensors: int = 10, start: int = 0, seed: int = 7,
    block_ticks: int = 100_000,
) -> DataFrame:
    """`sensors * ticks` readings, one per sensor every 2 seconds."""
    n = spark.range(ticks * sensors)
    tick = F.floor(F.col("id") / sensors)
    steps = n.select(
        F.concat(F.lit("sensor_"), (F.col("id") % sensors + 1).cast("string")).alias("id"),
        tick.alias("tick"),
        F.when(tick == 0, 60 + 20 * F.randn(seed)).otherwise(F.randn(seed + 1)).alias("step"),
    )
    walked = running(
        steps, ["id"], ["tick"], Blocks("tick", block_ticks), {"temperature": running_sum(F.col("step"))}
    )
    return walked.select("id", (F.lit(start) + F.col("tick") * 2).alias("timestamp"), "temperature")


def stream_sensor_readings(spark: SparkSession, rows_per_second: int = 5, sensors: int = 10) -> DataFrame:
    """The live form: ids cycle over a rate source, temperatures vary around 60."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select(
        F.concat(F.lit("sensor_"), (F.col("value") % sensors + 1).cast("string")).alias("id"),
        F.unix_seconds("timestamp").alias("timestamp"),
        (60 + 20 * F.randn()).alias("temperature"),
    )
