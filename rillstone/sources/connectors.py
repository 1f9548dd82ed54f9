"""Connectors to outside systems. Format and options come from the caller, so tests can
swap in files; no address, user or password has a default."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def open_stream(spark: SparkSession, fmt: str, options: Mapping[str, str], schema: str | None = None
                ) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load()


def kafka_options(servers: str, topic: str, start: str = "latest", **extra: str) -> dict[str, str]:
    """`start` is `latest`, `earliest` or a JSON of offsets; a restarted query uses its checkpoint."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        **extra,
    }


def stream_kafka_text(spark: SparkSession, options: Mapping[str, str], fmt: str = "kafka") -> DataFrame:
    """Topic values as strings in a `value` column."""
    return open_stream(spark, fmt, options).select(F.col("value").cast("string").alias("value"))


def stream_kafka_earliest(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    return stream_kafka_text(spark, kafka_options(servers, topic, "earliest", **extra))


def csv_values(df: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """CSV text in a column to the declared fields; a malformed record fails the query.

    `text.split_bad_lines` is the tolerant form, with the malformed records as a second table.
    """
    return df.select(F.from_csv(column, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def stream_kafka_csv_table(
    spark: SparkSession, options: Mapping[str, str], schema: str, view: str | None = None
) -> DataFrame:
    """A topic of CSV records as a table. View names are case-insensitive: choose distinct ones."""
    df = csv_values(stream_kafka_text(spark, options), schema)
    if view:
        df.createOrReplaceTempView(view)
    return df


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Text lines from a TCP socket: for demonstrations only, it can't be replayed."""
    return open_stream(spark, "socket", {"host": host, "port": str(port)})


def scan_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
              partition_column: str | None = None, bounds: tuple[int, int] | None = None,
              partitions: int = 1) -> DataFrame:
    """A JDBC table, read in parallel ranges when a numeric partition column is given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return reader.load()


def preview(df: DataFrame, order: str, n: int = 10) -> DataFrame:
    """The first n rows in long form: (row_no, column, value), values as text."""
    names = df.columns
    # At most n rows reach the numbering, so one task is enough for it.
    text_row = F.struct(*[F.col(c).cast("string").alias(c) for c in names])
    first = df.orderBy(order).limit(n).select(text_row.alias("r"), F.col(order).alias("k"))
    rows = first.groupBy().agg(F.sort_array(F.collect_list(F.struct("k", "r"))).alias("rows"))
    numbered = rows.select(F.posexplode("rows").alias("pos", "e"))
    wide = numbered.select((F.col("pos") + 1).alias("row_no"), "e.r.*")
    return wide.unpivot("row_no", names, "column", "value")
