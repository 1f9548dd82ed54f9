"""Running streaming queries to the end of their input, restartable from a checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from rillstone.session import ROCKSDB_PROVIDER, setting, shared_dir
from rillstone.sinks.writers import BatchWriter, each_batch, read_batches, table_batch

IDLE_KEY = "spark.sql.streaming.noDataMicroBatches.enabled"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
TRACK_ROWS_KEY = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state on local disk and in checkpoints, not on the heap; timers need this store.

    Its metric of the number of keys is left out: it costs a look-up for every write.
    """
    spark.conf.set(PROVIDER_KEY, ROCKSDB_PROVIDER)
    spark.conf.set(TRACK_ROWS_KEY, "false")


def open_replay(
    spark: SparkSession, path: str, schema: str, limits: Mapping[str, str] | None = None
) -> DataFrame:
    """A parquet table as a stream.

    Without limits the table is one micro-batch, and no row is late whatever the order of its
    files. `{"maxBytesPerTrigger": ...}` cuts it into batches, in file order: use it where files
    are in time order. It also bounds what a keyed processor has to sort.
    """
    return spark.readStream.schema(schema).options(**(limits or {})).parquet(path)


def with_state(
    df: DataFrame, keys: list[str], processor: StatefulProcessor, time_mode: str = "none"
) -> DataFrame:
    use_rocksdb(df.sparkSession)
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=processor.output, outputMode="Append",
        timeMode=time_mode,
    )


def start_batches(
    df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    trigger: Mapping[str, str | bool] | None = None, idle_batches: bool = True,
) -> StreamingQuery:
    """Start a query without waiting for it; `trigger` as in Spark, e.g. {"processingTime": "10 seconds"}.

    `idle_batches` lets batches without input run, which event-time timers and windows need to close.
    """
    use_rocksdb(df.sparkSession)
    writer = each_batch(df, write, transform).outputMode(mode).option("checkpointLocation", checkpoint)
    with setting(df.sparkSession, IDLE_KEY, str(idle_batches).lower()):
        return (writer.trigger(**trigger) if trigger else writer).start()


def run_batches(
    df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append",
    transform: Callable[[DataFrame], DataFrame] | None = None, idle_batches: bool = True,
) -> None:
    """Process all input there is, then stop. Called again with the same checkpoint, only
    what is new; a batch that had failed is written again over its own output."""
    start_batches(df, write, checkpoint, mode, transform, {"availableNow": True}, idle_batches).awaitTermination()


def run_at_intervals(
    df: DataFrame, write: BatchWriter, checkpoint: str, interval: str, mode: str = "append",
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Run with a trigger interval until all input there is has been processed, then stop the query."""
    query = start_batches(df, write, checkpoint, mode, transform, {"processingTime": interval})
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_to_table(
    df: DataFrame, mode: str = "append", transform: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Process all input there is into a table in the shared folder and read it back, with the
    `batch_id` of every row."""
    spark = df.sparkSession
    home = shared_dir(spark, "stream")
    run_batches(df, table_batch(f"{home}/out"), f"{home}/checkpoint", mode, transform)
    return read_table(spark, home, df, transform)


def read_table(spark, home, df, transform=None) -> DataFrame:
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        for f in (transform(empty_like(df)) if transform else df).schema
    )
    return read_batches(spark, f"{home}/out", schema)


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


class Replay:
    """A bounded table run as a stream whose end closes all windows.

    Windows close only when the watermark passes them. After the table has been read, the
    query is restarted from its checkpoint with one more file, an end row far in the future.
    Operators must ignore the end row by an aggregate's output; a plain filter would move
    below the watermark and hide it.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str, limits: Mapping[str, str] | None = None,
        idle_batches: bool = True,
    ):
        """Processing-time timers need `idle_batches` off: with them on, a query that has one never comes to its end."""
        self.spark, self.path, self.schema, self.limits = spark, path, schema, limits
        self.idle_batches = idle_batches
        self.home = shared_dir(spark, "replay")
        self.end_dir = f"{self.home}/end"
        # An empty table, so that the second source has a folder to look into.
        spark.createDataFrame([], schema).write.parquet(self.end_dir)

    def rows(self) -> DataFrame:
        table = open_replay(self.spark, self.path, self.schema, self.limits)
        return table.unionByName(open_replay(self.spark, self.end_dir, self.schema))

    def run(
        self, build: Callable[[DataFrame], DataFrame], end_row: DataFrame,
        transform: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        self._step(build, transform)
        end_row.write.mode("append").parquet(self.end_dir)
        df = self._step(build, transform)
        return read_table(self.spark, self.home, df, transform)

    def run_parts(
        self, build: Callable[[DataFrame], DataFrame], parts: Sequence[DataFrame], end_row: DataFrame,
        transform: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """The same for rows that arrive in parts: each is added to `path` and processed on its own."""
        for part in parts:
            part.write.mode("append").parquet(self.path)
            self._step(build, transform)
        end_row.write.mode("append").parquet(self.end_dir)
        df = self._step(build, transform)
        return read_table(self.spark, self.home, df, transform)

    def _step(self, build, transform) -> DataFrame:
        df = build(self.rows())
        run_batches(
            df, table_batch(f"{self.home}/out"), f"{self.home}/checkpoint", transform=transform,
            idle_batches=self.idle_batches,
        )
        return df
