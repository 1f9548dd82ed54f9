"""Streaming writers: console, topics, JDBC, and idempotent per-batch tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import closing

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter

from rillstone.session import file_names, read_text, remove, write_text
from rillstone.sinks.formats import csv_value

BatchWriter = Callable[[DataFrame, int], None]


def to_console(df: DataFrame, label: str) -> DataStreamWriter:
    """Print batches under a label."""
    return df.select(F.lit(label).alias("label"), "*").writeStream.format("console").queryName(label)


def to_topic(df: DataFrame, options: Mapping[str, str], fmt: str = "kafka") -> DataStreamWriter:
    return csv_value(df).writeStream.format(fmt).options(**options)


def jdbc_batch(url: str, table: str, properties: Mapping[str, str]) -> BatchWriter:
    """Insert each batch through JDBC, one connection per partition.

    The batch number goes into a `batch_id` column. A batch replayed after a failure is inserted
    again: read through `latest`, or a unique key on the table, to count it once. Errors fail
    the query, they are not swallowed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.jdbc(
            url, table, mode="append", properties=dict(properties)
        )

    return write


def table_batch(path: str) -> BatchWriter:
    """Write each batch to its own partition and replace that partition if it is replayed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def manifest_batch(path: str) -> BatchWriter:
    """Write each batch to a folder of its own, and commit it by a manifest that names the folder.

    The manifest is put in place at once, so readers (`read_manifest`) see a batch whole or not at all,
    also while one is replayed: its rows go to a new folder, and the old one goes when the new one counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name, entry = uuid.uuid4().hex, f"{path}/manifest/{batch_id:015d}"
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.parquet(f"{path}/data/{name}")
        before = read_text(spark, entry)
        write_text(spark, entry, name)
        if before:
            remove(spark, f"{path}/data/{before}")

    return write


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All committed batches of a `manifest_batch` table with their `batch_id`."""
    shape = f"{schema}, batch_id bigint"
    names = [read_text(spark, f"{path}/manifest/{n}") for n in file_names(spark, f"{path}/manifest")]
    if not names:
        return spark.createDataFrame([], shape)
    return spark.read.schema(shape).parquet(*[f"{path}/data/{n}" for n in names])


def ledger_batch(connect: Callable[[], object], table: str, columns: Sequence[str], mark: str = "?") -> BatchWriter:
    """Insert each batch into a database once, however often it is replayed.

    `connect` opens a database connection (DB-API) and travels to the executors; `mark` is its parameter sign.
    Tasks put their rows into `<table>_staged` under the batch and the task's number, replacing what an
    earlier attempt of theirs left. Then one transaction moves the batch's staged rows into the table and
    enters the batch into `<table>_ledger`; a batch that is entered is skipped. All three tables exist beforehand:
    the staged one has `batch_id` and `task` ahead of the columns, the ledger `batch_id`.
    """
    names = ", ".join(columns)

    def entered(cursor, batch_id: int) -> bool:
        cursor.execute(f"select 1 from {table}_ledger where batch_id = {mark}", (batch_id,))
        return cursor.fetchone() is not None

    def write(batch: DataFrame, batch_id: int) -> None:
        with closing(connect()) as connection:
            if entered(connection.cursor(), batch_id):
                return

        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            task, n = TaskContext.get().partitionId(), 0
            signs = ", ".join([mark] * (len(columns) + 2))
            with closing(connect()) as connection:
                cursor = connection.cursor()
                cursor.execute(f"delete from {table}_staged where batch_id = {mark} and task = {mark}", (batch_id, task))
                for rows in batches:
                    values = [(batch_id, task, *row) for row in zip(*(c.to_pylist() for c in rows.columns))]
                    if values:
                        cursor.executemany(f"insert into {table}_staged (batch_id, task, {names}) values ({signs})", values)
                    n += len(values)
                connection.commit()
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

        n = batch.select(*columns).mapInArrow(stage, "n long").agg(F.sum("n")).first()[0] or 0
        with closing(connect()) as connection:
            cursor = connection.cursor()
            if entered(cursor, batch_id):
                return
            cursor.execute(f"select count(*) from {table}_staged where batch_id = {mark}", (batch_id,))
            if cursor.fetchone()[0] != n:
                raise RuntimeError(f"batch {batch_id}: staged rows differ from those sent")
            cursor.execute(
                f"insert into {table} ({names}) select {names} from {table}_staged where batch_id = {mark}", (batch_id,)
            )
            cursor.execute(f"insert into {table}_ledger (batch_id) values ({mark})", (batch_id,))
            cursor.execute(f"delete from {table}_staged where batch_id = {mark}", (batch_id,))
            connection.commit()

    return write


def each_batch(
    df: DataFrame, write: BatchWriter, transform: Callable[[DataFrame], DataFrame] | None = None
) -> DataStreamWriter:
    """Send every batch to a writer, after an optional batch transformation."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write(transform(batch) if transform else batch, batch_id)

    return df.writeStream.foreachBatch(handle)


def routed(
    writers: Mapping[str, BatchWriter], column: str, otherwise: BatchWriter | None = None
) -> BatchWriter:
    """Write the rows of every route with that route's writer.

    Rows whose route is null or has no writer go to `otherwise`, with the route column; without
    it they fail the batch before anything of it is written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            others = batch.filter(F.col(column).isNull() | ~F.col(column).isin(*writers))
            if otherwise:
                otherwise(others, batch_id)
            elif not others.isEmpty():
                raise ValueError(f"rows without a writer for their {column}: {others.first()}")
            for route, writer in writers.items():
                writer(batch.filter(F.col(column) == route).drop(column), batch_id)
        finally:
            batch.unpersist()

    return write


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches of a `table_batch` table with their `batch_id`; no batch gives no rows."""
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path)


def latest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state an update-mode table describes: each key's row from its last batch."""
    w = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    ranked = df.withColumn("__rn", F.row_number().over(w))
    return ranked.filter(F.col("__rn") == 1).drop("__rn", "batch_id")
