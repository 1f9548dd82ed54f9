"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# 64-byte HMAC key pads are binary literals; keep them out of plan texts and event logs.
PAD_REDACTION = "0x[0-9A-Fa-f]{128}"


def build_session(app: str = "rillstone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    `master` is left to spark-submit unless given. Shuffle partition counts are not fixed
    here: adaptive execution coalesces whatever the cluster configures.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.redaction.string.regex": PAD_REDACTION,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for checkpoints and written tables.

    It lies under `spark.checkpoint.dir`, which on a cluster is storage every executor
    sees. Where that is unset on one machine, it lies in the warehouse, which is shared too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to storage that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/rillstone-{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    An operator that reads its input more than once would otherwise run all that lies below it
    as often; nested ones multiply.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place at once: readers see the old one or the new one, never a part."""
    fs = spark._jvm.org.apache.hadoop.fs
    target = fs.Path(path)
    hidden = fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    conf = spark._jsc.hadoopConfiguration()
    store = target.getFileSystem(conf)
    out = store.create(hidden)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    modes = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    modes[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(target.toUri(), conf).rename(
        store.makeQualified(hidden), store.makeQualified(target), modes
    )


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        return None
    stream = store.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The names of a folder's visible files."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        return []
    names = [status.getPath().getName() for status in store.listStatus(target)]
    return sorted(n for n in names if not n.startswith((".", "_")))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for as long as the block runs; queries started in it keep it."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer read, on whatever storage it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
