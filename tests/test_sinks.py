"""Sinks and connectors; outside systems are never contacted."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rillstone.operators import late
from rillstone.sinks import writers
from rillstone.sinks.formats import SINK_COLUMNS, csv_value, rename_for_sink
from rillstone.sources import connectors
from rillstone.streaming.runner import run_batches
from tests.conftest import rows


def test_batch_table_replaces_a_replayed_batch(spark, tmp_path):
    write = writers.table_batch(str(tmp_path / "t"))
    write(spark.createDataFrame([(1, "a")], "k int, v string"), 0)
    write(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), 1)
    write(spark.createDataFrame([(1, "B"), (2, "C")], "k int, v string"), 1)
    table = writers.read_batches(spark, str(tmp_path / "t"), "k int, v string")
    assert rows(table) == [(1, "B", 1), (1, "a", 0), (2, "C", 1)]
    assert rows(writers.latest(table, ["k"])) == [(1, "B"), (2, "C")]


def test_routes_go_to_their_writers(spark, tmp_path):
    df = spark.createDataFrame([("s", 31.0), ("s", 29.0), ("s", None)], "id string, temperature double")
    path = {r: str(tmp_path / r) for r in ("high", "low")}
    write = writers.routed({r: writers.table_batch(p) for r, p in path.items()}, "route")
    write(late.side_output_split(df, "temperature", 30.0), 0)
    assert rows(spark.read.parquet(path["high"]), "temperature") == [(31.0,)]
    assert rows(spark.read.parquet(path["low"]), "temperature") == [(None,), (29.0,)]


def test_rows_without_a_route_are_not_lost(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, route string")
    a, rest = writers.table_batch(str(tmp_path / "a")), writers.table_batch(str(tmp_path / "rest"))
    with pytest.raises(ValueError):
        writers.routed({"a": a}, "route")(df, 0)
    assert not (tmp_path / "a").exists()
    writers.routed({"a": a}, "route", otherwise=rest)(df, 0)
    assert rows(spark.read.parquet(str(tmp_path / "rest")), "k", "route") == [(2, "b"), (3, None)]


def test_csv_values_and_names(spark):
    df = spark.createDataFrame([("a,b", 1, None)], "x string, y int, z string")
    assert rows(csv_value(df)) == [('"a,b",1,',)]
    mail = spark.createDataFrame([("1", "2", "3", "4")], list(SINK_COLUMNS))
    assert rename_for_sink(mail).first().asDict() == {
        "app_key": "1", "app_version": "2", "device_id": "3", "phone_no": "4"}


def test_kafka_options():
    assert connectors.kafka_options("host:1", "t") == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "t", "startingOffsets": "latest"}
    assert connectors.kafka_options("h", "t", "earliest", failOnDataLoss="false")["failOnDataLoss"] == "false"


def test_topic_source_and_sink_with_files(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    (folder / "a.txt").write_text("s_1,1,2.5\ns_2,2,3.5\n")
    stream = connectors.stream_kafka_text(spark, {"path": str(folder)}, fmt="text")
    routed = connectors.csv_values(stream, "id string, timestamp bigint, temperature double").where("id = 's_1'")
    out = {"path": str(tmp_path / "out"), "checkpointLocation": str(tmp_path / "cp")}
    query = writers.to_topic(routed, out, fmt="text").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.read.text(out["path"])) == [("s_1,1,2.5",)]


def test_failing_writer_fails_the_query(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\n")
    write = writers.jdbc_batch("jdbc:none:", "t", {"driver": "no.such.Driver"})
    with pytest.raises(PySparkException):
        run_batches(spark.readStream.text(str(tmp_path / "in")), write, str(tmp_path / "cp"))


def test_console_label(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("hello\n")
    writer = writers.to_console(spark.readStream.text(str(tmp_path / "in")), "words")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    progress = query.lastProgress
    assert query.name == "words" and progress["numInputRows"] == 1
    assert "Console" in progress["sink"]["description"]


def test_processing_interval(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\n")
    stream = spark.readStream.text(str(tmp_path / "in")).withColumn("pt", F.current_timestamp())
    query = stream.writeStream.format("memory").queryName("ticks").trigger(processingTime="200 milliseconds").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("ticks").filter("pt is not null").count() == 1
