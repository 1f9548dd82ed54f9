"""Hand-written rows for the batch operators."""

from __future__ import annotations

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rillstone.operators import late, rolling, topn, windows, words
from rillstone.operators.blocks import Blocks
from rillstone.sources import connectors, generator, text
from rillstone.schemas import SENSOR
from tests.conftest import rows

BLOCKS = Blocks("seq", 2)


def readings(spark, *values, key="a"):
    made = [(key, 100 + i, v, i) for i, v in enumerate(values)]
    return spark.createDataFrame(made, "id string, timestamp bigint, temperature double, seq bigint")


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_strict_parsing_fails_on_bad_lines(spark):
    good = text.parse_sensor_csv(lines(spark, "s_1,15,36.6,extra", "s_2, 16 ,1e1"))
    assert rows(good) == [("s_1", 15, 36.6), ("s_2", 16, 10.0)]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            for bad in ("s_1,x,1.0", "s_1,15", ""):
                with pytest.raises(PySparkException):
                    text.parse_sensor_csv(lines(spark, bad)).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_quarantine(spark):
    good, bad = text.split_bad_lines(lines(spark, "s_1,15,36.6", "s_1,x,1.0", "s_1,15", "", "s,1,2,3"), SENSOR)
    assert rows(good) == [("s", 1, 2.0), ("s_1", 15, 36.6)]
    assert rows(bad) == [("",), ("s_1,15",), ("s_1,x,1.0",)]


def test_json(spark):
    src = lines(spark, '{"appKey":"k","appVersion":1,"phoneNo":null}', "not json", '{"deviceId":"d","x":"y"}')
    mail, bad = text.split_bad_json(src)
    assert rows(mail) == [(None, None, "d", None), ("k", "1", None, None)]
    assert rows(bad) == [("not json",)]
    assert rows(text.json_to_mail(src.filter("value <> 'not json'"))) == [(None, None, "d", None), ("k", "1", None, None)]
    with pytest.raises((PySparkException, Py4JJavaError)):
        text.json_to_mail(src).collect()


def test_csv_table_and_views(spark, tmp_path):
    path = tmp_path / "sensor.csv"
    path.write_text("s_1,15,36.6\ns_2,16,1.5\n")
    df = text.scan_csv_table(spark, str(path), "csv_sensor")
    assert rows(spark.sql("select id from csv_sensor where temperature > 2")) == [("s_1",)]
    assert df.schema.simpleString() == "struct<id:string,timestamp:bigint,temperature:double>"
    timed = text.scan_ddl_table(spark, str(path))
    assert rows(timed, "id", F.unix_millis("ks")) == [("s_1", 15_000), ("s_2", 16_000)]
    stream = text.scan_ddl_table(spark, str(tmp_path), stream=True)
    assert stream.isStreaming and "EventTimeWatermark" in stream._jdf.queryExecution().logical().toString()


def test_text_scan_keeps_blank_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\n\nb\n")
    assert rows(text.scan_text(spark, str(tmp_path))) == [("",), ("a",), ("b",)]


def test_print_schema(spark, capsys):
    readings(spark, 1.0).printSchema()
    assert "temperature: double" in capsys.readouterr().out


def test_csv_values(spark):
    assert rows(connectors.csv_values(lines(spark, "s_1,15,36.6"), SENSOR)) == [("s_1", 15, 36.6)]
    for bad in ("s_2,16", "s_2,x,1.0"):
        with pytest.raises((PySparkException, Py4JJavaError)):
            connectors.csv_values(lines(spark, bad), SENSOR).collect()


def test_preview(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (3, "c")], "k int, v string")
    assert rows(connectors.preview(df, "k", 2)) == [(1, "k", "1"), (1, "v", None), (2, "k", "2"), (2, "v", "b")]


def test_running_maxima(spark):
    df = readings(spark, 5.0, 7.0, 7.0, 6.0, 9.0)
    first = rolling.rolling_max(df, "id", "temperature", "seq", BLOCKS, ["timestamp"])
    assert rows(first, "seq", "timestamp", "temperature") == [
        (0, 100, 5.0), (1, 100, 7.0), (2, 100, 7.0), (3, 100, 7.0), (4, 100, 9.0)]
    by = rolling.rolling_max_by(df, "id", "temperature", "seq", BLOCKS)
    assert rows(by, "seq", "timestamp", "best_seq") == [(0, 100, 0), (1, 101, 1), (2, 101, 1), (3, 101, 1), (4, 104, 4)]
    last = rolling.rolling_max_keep_last(df, "id", "temperature", "seq", BLOCKS)
    assert rows(last, "seq", "timestamp", "temperature") == [
        (0, 100, 5.0), (1, 101, 7.0), (2, 102, 7.0), (3, 103, 7.0), (4, 104, 9.0)]


@pytest.mark.parametrize("values", [(1.0, 2.0, 3.0), (3.0, 2.0, 1.0), (4.0,), (-1.0, -2.0), (2.0, 5.0, 3.0, 5.0)])
def test_two_slot_aggregate_as_written(spark, values):
    first = second = topn.SMALLEST_POSITIVE
    for v in values:
        if v > first:
            first = v
        elif v > second:
            second = v
    got = topn.top_n_compat(readings(spark, *values), "id", "temperature", "seq", BLOCKS)
    assert rows(got, "temp_rank", "temp") == [(1, first), (2, second)]


def test_min_by_ties_and_nulls(spark):
    df = readings(spark, 5.0, 3.0, 3.0, 8.0).withColumn("rt", F.timestamp_seconds("timestamp"))
    got = windows.tumble_min_by(df, "id", "rt", 10_000, "temperature", "seq")
    assert rows(got, "window_end", "seq", "temperature") == [(110_000, 1, 3.0)]


def test_null_readings_are_no_minimum(spark):
    """Windows, and windows with allowed lateness, alike in batch and in SQL; a window of nulls gives its first row."""
    df = readings(spark, None, 5.0, 7.0, None, None).withColumn("rt", F.timestamp_seconds("timestamp"))
    df = df.withColumn("timestamp", F.when(F.col("seq") > 2, F.col("timestamp") + 10).otherwise(F.col("timestamp")))
    df = df.withColumn("rt", F.timestamp_seconds("timestamp"))
    want = [(110_000, 1, 5.0), (120_000, 3, None)]
    assert rows(windows.tumble_min_by(df, "id", "rt", 10_000, "temperature", "seq"), "window_end", "seq", "temperature") == want
    classes = late.late_classify(df, F.col("timestamp") * 1000, ["seq"], BLOCKS, 10_000, 20, 60_000)
    assert rows(late.min_by_with_lateness(classes, "id", "temperature", "seq"), "window_end", "seq", "temperature") == want


def test_hop_on_the_edge(spark):
    df = spark.createDataFrame([(1, 300), (1, 299)], "item bigint, sec bigint").withColumn("ts", F.timestamp_seconds("sec"))
    got = windows.hop_count(df, "item", "ts", 600_000, 300_000)
    assert rows(got, "window_end", "cnt") == [(300_000, 1), (600_000, 2), (900_000, 1)]
    direct = windows.hop_count_direct(df, "item", "ts", 600_000, 300_000)
    assert rows(direct) == rows(got)


@pytest.mark.parametrize("size,slide", [(600_000, 300_000), (700_000, 300_000), (300_000, 300_000)])
def test_panes_equal_direct(spark, size, slide):
    df = spark.range(500).select((F.col("id") % 3).alias("item"), F.timestamp_seconds(F.col("id") * 37).alias("ts"))
    assert rows(windows.hop_count(df, "item", "ts", size, slide)) == rows(
        windows.hop_count_direct(df, "item", "ts", size, slide))


def test_ranking_ties_and_short_windows(spark):
    made = [(item, 300_000, 2) for item in range(7, 0, -1)] + [(9, 600_000, 1)]
    counts = spark.createDataFrame(made, "itemId bigint, window_end bigint, cnt bigint")
    top = topn.hot_items(counts, 5)
    assert rows(top, "window_end", "row_num", "itemId") == [
        (300_000, i, i) for i in range(1, 6)] + [(600_000, 1, 9)]
    report = {r["window_end"]: r["report"] for r in topn.format_report(top).collect()}
    assert report[600_000] == (
        "=====================\n窗口结束时间: 1970-01-01 00:10:00.0\nNo 1: 商品ID= 9 热门度= 1\n"
        "===============================\n")
    assert report[300_000].count("\n") == 8


def test_report_does_not_depend_on_the_zone(spark):
    counts = spark.createDataFrame([(9, 600_000, 1)], "itemId bigint, window_end bigint, cnt bigint")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        report = topn.format_report(topn.hot_items(counts)).first()["report"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert "1970-01-01 00:10:00.0" in report


def test_side_output_partitions_the_input(spark):
    df = readings(spark, 30.0, 30.1, None, 5.0)
    routes = late.side_output_split(df, "temperature", 30.0)
    assert rows(routes, "seq", "route") == [(0, "low"), (1, "high"), (2, "low"), (3, "low")]


def test_lateral_forms(spark):
    df = spark.createDataFrame([("a_b_",), ("_",), ("",), (None,)], "id string")
    inner = words.lateral_split(df, "id", "_", ["id"])
    assert rows(inner) == [("", "", 0), ("a_b_", "a", 1), ("a_b_", "b", 1)]
    outer = words.lateral_split(df, "id", "_", ["id"], outer=True)
    assert rows(outer) == [(None, None, None), ("", "", 0), ("_", None, None), ("a_b_", "a", 1), ("a_b_", "b", 1)]


def test_word_history_ends_at_the_count(spark):
    df = spark.createDataFrame([(0, "a b a"), (1, ""), (2, "b a ")], "n bigint, text string")
    history = words.word_count_history(df, "text", "n", Blocks("n", 1))
    assert rows(history.groupBy("word").agg(F.max("cnt"))) == rows(words.word_count(df, "text"))


def test_generated_readings(spark):
    df = generator.gen_sensor_readings(spark, 50, block_ticks=7)
    assert df.groupBy("id").count().agg(F.min("count"), F.max("count"), F.count("id")).first() == (50, 50, 10)
    again = generator.gen_sensor_readings(spark, 50, block_ticks=100)
    columns = ["id", "timestamp", F.round("temperature", 6)]
    assert rows(df, *columns) == rows(again, *columns)
    steps = df.groupBy("id").agg(F.max("timestamp") - F.min("timestamp"))
    assert {r[1] for r in rows(steps)} == {98}
    assert generator.stream_sensor_readings(spark).isStreaming
