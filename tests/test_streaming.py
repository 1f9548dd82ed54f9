"""Streaming operators: one file against many, restart, and equality with the batch twins."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from rillstone.operators import alerts, late, rolling, topn, windows
from rillstone.operators.blocks import Blocks, running_count
from rillstone.operators.changelog import retract_changelog
from rillstone.plans import streams
from rillstone.schemas import EVENTS
from rillstone.session import shared_dir
from rillstone.sinks.writers import latest, read_batches, table_batch
from rillstone.sources import tables, text
from rillstone.streaming import pipelines
from rillstone.streaming import processors as proc
from rillstone.streaming.carried import late_step, run_carried, running_step, start_carried
from rillstone.streaming.runner import Replay, open_replay, run_batches, run_to_table, with_state
from tests.conftest import rows

SENSOR = "id string, timestamp bigint, temperature double, seq bigint, kind string, arrival_ms bigint"
ONE_FILE = {"maxFilesPerTrigger": "1"}
BLOCKS = Blocks("seq", 50)


def write_chunks(df, order, folder, n):
    """The rows as n files whose modification times follow the order."""
    os.makedirs(folder, exist_ok=True)
    frame = df.orderBy(*order).toPandas()
    size = -(-len(frame) // n)
    for i in range(n):
        part = frame.iloc[i * size:(i + 1) * size]
        add_file(df.sparkSession.createDataFrame(part, df.schema), folder, i)
    return folder


def add_file(df, folder, i):
    path = f"{folder}/part-{i:04d}.parquet"
    df.toPandas().to_parquet(path, coerce_timestamps="us", allow_truncated_timestamps=True)
    os.utime(path, (1_700_000_000 + i * 10,) * 2)


@pytest.fixture(scope="module")
def readings(spark):
    rnd = random.Random(11)
    made = []
    for seq in range(240):
        key = "hot" if rnd.random() < 0.4 else f"s_{rnd.randrange(5)}"
        made.append((key, 1_000 + seq * 3, float(rnd.randrange(20, 45)), seq, rnd.choice("abc"),
                     (1_000 + seq * 3) * 1000 + rnd.randrange(60_000)))
    df = spark.createDataFrame(made, SENSOR).persist()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def chunked(readings, tmp_path_factory):
    return write_chunks(readings, ["seq"], str(tmp_path_factory.mktemp("chunks")), 4)


def keyed(spark, folder, keys, processor, limits=None, *extra):
    df = open_replay(spark, folder, SENSOR, limits).select("*", *extra)
    return run_to_table(with_state(df, keys, processor)).drop("batch_id")


@pytest.mark.parametrize("limits", [None, ONE_FILE], ids=["one batch", "four batches"])
def test_keyed_processors_equal_batch(spark, readings, chunked, limits):
    jumps = keyed(spark, chunked, ["id"], proc.JumpAlert(10.0), limits)
    want = alerts.temp_jump_alert(readings, "id", "temperature", "seq", BLOCKS, 10.0)
    assert rows(jumps, "id", "seq", "last_temp", "cur_temp") == rows(want, "id", "seq", "last_temp", "cur_temp")

    over = keyed(spark, chunked, ["id"], proc.OverRows(2), limits)
    want = rolling.over_rows(readings, "id", ["seq"], BLOCKS, 2, "id", "temperature")
    assert rows(over, "id", "seq", "cnt", F.round("avg_temp", 6)) == rows(
        want, "id", "seq", "cnt", F.round("avg_temp", 6))

    changes = keyed(spark, chunked, ["id"], proc.Changelog(), limits)
    want = retract_changelog(readings, "id", "temperature", "seq", BLOCKS)
    columns = ["id", "seq", "op", "cnt", F.round("avg_temp", 6)]
    assert rows(changes, *columns) == rows(want, *columns)


def test_state_kinds_and_counts(spark, readings, chunked):
    kinds = keyed(spark, chunked, ["id"], proc.StateKinds(3), ONE_FILE)
    counted = rolling.keyed_running_count(readings, ["id"], ["seq"], BLOCKS)
    assert rows(kinds, "id", "seq", "n") == rows(counted, "id", "seq", "n")
    recent = rolling.last_n_text(readings, "id", "seq", BLOCKS, 3, F.col("seq").cast("string"))
    assert rows(kinds, "seq", "last_seqs") == rows(recent, "seq", "last_values")
    last = kinds.groupBy("id", "kind").agg(F.max_by("kind_sum", "seq"))
    assert rows(last) == rows(readings.groupBy("id", "kind").agg(F.sum("temperature")))
    top = kinds.groupBy("id").agg(F.max("max_temp"))
    assert rows(top) == rows(readings.groupBy("id").agg(F.max("temperature")))

    shard = (F.col("seq") % 3).cast("int").alias("shard")
    numbers = keyed(spark, chunked, ["shard"], proc.RunningCount(), ONE_FILE, shard)
    assert rows(numbers, "seq", "n") == [(s, s // 3) for s in range(240)]


def arrival_chunks(readings, tmp_path, n):
    return write_chunks(readings, ["arrival_ms", "seq"], str(tmp_path / f"arrival{n}"), n)


@pytest.mark.parametrize("n", [1, 4])
def test_late_classes(spark, readings, tmp_path, n):
    folder = arrival_chunks(readings, tmp_path, n)
    want = rows(
        late.late_classify(readings, F.col("timestamp") * 1000, ["arrival_ms", "seq"],
                           Blocks("arrival_ms", 20_000), 15_000, 20, 20_000),
        "seq", "window_end", "late_class",
    )
    assert {w[2] for w in want} == {"on_time", "allowed", "late"}
    tagged = keyed(spark, folder, ["shard"], proc.LateSplit(15_000, 20, 20_000), ONE_FILE, F.lit(0).alias("shard"))
    assert rows(tagged, "seq", "window_end", "late_class") == want
    step = late_step("timestamp", ["arrival_ms", "seq"], 15_000, 20, 20_000, block_rows=20)
    carried = run_carried(open_replay(spark, folder, SENSOR, ONE_FILE), step)
    assert rows(carried, "seq", "window_end", "late_class") == want


def test_late_at_the_boundary(spark):
    # Bound 1 s, windows of 10 s, lateness 5 s; the watermark stands at 21 s.
    made = [(22, 1), (20, 2), (9, 3), (12, 4), (10, 5)]
    df = spark.createDataFrame(made, "timestamp bigint, seq bigint")
    out = late.late_classify(df, F.col("timestamp") * 1000, ["seq"], Blocks("seq", 2), 10_000, 1000, 5000)
    tags = dict((r["seq"], r["late_class"]) for r in out.collect())
    # Windows end at 30, 30, 10, 20, 20 s; kept until 15 and 25 s.
    assert tags == {1: "on_time", 2: "on_time", 3: "late", 4: "allowed", 5: "allowed"}
    exact = late.late_class(F.col("end"), F.lit(20_000), 5_000)
    ends = spark.createDataFrame([(20_001,), (20_000,), (15_001,), (15_000,)], "end bigint")
    assert [r[0] for r in ends.select(exact).collect()] == ["on_time", "allowed", "allowed", "late"]


def simulate_rising(readings, interval, first_counts=False):
    out = []
    by_key = {}
    for r in sorted(readings, key=lambda r: (r["timestamp"], r["seq"])):
        by_key.setdefault(r["id"], []).append((r["timestamp"], r["temperature"]))
    for key, series in by_key.items():
        last, due = (0.0 if first_counts else None), None
        for now, value in series:
            if due is not None and now > due:
                out.append((key, due - interval, due))
                due = None
            if last is not None and value > last and due is None:
                due = now + interval
            elif last is not None and value < last:
                due = None
            last = value
        if due is not None:
            out.append((key, due - interval, due))
    return sorted(out)


def rising_stream(spark, folder, interval, limits, first_counts=False):
    df = pipelines.with_event_time(open_replay(spark, folder, SENSOR, limits), delay="0 seconds")
    out = run_to_table(with_state(df, ["id"], proc.RisingAlert(interval, first_counts), "eventTime"))
    return rows(out.filter("id <> 'end'"), "id", "start", "fire")


END = [("end", 10**9, 0.0, 10**9, "a", 0)]


@pytest.mark.parametrize("first_counts", [False, True])
def test_rising_alerts(spark, readings, tmp_path, first_counts):
    ended = readings.union(spark.createDataFrame(END, SENSOR))
    want = simulate_rising(readings.collect(), 12, first_counts)
    if not first_counts:
        for width in (9, 10_000):
            batch = alerts.rising_alerts(readings, "id", "temperature", "timestamp", "seq", Blocks("seq", width), 12)
            assert rows(batch, "id", "start", "fire") == want
    for n in (1, 5):
        folder = write_chunks(ended, ["seq"], str(tmp_path / f"r{n}"), n)
        assert rising_stream(spark, folder, 12, ONE_FILE, first_counts) == want


def test_rising_edges(spark, tmp_path):
    def series(key, *pairs):
        # A stream's watermark starts at 0, where a row would count as late already.
        return [(key, 100 + t, float(v), i, "a", 0) for i, (t, v) in enumerate(pairs)]

    made = (
        series("equal", (0, 1), (5, 2), (10, 2), (16, 2))  # equal values keep the timer
        + series("before", (0, 1), (5, 2), (14, 1))  # falls before the end
        + series("at", (0, 1), (5, 2), (15, 1))  # falls at exactly the end
        + series("after", (0, 1), (5, 2), (16, 1))  # falls after it
        + series("twice", (0, 1), (5, 2), (16, 3), (30, 4), (41, 5))  # several alerts in one run
        + series("single", (0, 7))
    )
    df = spark.createDataFrame(made + END, SENSOR)
    folder = write_chunks(df, ["timestamp", "id"], str(tmp_path / "edges"), 1)
    got = rising_stream(spark, folder, 10, None)
    assert got == simulate_rising(spark.createDataFrame(made, SENSOR).collect(), 10)
    assert [(k, f) for k, _, f in got if k != "twice"] == [("after", 115), ("equal", 115)]
    first = alerts.rising_alert_first(df.filter("id <> 'end'"), "id", "temperature", "timestamp", "seq", BLOCKS, 10)
    assert rows(first, "id", "fire") == [("after", 115), ("equal", 115), ("twice", 115)]
    every = alerts.rising_alerts(df.filter("id <> 'end'"), "id", "temperature", "timestamp", "seq", BLOCKS, 10)
    assert rows(every) == got


def test_one_long_rise(spark, monkeypatch):
    """A key that only rises, with pointers cut into blocks."""
    monkeypatch.setattr(alerts, "RISE_BLOCK", 25)
    made = [("up", 100 + 2 * i, float(i), i) for i in range(300)]
    df = spark.createDataFrame(made, "id string, timestamp bigint, temperature double, seq bigint")
    got = alerts.rising_alerts(df, "id", "temperature", "timestamp", "seq", BLOCKS, 9)
    assert rows(got) == simulate_rising(df.collect(), 9) and len(rows(got)) == 60


def test_timers_and_context(spark, readings, tmp_path):
    # Row b deletes the timer row a set 90 s later in event time but earlier in arrival.
    extra = [("del", 2000, 1.0, 300, "a", 0), ("del", 1910, 1.0, 301, "a", 0)]
    df = readings.union(spark.createDataFrame(extra, SENSOR))
    folder = write_chunks(df.union(spark.createDataFrame(END, SENSOR)), ["seq"], str(tmp_path / "t"), 1)
    timed = pipelines.with_event_time(open_replay(spark, folder, SENSOR), delay="0 seconds")
    out = run_to_table(with_state(timed, ["id"], proc.ElementTimers(10, 100), "eventTime"))
    out = out.filter("id <> 'end'")
    fired = rows(out.filter("what = 'timer'"), "id", "at_ms")
    assert fired == rows(alerts.timer_set(df, "id", "timestamp", "seq", 10, 100))
    assert ("del", 2_010_000) not in fired and ("del", 1_920_000) in fired
    seen = rows(out.filter("what = 'row'"), "id", "at_ms", "len")
    assert seen == rows(df, "id", F.col("timestamp") * 1000, F.length("id"))
    assert out.filter("what = 'timer' and watermark < at_ms").count() == 0


def test_top_n_by_timer_equals_ranking(spark, tmp_path):
    rnd = random.Random(5)
    made = [(item, end * 300_000, rnd.randrange(1, 6)) for end in range(1, 5) for item in range(30)]
    schema = "itemId bigint, window_end bigint, cnt bigint"
    counts = spark.createDataFrame(made, schema)
    folder = str(tmp_path / "counts")
    os.makedirs(folder)
    add_file(counts, folder, 0)
    add_file(spark.createDataFrame([(0, 10**10, 1)], schema), folder, 1)
    stream = pipelines.hot_items_by_timer(open_replay(spark, folder, schema, ONE_FILE))
    out = run_to_table(stream).filter("window_end < 10000000000")
    want = topn.hot_items(counts, 5)
    assert rows(out, "window_end", "row_num", "itemId", "cnt") == rows(want, "window_end", "row_num", "itemId", "cnt")


def test_restart_continues_where_it_stopped(spark, readings, tmp_path):
    folder, home = str(tmp_path / "in"), str(tmp_path / "job")
    os.makedirs(folder)
    step = running_step(["id"], ["seq"], BLOCKS, lambda: {"n": running_count()})
    out = None
    for i, cut in enumerate(["seq < 100", "seq >= 100"]):
        add_file(readings.filter(cut), folder, i)
        out = run_carried(open_replay(spark, folder, SENSOR), step, home)
    want = rolling.keyed_running_count(readings, ["id"], ["seq"], BLOCKS)
    assert rows(out, "id", "seq", "n") == rows(want, "id", "seq", "n")
    again = run_carried(open_replay(spark, folder, SENSOR), step, home)
    assert rows(again, "id", "seq", "n") == rows(want, "id", "seq", "n")


def test_restarted_aggregate_in_update_mode(spark, tmp_path):
    folder, home = str(tmp_path / "lines"), str(tmp_path / "job")
    os.makedirs(folder)
    for i, content in enumerate(["a b a\n\nb", "b c\n"]):
        with open(f"{folder}/{i}.txt", "w") as f:
            f.write(content)
        counts = pipelines.word_counts(text.stream_text(spark, folder), "value")
        run_batches(counts, table_batch(f"{home}/out"), f"{home}/checkpoint", "update")
    final = latest(read_batches(spark, f"{home}/out", "word string, cnt bigint"), ["word"])
    assert rows(final, "word", "cnt") == [("", 1), ("a", 2), ("b", 3), ("c", 1)]
    batch = pipelines.word_counts(text.scan_text(spark, folder), "value")
    assert rows(batch) == rows(final, "word", "cnt")


def split_events(spark, sf, tmp_path, n):
    events = spark.read.parquet(f"{sf}/events.parquet")
    return write_chunks(events, ["event_id"], str(tmp_path / f"events{n}"), n)


def test_windows_in_one_batch_and_many(spark, sf, tmp_path):
    batch = windows.hop_count(
        tables.user_behavior(spark, sf).withColumn("ts", F.timestamp_seconds("timestamp")),
        "itemId", "ts", 3_600_000, 300_000, F.col("behavior") == "pv",
    )
    want = rows(batch, "itemId", "window_end", "cnt")
    for n in (1, 3):
        replay = Replay(spark, split_events(spark, sf, tmp_path, n), EVENTS, ONE_FILE)
        out = replay.run(lambda r: pipelines.hop_views(tables.user_behavior_from(r)), streams.end_row(spark))
        assert rows(out, "itemId", "window_end", "cnt") == want


def test_allowed_lateness_updates_the_window(spark, tmp_path):
    # One row per file and so per batch; windows of 10 s, bound 1 s, lateness 20 s.
    made = [("a", 5, 9.0, 0), ("a", 22, 5.0, 1), ("a", 8, 3.0, 2), ("a", 60, 7.0, 3), ("a", 61, 6.0, 4), ("a", 9, 1.0, 5)]
    df = spark.createDataFrame(made, "id string, timestamp bigint, temperature double, seq bigint")
    folder = write_chunks(df, ["seq"], str(tmp_path / "late"), 6)
    stream = open_replay(spark, folder, df._jdf.schema().toDDL(), ONE_FILE)
    minima = pipelines.tumbling_min_with_lateness(stream, 10_000, 1000, 20_000)
    sent = run_to_table(minima, "update")
    assert rows(sent.filter("window_end = 10000"), "temperature") == [(3.0,), (9.0,)]
    final = latest(sent, ["id", "window_end"])
    classes = late.late_classify(df, F.col("timestamp") * 1000, ["seq"], BLOCKS, 10_000, 1000, 20_000)
    want = late.min_by_with_lateness(classes, "id", "temperature", "seq")
    assert rows(final, "window_end", "temperature", "seq") == rows(want, "window_end", "temperature", "seq")
    assert rows(want, "window_end", "temperature") == [(10_000, 3.0), (30_000, 5.0), (70_000, 6.0)]


def test_state_is_cleared_after_its_timer(spark, tmp_path):
    """A window that fires, then gets rows again, starts anew."""
    schema = "itemId bigint, window_end bigint, cnt bigint, at bigint"
    folder = str(tmp_path / "again")
    os.makedirs(folder)
    # Timers fire in the batch after the one that moves the watermark, behind that batch's rows.
    made = [(1, 300_000, 5, 1), (9, 900_000, 1, 1000), (9, 900_000, 1, 1500), (2, 300_000, 3, 2000),
            (9, 900_000, 1, 9000)]
    for i, row in enumerate(made):
        add_file(spark.createDataFrame([row], schema), folder, i)
    stream = open_replay(spark, folder, schema, ONE_FILE)
    timed = stream.withColumn("closed", F.timestamp_seconds("at")).withWatermark("closed", "0 seconds")
    out = run_to_table(with_state(timed, ["window_end"], proc.TopNPerWindow(5), "eventTime"))
    sent = rows(out.filter("window_end = 300000"), "row_num", "itemId", "cnt")
    assert sent == [(1, 1, 5), (1, 2, 3)]


def test_table_stored_as_a_folder(spark, sf, tmp_path):
    split_events(spark, sf, tmp_path, 2)
    os.rename(tmp_path / "events2", tmp_path / "events.parquet")
    got = streams.jump_stream(spark, str(tmp_path))
    want = alerts.temp_jump_alert(tables.sensor(spark, sf), "id", "temperature", "seq", BLOCKS, 10.0)
    assert rows(got, "id", "seq") == rows(want, "id", "seq")


def test_open_windows_stay_unsent_without_an_end(spark, sf):
    stream = open_replay(spark, tables.replay_path(sf, "events"), EVENTS)
    sent = run_to_table(pipelines.tumbling_avg(tables.sensor_from(stream), 3_600_000)).count()
    assert sent < streams.assign_watermark(spark, sf).count()


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def folder_of(path):
    os.makedirs(path, exist_ok=True)
    return path


def test_a_query_can_go_on_until_it_is_stopped(spark, tmp_path):
    step = running_step(["id"], ["seq"], Blocks("seq", 10), lambda: {"n": running_count()})
    folder, home = folder_of(str(tmp_path / "in")), str(tmp_path / "job")
    add_file(spark.createDataFrame([("a", 1)], "id string, seq bigint"), folder, 0)
    rows_in = open_replay(spark, folder, "id string, seq bigint")
    query = start_carried(rows_in, step, home, ["id"], {"processingTime": "100 milliseconds"})
    try:
        query.processAllAvailable()
        add_file(spark.createDataFrame([("a", 2)], "id string, seq bigint"), folder, 1)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert rows(spark.read.parquet(f"{home}/out"), "id", "n") == [("a", 1), ("a", 2)]


def test_null_readings_are_treated_as_in_batch(spark, readings, tmp_path):
    holes = readings.withColumn("temperature", F.when(F.col("seq") % 5 != 0, F.col("temperature")))
    folder = write_chunks(holes, ["seq"], str(tmp_path / "holes"), 2)
    jumps = keyed(spark, folder, ["id"], proc.JumpAlert(10.0), ONE_FILE)
    want = alerts.temp_jump_alert(holes, "id", "temperature", "seq", BLOCKS, 10.0)
    assert rows(jumps, "id", "seq", "last_temp", "cur_temp") == rows(want, "id", "seq", "last_temp", "cur_temp")
    over = keyed(spark, folder, ["id"], proc.OverRows(2), ONE_FILE)
    want = rolling.over_rows(holes, "id", ["seq"], BLOCKS, 2, "id", "temperature")
    columns = ["id", "seq", "cnt", F.round("avg_temp", 6)]
    assert rows(over, *columns) == rows(want, *columns)
    changes = keyed(spark, folder, ["id"], proc.Changelog(), ONE_FILE)
    last = changes.filter("op").groupBy("id").agg(F.max_by(F.struct("avg_temp", "cnt"), "seq").alias("v")).select("id", F.round("v.avg_temp", 6), "v.cnt")
    assert rows(last) == rows(holes.groupBy("id").agg(F.round(F.avg("temperature"), 6), F.count(F.lit(1))))
    kinds = keyed(spark, folder, ["id"], proc.StateKinds(3), ONE_FILE)
    best = kinds.groupBy("id").agg(F.max_by("max_temp", "seq"))
    assert rows(best) == rows(holes.groupBy("id").agg(F.max("temperature")))
