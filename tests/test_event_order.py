"""Streams in event-time order, state as a log of runs, committed batches, and two-level aggregates."""

from __future__ import annotations

import json
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from rillstone.functions import extensions
from rillstone.operators import rolling, topn
from rillstone.operators.blocks import Blocks, running_count
from rillstone.operators.changelog import fold_changelog
from rillstone.plans import event_streams, stream_jobs
from rillstone.plans.lateral import AverageParts
from rillstone.sinks import writers
from rillstone.streaming import ordered, pipelines
from rillstone.streaming.carried import Carry, changelog_step, resharded, run_carried, running_step, top_step
from rillstone.streaming.runner import Replay, open_replay, with_state
from tests.conftest import rows

READING = "id string, timestamp bigint, temperature double, seq bigint, arrival_ms bigint"
END = ("end", 32_503_680_000, 0.0, -1, 32_503_680_000_000)


def disordered(n, spread, seed=3):
    pick = random.Random(seed)
    made = []
    for seq in range(n):
        at = 1_000 + seq * 3 - seq % 2 * 3  # some share a second
        key = "hot" if pick.random() < 0.4 else pick.choice(["a", "b", None])
        value = None if pick.random() < 0.1 else float(pick.randrange(20, 40))
        made.append((key, at, value, seq, at * 1000 + pick.randrange(spread)))
    return sorted(made, key=lambda r: (r[4], r[3]))


def run(spark, folder, build, made, parts):
    size = -(-len(made) // parts)
    cut = [spark.createDataFrame(made[i : i + size], READING) for i in range(0, len(made), size)]
    return Replay(spark, str(folder), READING).run_parts(build, cut, spark.createDataFrame([END], READING)).filter("seq is null or seq >= 0")


@pytest.mark.parametrize("parts", [1, 4])
def test_frames_by_event_time_equal_batch(spark, tmp_path, parts):
    made = disordered(160, 60_000)

    def build(events):
        return with_state(ordered.behind_watermark(events, "70 seconds"), ["id"], ordered.OverRowsByTime(2), "eventTime")

    out = run(spark, tmp_path / "in", build, made, parts)
    assert out.where("late").count() == 0
    want = rolling.over_rows(spark.createDataFrame(made, READING), "id", ["timestamp", "seq"], Blocks("timestamp", 50), 2, "seq", "temperature")
    columns = ["id", "seq", "cnt", F.round("avg_temp", 6)]
    assert rows(out, *columns) == rows(want, *columns)


def test_late_rows_are_given_out_and_do_not_enter_frames(spark, tmp_path):
    made, parts = disordered(160, 200_000), 4

    def build(events):
        return with_state(ordered.behind_watermark(events, "10 seconds"), ["id"], ordered.OverRowsByTime(2), "eventTime")

    out = run(spark, tmp_path / "in", build, made, parts)
    late, mark = set(), 0
    for i in range(0, 160, 40):
        late |= {r[3] for r in made[i : i + 40] if r[1] * 1000 <= mark}
        mark = max(mark, max(r[1] for r in made[i : i + 40]) * 1000 - 10_000)
    assert late and {r["seq"] for r in out.where("late").collect()} == late
    assert out.count() == len(made)
    kept = spark.createDataFrame([r for r in made if r[3] not in late], READING)
    want = rolling.over_rows(kept, "id", ["timestamp", "seq"], Blocks("timestamp", 50), 2, "seq", "temperature")
    columns = ["id", "seq", "cnt", F.round("avg_temp", 6)]
    assert rows(out.where("not late"), *columns) == rows(want, *columns)


def test_versions_of_windows_with_allowed_lateness(spark, tmp_path):
    made, parts, size, bound, lateness = disordered(200, 150_000), 5, 40_000, 1_000, 60_000

    def build(events):
        timed = ordered.behind_watermark(events, f"{bound} milliseconds")
        ended = timed.withColumn("window_end", F.expr(f"timestamp * 1000 - timestamp * 1000 % {size} + {size}"))
        return with_state(ended, ["id", "window_end"], ordered.LatenessVersions(lateness), "eventTime")

    got = run(spark, tmp_path / "in", build, made, parts)
    want, open_, sent, mark = [], {}, {}, 0
    order = lambda r: (r[0] is None, r[0] or 0.0, r[1])

    def close(upto):
        for key in [k for k in open_ if k[1] <= upto and k not in sent]:
            sent[key] = 1
            want.append((*key, 1, *min(open_[key], key=order), False))

    for i in range(0, 200, 40):
        close(mark)
        for key, at, value, seq, _ in made[i : i + 40]:
            end = at * 1000 - at * 1000 % size + size
            if end + lateness <= mark:
                want.append((key, end, 0, value, seq, True))
                continue
            held = open_.setdefault((key, end), [])
            held.append((value, seq))
            if end <= mark:
                sent[key, end] = sent.get((key, end), 0) + 1
                want.append((key, end, sent[key, end], *min(held, key=order), False))
        mark = max(mark, max(r[1] for r in made[i : i + 40]) * 1000 - bound)
    close(10**18)
    assert any(w[5] for w in want) and any(w[2] > 1 for w in want)
    columns = ["id", "window_end", "version", "temperature", "seq", "late"]
    assert rows(got, *columns) == sorted(want, key=lambda t: tuple((v is not None, v) for v in t))


def test_state_written_follows_the_keys_touched(spark, tmp_path):
    """A million keys, then batches of a thousand: the log grows by what is touched, and reads give the latest state."""
    carry = Carry(str(tmp_path / "carry"), ["k"])
    carry.write(spark.range(1_000_000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("n")), 0, [])
    written, every = [], {}
    for batch_id in range(1, 7):
        batch = spark.range(1000).select((F.col("id") * 7 + batch_id * 500).alias("k"))
        before, runs = carry.before(batch, batch_id)
        assert before.count() == 1000
        names = {r["name"] for r in runs}
        state = before.select("k", (F.col("n") + 1).alias("n"))
        carry.write(state, batch_id, runs)
        now = json.loads((tmp_path / "carry" / "log" / str(batch_id)).read_text())
        written.append(1000 + sum(r["rows"] for r in now if r["name"] not in names and r["name"].startswith("merged")))
        for k in range(1000):
            every[k * 7 + batch_id * 500] = every.get(k * 7 + batch_id * 500, 0) + 1
    assert max(written) < 20_000 and sum(written) < 40_000 and len(now) <= 12
    whole = carry.latest(carry.read(spark, now))
    assert whole.count() == 1_000_000
    assert {r["k"]: r["n"] for r in whole.where("n > 0").collect()} == every
    # a replayed batch finds its input as it was
    again, runs = carry.before(spark.range(1000).select((F.col("id") * 7 + 3000).alias("k")), 6)
    assert again.count() == 1000 and again.agg(F.max("n")).first()[0] <= 6


def test_null_keys_keep_their_state_and_are_cut(spark, tmp_path):
    schema = "id string, temperature double, seq bigint"
    made = [[(None, 10.0, 1), ("a", None, 2)], [(None, 20.0, 3), ("a", 4.0, 4)]]
    step = changelog_step("id", "temperature", "seq", Blocks("seq", 2, heavy_rows=1))
    for part in made:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = run_carried(open_replay(spark, str(tmp_path / "in"), schema), step, str(tmp_path / "job"), ["id"])
    assert rows(fold_changelog(out, "id", "seq"), "id", "avg_temp", "cnt") == [(None, 15.0, 2), ("a", 4.0, 2)]
    assert rows(out.where("id is null"), "seq", "op", "avg_temp", "cnt") == [
        (1, True, 10.0, 1), (3, False, 10.0, 1), (3, True, 15.0, 2)]
    df = spark.createDataFrame([(None, float(i), i) for i in range(9)], schema)
    assert Blocks("seq", 2, heavy_rows=3).cut(df, ["id"]).select("__block").distinct().count() == 5


def test_counters_move_to_fewer_shards(spark, tmp_path):
    state = spark.createDataFrame([(0, 5), (1, 6), (2, 7), (3, 8)], "shard int, n bigint")
    assert rows(resharded(state, "shard", 3)) == [(0, 13), (1, 6), (2, 7)]
    carry = Carry(str(tmp_path / "carry"), ["shard"])
    carry.write(state, 0, [])
    carry.restate(spark, lambda s: resharded(s, "shard", 3))
    before, _ = carry.before(spark.createDataFrame([(0,), (2,)], "shard int"), 1)
    assert rows(before, "shard", "n") == [(0, 13), (2, 7)]


def test_top_rows_are_kept_between_batches(spark, tmp_path):
    schema, pick = "id string, temperature double, seq bigint", random.Random(1)
    made = [(pick.choice("ab"), float(pick.randrange(9)), i) for i in range(30)]
    order = [F.desc("temperature"), F.asc("seq")]
    for part in (made[:10], made[10:20], made[20:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        step = top_step("id", order, ["temperature", "seq"], 2, "place")
        out = run_carried(open_replay(spark, str(tmp_path / "in"), schema), step, str(tmp_path / "job"), ["id"])
    got = topn.top_n(out.drop("place").distinct(), ["id"], order, 2, "place")
    assert rows(got) == rows(topn.top_n(spark.createDataFrame(made, schema), ["id"], order, 2, "place").select(got.columns))


def test_many_items_of_one_window_are_ranked_in_shares(spark, tmp_path):
    end = 1_800_000
    counts = spark.range(20_000).select(
        F.col("id").alias("itemId"), F.lit(end).cast("long").alias("window_end"), (F.col("id") * 7919 % 10_007).alias("cnt")
    )
    last = spark.createDataFrame([(-1, 32_503_680_000_000, 1)], stream_jobs.COUNTS)
    first = Replay(spark, str(tmp_path / "counts"), stream_jobs.COUNTS).run_parts(pipelines.hot_items_by_share, [counts], last)
    assert first.count() == 16 * 5
    best = first.select("itemId", "window_end", "cnt")
    got = Replay(spark, str(tmp_path / "best"), stream_jobs.COUNTS).run_parts(pipelines.hot_items_by_timer, [best], last)
    columns = ["window_end", "itemId", "cnt", "row_num"]
    assert rows(got, *columns) == rows(topn.hot_items(counts, 5), *columns)


def test_readers_see_whole_batches_only(spark, tmp_path):
    path, shape = str(tmp_path / "t"), "k int"
    assert writers.read_manifest(spark, path, shape).count() == 0
    write = writers.manifest_batch(path)
    write(spark.createDataFrame([(1,)], shape), 0)
    write(spark.createDataFrame([(2,), (3,)], shape), 1)
    before = writers.read_manifest(spark, path, shape)
    spark.createDataFrame([(9,)], shape).write.parquet(f"{path}/data/half-written")
    assert rows(before) == rows(writers.read_manifest(spark, path, shape)) == [(1, 0), (2, 1), (3, 1)]
    write(spark.createDataFrame([(4,)], shape), 1)
    assert rows(writers.read_manifest(spark, path, shape)) == [(1, 0), (4, 1)]
    assert not [p for p in (tmp_path / "t" / "manifest").iterdir() if p.name.startswith(".") and not p.name.endswith(".crc")]


def test_a_replayed_batch_is_entered_once(spark, tmp_path):
    """A database in this process's own file: the write fails midway, is replayed, and replayed again."""
    file = str(tmp_path / "db")
    with sqlite3.connect(file) as db:
        db.execute("create table mail (id integer, name text)")
        db.execute("create table mail_staged (batch_id integer, task integer, id integer, name text)")
        db.execute("create table mail_ledger (batch_id integer)")

    def connect():
        return sqlite3.connect(file, timeout=60)

    class Stopped(sqlite3.Connection):
        def commit(self):
            raise RuntimeError("stopped before the commit")

    batch = spark.range(100).select("id", F.concat(F.lit("n"), "id").alias("name")).coalesce(3)
    write = writers.ledger_batch(connect, "mail", ["id", "name"])

    opened = []

    def stops(*_):
        opened.append(1)
        return sqlite3.connect(file, timeout=60) if len(opened) == 1 else sqlite3.connect(file, timeout=60, factory=Stopped)

    with pytest.raises(Exception, match="stopped before the commit"):
        writers.ledger_batch(stops, "mail", ["id", "name"])(batch, 0)
    with sqlite3.connect(file) as db:
        assert db.execute("select count(*) from mail").fetchone() == (0,)
    for _ in range(3):
        write(batch, 0)
    write(batch.where("id < 10"), 1)
    write(batch.where("id < 0"), 2)
    with sqlite3.connect(file) as db:
        assert db.execute("select count(*), count(distinct id) from mail").fetchone() == (110, 100)
        assert db.execute("select count(*) from mail_staged").fetchone() == (0,)
        assert sorted(db.execute("select batch_id from mail_ledger").fetchall()) == [(0,), (1,), (2,)]


def test_no_call_of_a_two_level_aggregate_gets_a_whole_hot_group(spark):
    class Counting(AverageParts):
        """The average, and the most rows or partial results that one call saw."""

        buffer, returns = "total double, n bigint, most bigint", "string"

        def create(self):
            return (0.0, 0, 0, 0)

        def add(self, acc, value):
            total, n, most, calls = acc
            return total + (value or 0.0), n + (value is not None), max(most, calls + 1), calls + 1

        def merge(self, a, b):
            return a[0] + b[0], a[1] + b[1], max(a[2], b[2]), 0

        def result(self, acc):
            return f"{acc[0] / acc[1]:.3f} {acc[2]}"

    extensions.register_two_level(spark, "watched", Counting())
    made = spark.range(40_000).select(
        F.when(F.col("id") % 10 < 4, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("id"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 100).cast("double")).alias("v"),
    )
    extensions.parted(made, 500).createOrReplaceTempView("watched_rows")
    got = spark.sql(extensions.two_level_sql("watched", "id", "v", "watched_rows", "out", 500))
    want = {r["id"]: r["m"] for r in made.groupBy("id").agg(F.avg("v").alias("m")).collect()}
    found = {r["id"]: r["out"].split() for r in got.collect()}
    assert {k: float(v[0]) for k, v in found.items()} == pytest.approx(want, abs=1e-3)
    assert 0 < max(int(v[1]) for v in found.values()) <= 500
