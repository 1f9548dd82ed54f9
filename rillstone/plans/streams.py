"""Streaming runs over the whole tables, checked against the same SQL as their batch twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from rillstone.operators.blocks import (
    BLOCK,
    halos,
    preceding_state,
    running_count,
    running_max,
    running_state,
    running_sum,
    seeds,
    with_slots,
)
from rillstone.plans.catalog import SENSOR, WORDS, register, rounded, with_
from rillstone.plans.event_windows import HOP_SQL, OVER_SQL, TOP_SQL, end_sql, min_by_sql, tumble_sql
from rillstone.plans.scans import CHANGELOG_SQL
from rillstone.plans.stateful import CLASSES, JUMP_SQL, SHARDS, STATE_KINDS_SQL, SUBTASK_SQL
from rillstone.schemas import DOCUMENTS, EVENTS
from rillstone.session import shared_dir
from rillstone.sinks.writers import read_batches, table_batch
from rillstone.sources import tables
from rillstone.sources.tables import SEQ_BLOCKS
from rillstone.streaming import pipelines
from rillstone.streaming.carried import (
    changelog_step,
    jump_step,
    late_step,
    over_rows_step,
    run_carried,
    running_step,
)
from rillstone.streaming.runner import Replay, open_replay, run_batches

# The end row: a moment after any data, with values that no window result may keep.
END_EVENT = "select -1L, timestamp_ntz'2999-01-01 00:00:00', -1L, 'end', 0D, '{}'"


def end_row(spark):
    return spark.sql(f"select * from ({END_EVENT}) as t(event_id, ts, user_id, event_type, value, props)")


PARTS = 3


def sensor_stream(spark, folder):
    return tables.sensor_from(open_replay(spark, folder, EVENTS))


def arriving(spark, sf, step, keys, rows=lambda df: df, order=None):
    """Run a carried step over the events as they arrive: each part of the table is a micro-batch
    of its own, and the state of the parts before reaches it through the carried table."""
    home = shared_dir(spark, "arriving")
    for part in tables.in_parts(tables.table(spark, sf, "events"), F.col("event_id") if order is None else order, PARTS):
        tables.spread(part, "event_id").write.mode("append").parquet(f"{home}/events")
        out = run_carried(rows(sensor_stream(spark, f"{home}/events")), step, f"{home}/run", keys)
    return out


@register("stream_word_count", with_(WORDS) + "select word, count(*) as cnt from words group by word")
def stream_word_count(spark, sf):
    home = shared_dir(spark, "arriving")
    for part in tables.in_parts(tables.table(spark, sf, "documents"), F.col("doc_id"), PARTS):
        # a range of the table lies in few of its files, each read by few tasks
        tables.spread(part, "doc_id").write.mode("append").parquet(f"{home}/documents")
        counts = pipelines.word_counts(open_replay(spark, f"{home}/documents", DOCUMENTS))
        run_batches(counts, table_batch(f"{home}/out"), f"{home}/checkpoint", "update")
    sent = read_batches(spark, f"{home}/out", "word string, cnt bigint")
    # a batch sends a word once, so its last count needs no ranking
    return sent.groupBy("word").agg(F.max_by("cnt", "batch_id").alias("cnt"))


def replayed(spark, sf, build, transform=None):
    """The whole table as one micro-batch: for entries whose other form runs over several."""
    replay = Replay(spark, tables.replay_path(sf, "events"), EVENTS)
    return replay.run(build, end_row(spark), transform).drop("batch_id")


def replayed_parts(spark, sf, build):
    """The table as it arrives, in several micro-batches."""
    replay = Replay(spark, f"{shared_dir(spark, 'arriving')}/events", EVENTS)
    parts = tables.in_parts(tables.table(spark, sf, "events"), F.col("event_id"), PARTS)
    return replay.run_parts(build, parts, end_row(spark)).drop("batch_id")


@register("assign_watermark", tumble_sql(3600))
def assign_watermark(spark, sf):
    """Tumbling averages of the stream; the end row's sensor is dropped from the results."""
    out = replayed_parts(spark, sf, lambda rows: pipelines.tumbling_avg(tables.sensor_from(rows), 3_600_000))
    return out.filter("id <> 'sensor_-1'").withColumn("avg_temp", rounded("avg_temp"))


@register("tumble_event_min_by_stream", min_by_sql(end_sql(15)))
def min_by_stream(spark, sf):
    def build(rows):
        readings = tables.sensor_from(rows).select("id", "timestamp", "temperature", "seq")
        return pipelines.tumbling_min(readings, 15_000)

    return replayed_parts(spark, sf, build).filter("seq >= 0").select(
        "id", "window_end", "timestamp", "temperature", "seq"
    )


@register("hop_count_stream", HOP_SQL)
def hop_count_stream(spark, sf):
    return replayed_parts(spark, sf, lambda rows: pipelines.hop_views(tables.user_behavior_from(rows)))


@register("hot_items_topn_stream", TOP_SQL)
def hot_items_stream(spark, sf):
    return replayed(
        spark, sf, lambda rows: pipelines.hop_views(tables.user_behavior_from(rows)),
        pipelines.rank_closed_windows(5),
    )


@register("keyed_state_kinds_stream", STATE_KINDS_SQL)
def state_kinds_stream(spark, sf):
    """All kinds of state at once, each carried from batch to batch."""
    out = arriving(spark, sf, kinds_step, ["id"], lambda rows: rows.select("id", "seq", "kind", "temperature"))
    return out.select("id", "seq", "kind", "n", rounded("kind_sum").alias("kind_sum"), "max_temp", "last_seqs")


def kinds_step(batch, before):
    parts = {name: None if before is None else before.filter(F.col("part") == name) for name in STATES}
    with_text = batch.withColumn("__v", F.col("seq").cast("string"))
    carry = {
        "id": running_state(batch, ["id"], id_measures(), narrowed(parts["id"], "id", "n", "max_temp")),
        "kind": running_state(batch, ["id", "kind"], kind_measures(),
                              narrowed(parts["kind"], "id", "kind", "kind_sum")),
        "recent": preceding_state(with_text, ["id"], ["seq"], 2, ["__v"], parts["recent"]),
    }
    tagged = [state.withColumn("part", F.lit(name)) for name, state in carry.items()]
    return kinds_so_far(batch, parts), reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


STATES = ("id", "kind", "recent")


def kinds_so_far(batch, parts):
    """All states after every row. Ids are cut once, and what blocks start from is dealt with their rows, so that one
    shuffle serves all windows."""
    heavy = SEQ_BLOCKS.heavy(batch, ["id"])
    cut = SEQ_BLOCKS.cut(batch, ["id"], heavy).withColumn("__v", F.col("seq").cast("string"))
    by_id, by_kind = {"n": "__n", "max_temp": "__max"}, {"kind_sum": "__sum"}
    rows = with_slots(with_slots(cut, id_measures(), by_id), kind_measures(), by_kind)
    # what came before: folded values first, then the rows looked back at, then the rows themselves
    for place, before in enumerate((
        seeds(cut, ["id"], id_measures(), by_id, heavy, parts["id"]),
        seeds(cut, ["id", "kind"], kind_measures(), by_kind, heavy, parts["kind"], cut_by=["id"]),
        halos(cut, ["id"], ["seq"], 2, ["seq", "__v"], heavy, parts["recent"]),
    )):
        before = before.withColumn("__place", F.lit(place))
        rows = (rows if place else rows.withColumn("__place", F.lit(3))).unionByName(before, allowMissingColumns=True)
    dealt = rows.repartition("id", BLOCK)
    per_id = Window.partitionBy("id", BLOCK).orderBy("__place", "seq")
    per_kind = Window.partitionBy("id", BLOCK, "kind").orderBy("__place", "seq")
    upto = (Window.unboundedPreceding, 0)
    named = {n: m.fold(F.col(by_id[n])).over(per_id.rowsBetween(*upto)) for n, m in id_measures().items()}
    # folded values have no text, and lists leave nulls out
    named["last_seqs"] = F.concat_ws(",", F.collect_list("__v").over(per_id.rowsBetween(-2, 0)))
    named |= {n: m.fold(F.col(by_kind[n])).over(per_kind.rowsBetween(*upto)) for n, m in kind_measures().items()}
    out = dealt.select(*batch.columns, "__place", *[c.alias(n) for n, c in named.items()])
    return out.filter("__place = 3").drop("__place")


def id_measures():
    return {"n": running_count(), "max_temp": running_max(F.col("temperature"))}


def kind_measures():
    return {"kind_sum": running_sum(F.col("temperature"))}


def narrowed(df, *columns):
    return None if df is None else df.select(*columns)


@register("temp_jump_alert_stream", JUMP_SQL)
def jump_stream(spark, sf):
    return arriving(spark, sf, jump_step("id", "temperature", "seq", SEQ_BLOCKS, 10.0), ["id"])


@register("over_rows_carried_stream", OVER_SQL)
def over_rows_stream(spark, sf):
    out = arriving(spark, sf, over_rows_step("id", "seq", SEQ_BLOCKS, 2, "temperature"), ["id"])
    return out.select("id", "seq", (F.col("timestamp") * 1000).alias("rt_ms"), "cnt",
                      rounded("avg_temp").alias("avg_temp"))


@register("retract_changelog_stream", CHANGELOG_SQL)
def changelog_stream(spark, sf):
    out = arriving(spark, sf, changelog_step("id", "temperature", "seq", SEQ_BLOCKS), ["id"])
    return out.withColumn("avg_temp", rounded("avg_temp"))


@register("subtask_counter_stream", SUBTASK_SQL)
def subtask_stream(spark, sf):
    def sharded(rows):
        return rows.select((F.col("seq") % SHARDS).cast("int").alias("shard"), "seq")

    step = running_step(["shard"], ["seq"], SEQ_BLOCKS, lambda: {"n": running_count()})
    return arriving(spark, sf, step, ["shard"], sharded).withColumn("n", F.col("n") - 1)


@register(
    "late_side_output", with_(SENSOR) + CLASSES + "select id, seq, window_end, late_class from classes"
)
def late_side_output(spark, sf):
    """Spark drops late rows without a trace, so they are told apart before any watermark."""
    step = late_step("timestamp", ["arrival_ms", "seq"], 15_000, 20, 60_000)
    out = arriving(spark, sf, step, [], order=tables.arrival_ms())
    return out.select("id", "seq", "window_end", "late_class")
