"""Ordered per-key operators on streams, without funnelling a hot key through one task.

`transformWithState` handles all rows of a key in one task. Where a key may hold a large
share of the stream, the block operators do the work of each micro-batch instead, and what
a key's later rows need from earlier ones is carried over in a table of a few values per key.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillstone.operators import alerts, late, rolling, topn
from rillstone.operators.blocks import Blocks, Running, preceding_state, running, running_state
from rillstone.operators.changelog import averages, changes_of
from rillstone.session import file_names, read_text, remove, shared_dir, stored, write_text
from rillstone.sinks.writers import table_batch

# (rows of the batch, what is carried in or None) -> (results, what is carried on)
Step = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]]


class Carry:
    """What is carried per key, as a log of runs: a batch writes the state of the keys it touches, and nothing else.

    A run is the table of one batch's state rows, each with its batch's number. A key's state is its rows
    of the latest batch that touched it. Before a run is added, the runs behind it that are not
    larger than about twice what follows them are merged into it, keeping only the latest state of each key; so
    there are as many runs as the logarithm of the keys, and rows are rewritten that often. `log/n` lists
    the runs after batch n. A batch reads the list of its predecessor, so one that is replayed
    finds its input unchanged; runs that the last two lists don't name are removed.
    """

    def __init__(self, home: str, keys: Sequence[str]):
        self.home, self.keys = home, list(keys)

    def runs(self, spark: SparkSession, batch_id: int) -> list[dict]:
        """Name and number of rows of every run after a batch, oldest first."""
        text = read_text(spark, f"{self.home}/log/{batch_id}") if batch_id >= 0 else None
        return json.loads(text) if text else []

    def read(self, spark: SparkSession, runs: list[dict]) -> DataFrame:
        return spark.read.parquet(*[f"{self.home}/runs/{run['name']}" for run in runs])

    def latest(self, rows: DataFrame) -> DataFrame:
        """The rows that each key's latest batch wrote."""
        newest = F.max("__batch").over(Window.partitionBy(*self.keys))
        return rows.withColumn("__newest", newest).filter("__batch = __newest").drop("__newest")

    def before(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame | None, list[dict]]:
        """The state of the keys that the batch touches."""
        spark = batch.sparkSession
        runs = self.runs(spark, batch_id - 1)
        if not runs:
            return None, runs
        rows = self.read(spark, runs)
        if self.keys:
            touched = batch.select(*[F.col(k).alias(f"__touched_{k}") for k in self.keys]).distinct()
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__touched_{k}")) for k in self.keys])
            rows = rows.join(touched, same, "left_semi")
        return self.latest(rows).drop("__batch"), runs

    def write(self, carry: DataFrame, batch_id: int, runs: list[dict]) -> None:
        spark = carry.sparkSession
        fresh = self.add(carry.withColumn("__batch", F.lit(batch_id).cast("long")), f"batch-{batch_id}")
        merge, total = len(runs), fresh["rows"]
        while merge and runs[merge - 1]["rows"] <= 2 * total:
            merge -= 1
            total += runs[merge]["rows"]
        now = [*runs, fresh]
        if merge < len(runs):
            now = [*runs[:merge], self.add(self.latest(self.read(spark, now[merge:])), f"merged-{batch_id}")]
        write_text(spark, f"{self.home}/log/{batch_id}", json.dumps(now))
        kept = {run["name"] for run in [*now, *runs]}
        for run in self.runs(spark, batch_id - 2):
            if run["name"] not in kept:
                remove(spark, f"{self.home}/runs/{run['name']}")
        if fresh["name"] not in {run["name"] for run in now}:
            remove(spark, f"{self.home}/runs/{fresh['name']}")

    def restate(self, spark: SparkSession, change: Callable[[DataFrame], DataFrame]) -> None:
        """Replace all state after the last batch, while the query is stopped: e.g. when keys are dealt anew."""
        last = max(map(int, file_names(spark, f"{self.home}/log")))
        rows = change(self.latest(self.read(spark, self.runs(spark, last))).drop("__batch"))
        run = self.add(rows.withColumn("__batch", F.lit(last).cast("long")), f"restated-{last}")
        write_text(spark, f"{self.home}/log/{last}", json.dumps([run]))

    def add(self, rows: DataFrame, name: str) -> dict:
        path = f"{self.home}/runs/{name}"
        rows.write.mode("overwrite").parquet(path)
        return {"name": name, "rows": rows.sparkSession.read.schema("__none int").parquet(path).count()}


def run_carried(
    df: DataFrame, step: Step, home: str | None = None, keys: Sequence[str] = (),
    trigger: Mapping[str, str | bool] | None = None,
) -> DataFrame:
    """Process all input there is and read the results back.

    Called again with the same `home` it goes on with what is new. `keys` are those of the step's
    state. With a trigger, see `start_carried`, the query goes on until it is stopped.
    """
    spark = df.sparkSession
    home = home or shared_dir(spark, "carried")
    start_carried(df, step, home, keys, trigger or {"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{home}/out").drop("batch_id")


def start_carried(
    df: DataFrame, step: Step, home: str, keys: Sequence[str] = (), trigger: Mapping[str, str | bool] | None = None
) -> StreamingQuery:
    """Start a query without waiting for it; `trigger` as in Spark, e.g. {"processingTime": "10 seconds"}."""
    out = table_batch(f"{home}/out")
    held = Carry(f"{home}/carry", keys)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            before, known = held.before(batch, batch_id)
            results, carry = step(batch, before)
            out(results, batch_id)
            held.write(carry, batch_id, known)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(handle).option("checkpointLocation", f"{home}/checkpoint")
    return (writer.trigger(**trigger) if trigger else writer).start()


def resharded(state: DataFrame, shard: str, shards: int) -> DataFrame:
    """Counters per shard for another number of shards: an old shard's counts go to its number modulo the new ones."""
    counters = [c for c in state.columns if c != shard]
    new = F.pmod(F.col(shard), F.lit(shards)).cast(state.schema[shard].dataType)
    return state.groupBy(new.alias(shard)).agg(*[F.sum(c).alias(c) for c in counters])


def top_step(key: str, order: Sequence[Column], columns: Sequence[str], n: int, rank: str) -> Step:
    """The first n rows per key so far, sent again whenever a batch holds rows of the key."""

    def step(batch, before):
        rows = batch.select(key, *columns)
        if before is not None:
            rows = rows.unionByName(before)
        out = stored(topn.top_n(rows, [key], order, n, rank), "top")
        return out, out.drop(rank)

    return step


def running_step(
    keys: Sequence[str], order: Sequence[str], blocks: Blocks, measures: Callable[[], Mapping[str, Running]]
) -> Step:
    def step(batch, before):
        out = running(batch, keys, order, blocks, measures(), before)
        return out, running_state(batch, keys, measures(), before)

    return step


def jump_step(key: str, value: str, order: str, blocks: Blocks, threshold: float) -> Step:
    def step(batch, before):
        out = alerts.temp_jump_alert(batch, key, value, order, blocks, threshold, before)
        return out, preceding_state(batch, [key], [order], 1, [value], before)

    return step


def over_rows_step(key: str, order: str, blocks: Blocks, preceding: int, value: str) -> Step:
    def step(batch, before):
        out = rolling.over_rows(batch, key, [order], blocks, preceding, key, value, before)
        return out, preceding_state(batch, [key], [order], preceding, [key, value], before)

    return step


def changelog_step(key: str, value: str, order: str, blocks: Blocks) -> Step:
    """Carries the sums and the last result sent of every key."""
    sums, sent = ("sum", "seen", "n"), ("avg_temp", "cnt")

    def step(batch, before):
        past = None if before is None else before.select(key, *sums)
        last = None if before is None else before.select(key, order, *sent)
        results = stored(averages(batch, key, value, order, blocks, past, sums), "changelog")
        # a key's last row holds all that its next rows start from
        carry = preceding_state(results, [key], [order], 1, [*sums, *sent])
        return changes_of(results.select(key, order, *sent), key, order, blocks, last), carry

    return step


def late_step(
    time_s: str, order: Sequence[str], size_ms: int, bound_ms: int, lateness_ms: int,
    shard: Sequence[str] = (), block_rows: int = 1_000_000,
) -> Step:
    """Late classes against the watermark per source shard, or of the whole stream.

    Arrival times are not dense, so the blocks are fitted to each batch.
    """

    def step(batch, before):
        time_ms = F.col(time_s) * 1000
        blocks = Blocks.fit(batch, order[0], block_rows)
        out = late.late_classify(
            batch, time_ms, order, blocks, size_ms, bound_ms, lateness_ms, shard, before
        )
        return out, running_state(batch, shard, late.latest_time(time_ms), before)

    return step
