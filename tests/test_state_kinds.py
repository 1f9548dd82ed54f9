"""All kinds of state in one shuffle: against plain windows, over several batches and with cut keys."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillstone.operators.blocks import Blocks
from rillstone.plans import streams
from tests.conftest import rows

COLUMNS = ["id", "seq", "kind", "n", "kind_sum", "max_temp", "last_seqs"]


@pytest.mark.parametrize("heavy", [None, 30, 10**6])
def test_state_kinds_over_batches(spark, tmp_path, monkeypatch, heavy):
    rnd = random.Random(5)
    made = [
        (rnd.choice(["hot", "hot", "hot", "a", "b", None]), seq, rnd.choice(["x", "y", None]),
         None if rnd.random() < 0.1 else float(rnd.randrange(-9, 30)))
        for seq in range(360)
    ]
    made += [("first", 121, "x", -3.0), ("last", 359, "x", 4.0)]
    df = spark.createDataFrame(made, "id string, seq bigint, kind string, temperature double")
    monkeypatch.setattr(streams, "SEQ_BLOCKS", Blocks("seq", 17, heavy_rows=heavy))
    written = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    before, outs = None, []
    for number in range(3):
        batch = df.filter(f"seq div 120 = {number}")
        out, carry = streams.kinds_step(batch, before)
        outs.append(rows(out, *COLUMNS))
        carry.write.parquet(f"{tmp_path}/{number}")
        state = spark.read.parquet(f"{tmp_path}/{number}")
        if before is not None:  # as in `Carry`, a key that the batch doesn't touch keeps its state
            state = state.unionByName(before.join(batch.select("id").distinct(), before.id.eqNullSafe(batch.id), "left_anti"))
        before = state
    # nothing is written between the windows
    assert not any("-kinds-" in name for name in set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - written)
    per_id = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    per_kind = Window.partitionBy("id", "kind").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(
        "id", "seq", "kind", F.count(F.lit(1)).over(per_id), F.sum("temperature").over(per_kind), F.max("temperature").over(per_id),
        F.concat_ws(",", F.collect_list(F.col("seq").cast("string")).over(per_id.rowsBetween(-2, 0))),
    )
    assert sorted(map(str, (r for out in outs for r in out))) == sorted(map(str, rows(want)))
