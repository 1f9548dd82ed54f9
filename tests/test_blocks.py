"""Block-wise operators against plain windows, with a hot key and blocks of every size."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillstone.operators import alerts, late, topn
from rillstone.operators.blocks import (
    Blocks,
    over_preceding,
    preceding_state,
    running,
    running_count,
    running_first,
    running_max,
    running_min,
    running_state,
    running_sum,
)
from rillstone.operators.changelog import fold_changelog, retract_changelog
from tests.conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(3)
    made = []
    for seq in range(600):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(12)}"
        temp = None if rnd.random() < 0.03 else float(rnd.randrange(-5, 30))
        made.append((key, seq * 3 + rnd.randrange(3), temp))
    df = spark.createDataFrame(made, "id string, seq bigint, temp double").repartition(5).persist()
    yield df
    df.unpersist()


MEASURES = ["n", "total", "high", "low", "first", "prior_n", "prior_high"]


def measures():
    t = F.col("temp")
    return {
        "n": running_count(), "total": running_sum(t), "high": running_max(t), "low": running_min(t),
        "first": running_first(t, ["seq"]), "prior_n": running_count(before=True),
        "prior_high": running_max(t, before=True),
    }


def plain(df):
    w = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    p = Window.partitionBy("id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return df.select(
        "id", "seq", F.count(F.lit(1)).over(w), F.sum("temp").over(w), F.max("temp").over(w),
        F.min("temp").over(w), F.first("temp").over(w), F.sum(F.lit(1)).over(p), F.max("temp").over(p),
    )


@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
def test_running(data, width):
    out = running(data, ["id"], ["seq"], Blocks("seq", width), measures())
    assert rows(out, "id", "seq", *MEASURES) == rows(plain(data))


@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
@pytest.mark.parametrize("n", [1, 3])
def test_over_preceding(data, width, n):
    out = over_preceding(
        data, ["id"], ["seq"], Blocks("seq", width), n, ["temp"],
        {"last": lambda w: F.lag("temp", n).over(w),
         "avg": lambda w: F.avg("temp").over(w.rowsBetween(-n, 0)),
         "c": lambda w: F.count("id").over(w.rowsBetween(-n, 0))},
    )
    w = Window.partitionBy("id").orderBy("seq")
    want = data.select("id", "seq", F.lag("temp", n).over(w), F.avg("temp").over(w.rowsBetween(-n, 0)),
                       F.count("id").over(w.rowsBetween(-n, 0)))
    assert rows(out, "id", "seq", "last", "avg", "c") == rows(want)


def test_without_keys(data):
    out = running(data, [], ["seq"], Blocks("seq", 50), {"n": running_count()})
    ordered = [r[0] for r in rows(data, "seq")]
    assert rows(out, "seq", "n") == [(s, i + 1) for i, s in enumerate(ordered)]


@pytest.mark.parametrize("cut", [1, 300, 900])
def test_carried_from_batch_to_batch(data, cut):
    before, after = data.filter(F.col("seq") < cut), data.filter(F.col("seq") >= cut)
    blocks = Blocks("seq", 40)
    state = running_state(before, ["id"], measures())
    out = running(before, ["id"], ["seq"], blocks, measures()).unionByName(
        running(after, ["id"], ["seq"], blocks, measures(), state)
    )
    assert rows(out, "id", "seq", *MEASURES) == rows(plain(data))
    folded = rows(running_state(after, ["id"], measures(), state), "id", "n", "total", "high", "first")
    assert folded == rows(running_state(data, ["id"], measures()), "id", "n", "total", "high", "first")

    held = preceding_state(before, ["id"], ["seq"], 2, ["temp"])
    look = {"two": lambda w: F.lag("temp", 2).over(w)}
    both = over_preceding(before, ["id"], ["seq"], blocks, 2, ["temp"], look).unionByName(
        over_preceding(after, ["id"], ["seq"], blocks, 2, ["temp"], look, held)
    )
    want = data.select("id", "seq", F.lag("temp", 2).over(Window.partitionBy("id").orderBy("seq")))
    assert rows(both, "id", "seq", "two") == rows(want)


def test_fit_bounds_the_densest_block(spark):
    dense = spark.range(5000).select((F.col("id") + 1_000_000).alias("t"))
    df = dense.union(spark.range(500).select(F.col("id") * 10_000))
    blocks = Blocks.fit(df, "t", rows=400)
    largest = df.groupBy(blocks.of()).count().agg(F.max("count")).first()[0]
    assert largest <= 800
    assert Blocks.fit(df, "t").width > 5_000_000


def test_alerts_and_changelog_do_not_depend_on_blocks(data):
    df = data.filter("temp is not null").withColumn("ts", F.col("seq"))
    for fn in (
        lambda b: alerts.temp_jump_alert(df, "id", "temp", "seq", b, 10.0),
        lambda b: alerts.rising_alert_first(df, "id", "temp", "ts", "seq", b, 12),
        lambda b: retract_changelog(df, "id", "temp", "seq", b),
        lambda b: topn.top_n_compat(df, "id", "temp", "seq", b),
        lambda b: late.watermark_trace(df, F.col("seq") * 7 % 1000, ["seq"], b, 5),
    ):
        assert rows(fn(Blocks("seq", 9))) == rows(fn(Blocks("seq", 100_000)))


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_changelog_folds_to_the_aggregate(data, width):
    fractions = data.withColumn("temp", F.col("temp") / 7)
    changes = retract_changelog(fractions, "id", "temp", "seq", Blocks("seq", width)).persist()
    want = fractions.groupBy("id").agg((F.sum("temp") / F.count("temp")).alias("a"), F.count(F.lit(1)).alias("n"))
    got = fold_changelog(changes, "id", "seq").join(want, "id")
    assert got.count() == want.count()
    assert got.where("cnt <> n or abs(avg_temp - a) > 1e-9").count() == 0
    # every deletion is, bit for bit, the addition before it
    net = changes.groupBy("id", "avg_temp", "cnt").agg(F.sum(F.when(F.col("op"), 1).otherwise(-1)).alias("net"))
    assert net.where("net > 0").count() == want.count() and net.where("net < 0").count() == 0
    changes.unpersist()


def test_only_heavy_keys_are_cut_and_results_agree(data):
    df = data.filter("temp is not null").withColumn("ts", F.col("seq"))
    for heavy in (0, 20, 10**6):
        blocks = Blocks("seq", 9, heavy_rows=heavy)
        for fn in (
            lambda b: alerts.temp_jump_alert(df, "id", "temp", "seq", b, 10.0),
            lambda b: alerts.rising_alert_first(df, "id", "temp", "ts", "seq", b, 12),
            lambda b: topn.top_n_compat(df, "id", "temp", "seq", b),
        ):
            assert rows(fn(blocks)) == rows(fn(Blocks("seq", 100_000)))
    cut = Blocks("seq", 9, heavy_rows=10**6).cut(df, ["id"])
    assert cut.select("id", "__block").distinct().count() == df.select("id").distinct().count()


@pytest.mark.parametrize("width", [1, 3, 10**6])
def test_pages_hold_every_row_once(spark, width):
    df = spark.range(40).select((F.col("id") % 4).alias("k"), "id").repartition(3)
    pages = [rows(topn.page_rows(df, ["k"], page, 5, Blocks("k", width))) for page in range(1, 10)]
    assert sorted(r for page in pages for r in page) == rows(df)
    assert [len(p) for p in pages] == [5] * 8 + [0]
    keys = [k for page in pages for k, _ in page]
    assert keys == sorted(keys)
    by_id = [rows(topn.page_rows(df, ["k", "id"], page, 5, Blocks("k", width)), "id") for page in (1, 2)]
    assert by_id == [[(0,), (4,), (8,), (12,), (16,)], [(20,), (24,), (28,), (32,), (36,)]]
