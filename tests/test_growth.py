"""Steps whose cost must follow the rows, seen in their plans."""

from __future__ import annotations

import glob

import pytest

from rillstone.functions import extensions
from rillstone.operators import alerts, changelog, words
from rillstone.operators.blocks import Blocks
from rillstone.plans import aggregates, event_streams, streams
from rillstone.plans.lateral import AverageParts
from rillstone.sources import tables
from tests.conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_named_aggregates_are_called_for_many_groups_at_once(spark):
    extensions.register_two_level(spark, "plain_avg", AverageParts())
    made = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None), (None, 5.0)], "id string, v double")
    extensions.parted(made, 2).createOrReplaceTempView("plain_rows")
    got = spark.sql(extensions.two_level_sql("plain_avg", "id", "v", "plain_rows", "out", 2))
    assert "InPandas" not in plan_of(got) and "AggregateInPython" not in plan_of(got)
    assert rows(got) == [(None, 5.0), ("a", 2.0), ("b", None)]


def test_next_rises_reads_its_rows_twice_and_joins_nothing(spark, tmp_path):
    made = [("k", 0, t) for t in (10, 12, 15, 21, 40)]
    spark.createDataFrame(made, "id string, run bigint, t bigint").write.parquet(str(tmp_path / "rises"))
    near = alerts._next_rises(spark.read.parquet(str(tmp_path / "rises")), ["id", "run"], 5)
    assert rows(near, "t", "to") == [(10, 21), (12, 21), (15, 21), (21, 40)]
    assert plan_of(near).count("FileScan") <= 2


def test_keys_are_counted_by_bucket_and_heavy_ones_are_cut(spark):
    made = [(i % 2 and "hot" or f"k{i}", i) for i in range(2000)] + [(None, i) for i in range(2000, 2600)]
    df = spark.createDataFrame(made, "id string, seq bigint")
    blocks = Blocks("seq", 100, heavy_rows=500)
    assert blocks.heavy(df, ["id"]).count() == 2
    cut = blocks.cut(df, ["id"])
    assert "hashpartitioning(id" not in plan_of(cut)  # the keys themselves are not shuffled to be counted
    assert rows(cut.filter("__heavy").select("id").distinct()) == [(None,), ("hot",)]
    assert cut.filter("__heavy").select("id", "__block").distinct().count() == 20 + 6


def test_changelog_is_folded_without_a_sort(spark):
    made = [("a", 1, True, 1.0, 1), ("a", 2, False, 1.0, 1), ("a", 2, True, 2.0, 2), ("b", 3, True, None, 1), (None, 4, True, 5.0, 1)]
    changes = spark.createDataFrame(made, "id string, seq bigint, op boolean, avg_temp double, cnt bigint")
    folded = changelog.fold_changelog(changes, "id", "seq")
    assert "SortAggregate" not in plan_of(folded)
    assert rows(folded) == [(None, 5.0, 1), ("a", 2.0, 2), ("b", None, 1)]


def test_sensor_functions_write_the_arriving_rows_once(spark, sf):
    def folders():
        return set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/rillstone-arriving-*"))

    before = folders()
    got = event_streams.job_sensor_functions_stream(spark, sf)
    assert len(folders() - before) == 1
    assert got.count() == event_streams.CATALOG["job_sensor_functions"].run(spark, sf).count()


@pytest.mark.parametrize("heavy", [None, 0, 20, 10**6])
@pytest.mark.parametrize("lines", [[-5, 0, 3, 4, 11, 40], [1, 2, 1 << 40], [None, 7, 9]])
def test_word_history_in_one_order_column(spark, lines, heavy):
    texts = ["a b a  c", "", "a a", " ", "b c a a", "c"]
    made = [(line, texts[i % 6]) for i, line in enumerate(lines)]
    df = spark.createDataFrame(made, "line bigint, text string")
    got = words.word_count_history(df, "text", "line", Blocks("line", 4, heavy_rows=heavy))
    assert ("__at" in plan_of(got)) == (max(lines, key=lambda n: n or 0) < 1 << 32 and None not in lines)
    assert got.columns == ["line", "pos", "word", "cnt"] and [t for _, t in got.dtypes] == ["bigint", "int", "string", "bigint"]
    seen, want = {}, []
    for line, text in sorted(made, key=lambda m: (m[0] is not None, m[0])):
        for pos, word in enumerate({" ": [], "": [""]}.get(text, text.split(" "))):
            seen[word] = seen.get(word, 0) + 1
            want.append((line, pos, word, seen[word]))
    if None not in lines or heavy is not None and heavy > 20:
        assert sorted(map(str, rows(got))) == sorted(map(str, want))


def test_words_below_the_limit_need_no_summaries(spark, sf):
    assert aggregates.DOC_BLOCKS.heavy_rows
    text = plan_of(aggregates.word_count_history(spark, sf))
    assert "__bucket" in text and "__at" in text


def test_stream_word_count_deals_its_rows_and_ranks_nothing(spark, sf, monkeypatch):
    dealt, spread = [], tables.spread
    monkeypatch.setattr(tables, "spread", lambda part, *columns: dealt.append(columns) or spread(part, *columns))
    got = streams.stream_word_count(spark, sf)
    assert dealt == [("doc_id",)] * streams.PARTS
    assert "Window" not in plan_of(got)
    assert rows(got, "word", "cnt") == rows(aggregates.word_count(spark, sf), "word", "cnt")
