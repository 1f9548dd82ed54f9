"""The pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import sys
import os

import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from test_llm_operators import plain_components, plain_cut  # noqa: E402

from rillstone.llm import mixing, quality_ftrl, queries  # noqa: E402
from rillstone.llm.common import table  # noqa: E402


def test_stages_do_what_they_say(spark, sf, tmp_path):
    kept = [table(spark, sf, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], sf).write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}").cache())
    docs, good, unique, cut, mixed, encoded = kept

    scores = quality_ftrl.op5(docs, table(spark, sf, "labels")).where("score >= 0.5")
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scores.collect()}
    labelled = docs.join(table(spark, sf, "labels"), "doc_id").where("quality = 1")
    assert labelled.join(good, "doc_id", "left_semi").count() >= 0.97 * labelled.count()

    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    stays = {i for i, _, _, first in plain_components(texts, 5, 80) if first}
    assert {r["doc_id"]: r["text"] for r in unique.collect()} == {i: t for i, t in texts.items() if i in stays}

    want = plain_cut({i: texts[i] for i in stays})
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {i: t for i, (t, n) in want.items() if t.strip() or not n}
    assert cut.where("n_chars <> length(text)").count() == 0

    size = mixing.n_words("text")
    targets = {r["source"]: r for r in mixing.plan_mix(cut, size, row=F.col("source")).select(F.col("row").alias("source"), "target").distinct().collect()}
    most = cut.groupBy("source").agg(F.max(size).alias("most"))
    for r in mixed.groupBy("source").agg(F.sum(size).alias("n")).join(most, "source").collect():
        assert abs(r["n"] - targets[r["source"]]["target"]) <= r["most"]

    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    by_id = {r["doc_id"]: r["text"] for r in cut.collect()}
    rows = encoded.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in mixed.collect())
    assert all(r["ids"] == model.encode(by_id[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_run_is_all_stages(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "parity"]
    assert rows.count() > 0
