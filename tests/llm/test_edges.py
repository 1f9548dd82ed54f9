"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from rillstone.llm import (
    collocations, langid_crf, minhash_join, mixing, phrase_index, pivot_topk, quality_ftrl, queries, rule_ledger,
    sentence_spans, sentencepiece_backend, token_alignment, token_store, whole_tokens,
)
from rillstone.llm.common import table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"

OPERATORS = {
    "op1": lambda docs, labels: langid_crf.op1(docs),
    "op2": lambda docs, labels: token_store.op2(docs, queries.WORD_VOCABULARY),
    "op3": lambda docs, labels: mixing.op3(docs),
    "op4": lambda docs, labels: sentencepiece_backend.op4(docs, queries.PIECES),
    "op5": quality_ftrl.op5,
    "op7": lambda docs, labels: minhash_join.op7(docs),
    "op8": lambda docs, labels: whole_tokens.op8(docs, queries.BYTE_VOCABULARY),
    "op9": lambda docs, labels: rule_ledger.op9(docs),
    "op10": lambda docs, labels: sentence_spans.op10(docs),
    "op11": lambda docs, labels: token_alignment.op11(docs, queries.BYTE_VOCABULARY, queries.PIECES),
    "op12": lambda docs, labels: phrase_index.op12(docs, docs.select(F.col("doc_id").alias("item_id"), "text").where("doc_id % 7 = 1 or doc_id is null")),
    "op13": lambda docs, labels: collocations.op13(docs),
}
CLASHING = ["row", "size", "key", "range", "copy", "score", "ids", "span", "a", "b", "node", "kept", "order", "words", "target", "_text", "rank", "tie"]


def documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars").limit(60).collect()
    long = " ".join(r["text"] for r in docs) * 8
    odd = [
        (None, "A text without an id.", "en", "src0", 21), (9001, None, None, None, None), (9002, "", "en", None, 0),
        (9003, " \n\t ", None, "src0", 4), (9004, long, "en", "src0", len(long)), (9005, "x" * 200_000, "en", "src1", 200_000),
        (9006, "12 34 ... !!", "en", "src1", 12), (9007, "same words " * 4, "en", "src1", 44), (9007, "same words " * 4, "en", "src1", 44),
        (None, None, None, None, None), (9008, "日本語のテキスト 😀 \x00 end", "ja", "ü", 20),
    ]
    return spark.createDataFrame([tuple(r) for r in docs] + odd, SCHEMA)


def labels(spark, docs):
    rows = [(i, i % 2, 0) for i in range(60)] + [(9002, 0, 0), (None, 1, 1), (5, None, None), (6, 1, 1), (77_777, 1, 0)]
    return spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="module")
def odd(spark, sf):
    docs = documents(spark, sf).cache()
    return docs, labels(spark, docs).cache()


def clash(frame):
    for name in CLASHING:
        frame = frame.withColumn(name, F.lit(7))
    return frame


def values(frame):
    return sorted(map(repr, frame.collect()))


@pytest.mark.parametrize("op", sorted(OPERATORS))
def test_odd_rows_have_results(spark, odd, op):
    docs, marks = odd
    got = OPERATORS[op](docs, marks).collect()
    if op not in ("op10", "op13"):
        assert len(got) == docs.count()
    row = {r["doc_id"]: r for r in got} if op != "op13" else {}
    if op == "op1":
        assert all((row[i]["lang_pred"], row[i]["score"]) == ("und", 0.0) for i in (9001, 9002, 9003, 9006))
        assert row[None]["held_out"] is False
    elif op == "op2":
        assert all(row[i]["n_tokens"] == 1 for i in (9001, 9002, 9003))
        assert [r["start"] for r in sorted(got, key=lambda r: r["start"])][0] == 0
        ordered = sorted(got, key=lambda r: r["start"])
        assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1].tolist()
        known = [r["doc_id"] for r in ordered if r["doc_id"] is not None]
        assert known == sorted(known)
    elif op == "op3":
        assert all((row[i]["size"], row[i]["taken"]) == (0, 0) for i in (9001, 9002, 9003))
        assert row[9001]["source_size"] == 0 and row[9001]["target"] == 0.0
    elif op == "op4":
        assert row[9001]["n_tokens"] == 0 and row[9002]["n_tokens"] == 0
        assert all(r["parity"] for r in got)
    elif op == "op5":
        assert row[9001]["score"] == row[9002]["score"] and all(0 <= r["score"] <= 1 for r in got)
    elif op == "op7":
        assert all((row[i]["n_shingles"], row[i]["component_id"], row[i]["kept"]) == (0, i, True) for i in (9001, 9002, 9003))
        assert row[None]["component_id"] is None and row[None]["kept"]
        assert [r["component_id"] for r in got if r["doc_id"] == 9007] == [9007, 9007]
    elif op == "op8":
        assert (row[9001]["n_bytes"], row[9001]["n_tokens"], row[9001]["over_limit"]) == (0, 0, False)
        assert row[9004]["over_limit"]
    elif op == "op9":
        assert all((row[i]["n_words"], row[i]["base_failed"], row[i]["kept"]) == (0, True, False) for i in (9001, 9002, 9003))
    elif op == "op11":
        assert all((row[i]["n_a"], row[i]["n_links"], row[i]["groups_sha256"]) == (0, 0, "") for i in (9001, 9002))
        assert row[9003]["n_groups"] > 0 and row[9008]["n_groups"] > 0
    elif op == "op12":
        assert all((row[i]["n_words"], row[i]["n_hit"], row[i]["contaminated"]) == (0, 0, False) for i in (9001, 9002, 9003))
        assert row[1]["n_hit"] == row[1]["n_words"] > 0 and row[9005]["n_words"] == 1
    elif op == "op13":
        assert {r["lang"] for r in got} >= {"en"} and all(r["l"] >= r["a"] and r["r"] >= r["a"] for r in got)
    elif op == "op10":
        assert not {9001, 9002, 9003, 9005, None} & set(row)


@pytest.mark.parametrize("op", sorted(OPERATORS))
def test_empty_tables_give_empty_results(spark, op):
    docs, marks = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert OPERATORS[op](docs, marks).collect() == []


@pytest.mark.parametrize("op", sorted(OPERATORS))
def test_extra_columns_change_nothing(odd, op):
    docs, marks = odd
    assert values(OPERATORS[op](clash(docs), clash(marks))) == values(OPERATORS[op](docs, marks))


def test_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert pivot_topk.op6(spark.createDataFrame([], schema)).collect() == []
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, None, None), (2, [0.5, 0.5], 1), (2, [0.5, 0.5], 1), (None, [1.0, 1.0], 1), (3, [], 1)]
    got = sorted(map(tuple, pivot_topk.op6(clash(spark.createDataFrame(rows, schema))).collect()))
    assert got == [(0, 1, 2, 256 * 128), (0, 2, 2, 256 * 128)]


def test_no_rows_to_learn_from(spark, odd):
    docs, marks = odd
    assert {r["lang_pred"] for r in langid_crf.op1(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert {r["score"] for r in quality_ftrl.op5(docs, marks.where("false")).collect()} == {0.5}


@pytest.mark.parametrize("case", ["odd", "empty", "clashing"])
def test_stages_take_any_rows(spark, sf, odd, case, tmp_path):
    docs, marks = odd
    if case == "empty":
        docs = docs.where("false")
    elif case == "clashing":
        docs = clash(docs)
    marks.write.parquet(f"{tmp_path}/labels.parquet")
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES, 1):
        after = stage(spark, docs, str(tmp_path))
        if number < len(corpus_pipeline.STAGES):
            assert after.columns == docs.columns
            assert [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        after.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert (docs.count() == 0) == (case == "empty")
