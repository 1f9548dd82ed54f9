"""From raw documents to token ids: quality, near copies, repeated passages, mix, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the
last return the columns of `documents`.

1. quality: documents that the classifier scores under 0.5 go.
2. near_dedup: of each component of near copies (five-word shingles, similarity 0.8) one stays.
3. substring_dedup: sentences of passages seen before are cut out, and `n_chars` follows the text.
4. mix: documents are repeated or left out so that each source meets its target; they stay whole.
5. encode: every document's ids, by the tokenizers library.

Every stage gives an empty table for an empty one; null texts score as empty ones do, have no
near copies, lose nothing, have size 0 in the mix, and encode to
no ids. Null ids and repeated rows follow the rules of each operator.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm import minhash_join, mixing, quality_ftrl, sentence_spans, sentencepiece_backend
from rillstone.llm.common import Workspace, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_ftrl.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_join.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = sentence_spans.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return kept
    kind = docs.schema["n_chars"].dataType
    return kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = tuple(c for c in ("doc_id", "lang", "source") if c in docs.columns)
    encoded = sentencepiece_backend.encode(docs, PIECES, keep=kept)
    return encoded.select(*kept, F.size("ids").alias("n_tokens"), "ids", "parity")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix", mix),
    ("encode", encode),
]

# The classifier, the signatures and the tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; what each returns is written to the shared folder and read again."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = work.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
