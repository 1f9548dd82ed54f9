"""The queries of this subpackage and the SQL that those expressible in SQL are checked against."""

from __future__ import annotations

import public_tokenizers

from rillstone.llm import collocations, langid_crf, minhash_join, mixing, phrase_index, pivot_topk, quality_ftrl, rule_ledger, sentence_spans, sentencepiece_backend, token_alignment, token_store, whole_tokens
from rillstone.llm.common import table

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES = {
    "op1_langid_crf": lambda spark, sf: langid_crf.op1(table(spark, sf, "documents")),
    "op2_token_store": lambda spark, sf: token_store.op2(table(spark, sf, "documents"), WORD_VOCABULARY),
    "op3_mix_sources": lambda spark, sf: mixing.op3(table(spark, sf, "documents")),
    "op4_sentencepiece": lambda spark, sf: sentencepiece_backend.op4(table(spark, sf, "documents"), PIECES),
    "op5_quality_ftrl": lambda spark, sf: quality_ftrl.op5(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op6_pivot_topk": lambda spark, sf: pivot_topk.op6(table(spark, sf, "embeddings")),
    "op7_minhash_join": lambda spark, sf: minhash_join.op7(table(spark, sf, "documents")),
    "op8_token_counts": lambda spark, sf: whole_tokens.op8(table(spark, sf, "documents"), BYTE_VOCABULARY),
    "op10_sentence_spans": lambda spark, sf: sentence_spans.op10(table(spark, sf, "documents")),
    "op9_rule_ledger": lambda spark, sf: rule_ledger.op9(table(spark, sf, "documents")),
    "op13_collocations": lambda spark, sf: collocations.op13(table(spark, sf, "documents")),
    "op11_token_alignment": lambda spark, sf: token_alignment.op11(table(spark, sf, "documents"), BYTE_VOCABULARY, PIECES),
    "op12_phrase_index": lambda spark, sf: phrase_index.op12(table(spark, sf, "documents"), table(spark, sf, "benchmark")),
}

ORACLES = {
    "op3_mix_sources": mixing.ORACLE,
    "op6_pivot_topk": pivot_topk.ORACLE,
    "op9_rule_ledger": rule_ledger.ORACLE,
    "op12_phrase_index": phrase_index.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
