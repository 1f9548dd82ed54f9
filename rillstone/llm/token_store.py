"""Token ids in Parquet list columns that can be read selectively.

`encode` turns texts into ids, `write_store` lays them out in ascending document order with a chosen
encoding, row-group and page size, and `read_metadata` and `read_tokens` read only the columns and,
through row-group statistics and page indexes, only the pages they need. Ids repeat and fit a
dictionary; the ascending document ids and positions are delta encoded.

Defined results: a null text is an empty document that holds only the end id; null document ids come
first; repeated rows are documents of their own, ordered by their text's hash; an empty table
gives an empty store; other columns are not stored.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.llm.common import Workspace
from rillstone.llm.latin_words import LatinWords

END_ID = 2
SLICE_CHARS = 2_000_000
CACHED_WORDS = 600_000
#: Words that are encoded in one call of the library, as lines of one text.
LINES = 64

#: Row groups and pages of a store, and encodings by column.
LAYOUT = {
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(128 << 10),
    "parquet.page.row.count.limit": "512",
    "parquet.writer.version": "PARQUET_2_0",
}
ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "false", "parquet.enable.dictionary#ids.list.element": "true"},
    "delta": {"parquet.enable.dictionary": "false"},
}

STORE = T.StructType(
    [
        T.StructField("block", T.IntegerType()),
        T.StructField("pos", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)


def in_worker(key: tuple, make: Callable):
    """What `make` returns, made once for each Python worker: workers outlive tasks, functions don't.

    A worker keeps only what it was last asked for.
    """
    home = sys.modules.setdefault("_rillstone_llm_worker", types.ModuleType("_rillstone_llm_worker"))
    if key not in home.__dict__.setdefault("made", {}):
        home.made.clear()
        home.made[key] = make()
    return home.made[key]


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def without_cuts(tokenizer):
    """The tokenizer for parts that are already lower-cased and cut, one a line: it only writes bytes as letters."""
    from tokenizers import Tokenizer

    rules = json.loads(tokenizer.to_str())
    steps = rules["pre_tokenizer"]["pretokenizers"]
    kinds = [s["type"] for s in rules["normalizer"]["normalizers"]]
    if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
        raise ValueError("this store's tokenizers lower-case, drop white space and merge bytes of words")
    lines = {"type": "Split", "pattern": {"String": "\n"}, "behavior": "Removed", "invert": False}
    steps = {"type": "Sequence", "pretokenizers": [lines, steps[1]]}
    return Tokenizer.from_str(json.dumps(rules | {"normalizer": None, "pre_tokenizer": steps}))


def last_tokens(tokenizer) -> np.ndarray:
    """Of each id, whether its token ends a word; there is none where the model doesn't mark the ends."""
    suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix")
    vocabulary = tokenizer.get_vocab()
    last = np.zeros(max(vocabulary.values()) + 1, bool)
    if suffix:
        last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
    return last


def encode_each(tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one after the other, and how many each has."""
    found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return np.fromiter(chain.from_iterable(found), "<i4"), np.fromiter(map(len, found), np.int64, len(found))


class WordIds:
    """Ids of texts as the tokenizer gives them, with a dictionary of the words it has encoded.

    The tokenizer lower-cases, drops white space, and cuts a text into contractions, letters, digits
    and the rest; no token spans a cut. A text of printable Latin characters without special strings
    is cut likewise here, by its bytes where it has one for each character and no very wide word.
    Any other text is cut at white space only. Either kind of part is encoded by the library once,
    and a text's ids are those of its parts in order. Parts cut here go to the library as lines of
    one text, where the tokens that end a word tell them apart.
    """

    OTHER = re.compile(r"[^\t\n\r -~¡-¬®-įı-ſ]")
    LATIN = bytes([9, 10, 13, *range(32, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)])
    LETTERS = "a-zªµºÀ-ÖØ-öø-ſ"
    NUMBERS = "0-9²³¹¼½¾"
    CUT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bare = without_cuts(self.tokenizer)
        self.last = last_tokens(self.bare)
        self.latin = LatinWords(self.encode_lines)
        self.known: dict[str | bytes, bytes] = {}

    def encode_lines(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lines = ["\n".join(parts[i : i + LINES]) for i in range(0, len(parts), LINES)]
        ids, _ = encode_each(self.bare, lines)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(parts) or ends[-1] != len(ids):  # the model doesn't mark every word's end
            return encode_each(self.bare, parts)
        return ids, np.diff(ends, prepend=0)

    def bytes_of(self, text: str) -> bytes | None:
        """The lower-cased text, one byte a character, if it holds nothing but what is cut by bytes."""
        try:
            data = text.lower().encode("latin-1")
        except UnicodeEncodeError:
            return None
        return None if data.translate(None, self.LATIN) or any(s in text for s in self.special) else data

    def parts(self, text: str) -> list:
        if self.OTHER.search(text) or any(s in text for s in self.special):
            return text.encode().split()
        return self.CUT.findall(text.lower())

    def by_parts(self, texts: list[str]) -> list[bytes]:
        cut = [self.parts(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        cuts, words = [p for p in new if isinstance(p, str)], [p for p in new if isinstance(p, bytes)]
        for tokenizer, parts, strings in ((self.bare, cuts, cuts), (self.tokenizer, words, [w.decode() for w in words])):
            found = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
            self.known.update((p, np.array(e.ids, "<i4").tobytes()) for p, e in zip(parts, found))
        ids = self.known.__getitem__
        return [b"".join(map(ids, ps)) for ps in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.latin) + len(self.known) > CACHED_WORDS:
            self.latin.clear()
            self.known.clear()
        plain = [self.bytes_of(t) for t in texts]
        found = iter(self.latin.of([p for p in plain if p is not None]))
        ids = [None if p is None else next(found) for p in plain]
        left = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(left, self.by_parts([texts[i] for i in left])):
            ids[i] = x
        return ids


def slices(batch: pa.RecordBatch, text: str | int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch that hold a bounded number of characters, or one text."""
    texts = [t or "" for t in batch.column(text).to_pylist()]
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > SLICE_CHARS:
            yield batch.slice(start, i - start), texts[start:i]
            start, size = i, 0
        size += len(t)
    if len(texts) > start:
        yield batch.slice(start), texts[start:]


def id_lists(parts: list[bytes]) -> pa.ListArray:
    values = pa.array(np.frombuffer(b"".join(parts), "<i4"))
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def encode(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Documents in the order of their ids with their token ids, in blocks of one partition each."""
    end = np.array([end_id], "<u4").tobytes()
    # sized by Spark: adaptive execution joins small ranges
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = in_worker(("word ids", path), lambda: WordIds(path))
        block, pos = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part, texts in slices(batch, "text"):
                parts = [ids + end for ids in words.encode(texts)]
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, block, np.int32)),
                        pa.array(np.arange(pos, pos + n)),
                        part.column("doc_id").cast(pa.int64()),
                        pa.array([len(p) // 4 for p in parts], pa.int64()),
                        id_lists(parts),
                    ],
                    names=STORE.fieldNames(),
                )
                pos += n

    return ordered.mapInArrow(encoded, STORE)


def write_store(encoded: DataFrame, path: str, encoding: str = "dictionary", layout: dict = LAYOUT) -> None:
    encoded.write.mode("overwrite").options(**layout, **ENCODINGS[encoding]).parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Per document its block, position, length and first token's place in the whole store.

    Reads no token. Lengths are summed within blocks; of the blocks, only their totals meet.
    """
    meta = read_store(spark, path).drop("ids")
    totals = meta.groupBy("block").agg(F.sum("n_tokens").alias("total"))
    ahead = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("block", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (
        meta.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(starts, "block")
        .select("block", "pos", "doc_id", "n_tokens", (F.col("base") + F.col("inside")).alias("start"))
    )


def read_tokens(spark: SparkSession, path: str, first_doc: int, last_doc: int) -> DataFrame:
    """Documents of a range of ids; only row groups and pages that may hold them are read."""
    return read_store(spark, path).where(F.col("doc_id").between(first_doc, last_doc)).select("doc_id", "ids")


def id_checksums(store: DataFrame) -> DataFrame:
    """crc32 of each document's ids as little-endian unsigned 32-bit integers."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4").view(np.uint8))
            ends = (4 * lists.offsets.to_numpy()).tolist()
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("pos"), pa.array(sums, pa.int64())],
                names=["block", "pos", "ids_crc32"],
            )

    return store.select("block", "pos", "ids").mapInArrow(summed, "block int, pos long, ids_crc32 long")


def op2(docs: DataFrame, path: str, encoding: str = "dictionary") -> DataFrame:
    """The contract's columns, all from the files written."""
    spark = docs.sparkSession
    files = f"{Workspace(spark, 'tokens').path}/store"
    write_store(encode(docs, path), files, encoding)
    return read_metadata(spark, files).join(id_checksums(read_store(spark, files)), ["block", "pos"]).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )
