"""Substring dedup by sliding spans of sentences.

Every run of `run` consecutive sentences is hashed; runs are joined over all documents, and the
sentences of every run that occurred before (in a document of smaller id, or earlier in the same
one) are removed. Sentences end at . ! ? before white space and at line ends. Away from these ends
they are cut at words picked by a hash of the words around them, and have at most `longest` words, so
a passage has the same pieces at any place in a long sentence. What is lost of it is at most
the piece at each end that it shares with the text around it, and a few words more. Pieces so
short that runs would have fewer than `min_words` words (lists, verse) are joined, again where the
content says so, as shorter phrases recur by chance; only at the ends of a text, or beside a short
sentence between longer ones, may a shorter run be left out. For the same reason a stretch of repeated sentences
with fewer than `STRETCH` words stays. Letter case and white space don't
matter to a comparison.

Each document posts a hash once, with the times it holds it. Hashes are counted with partial sums
before the shuffle, and only those met twice are joined back, where adaptive execution splits a
frequent one. Hashes have 64 bits: among n runs, n * n / 2 ** 65 pairs of different runs are
expected to be taken for equal.

Defined results: null and empty texts and texts with fewer sentences than a run stay as they are;
rows with a null id post nothing and lose nothing; rows that share an id count as one document, so
none is a repeat of another; a document that repeats as a whole becomes empty; extra columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.llm.common import WordHashes, Workspace, mixed, run_hashes

RUN = 3
LONGEST = 16
MIN_WORDS = 10
STRETCH = 16

END = re.compile(r"(?<=[.!?])\s+|\s*\n\s*")
WORD = re.compile(r"\S+\s*")

# Between cuts inside a sentence lie over REACH words, between one and a sentence's end at least APART.
REACH = 3
APART = 5

HASHES = WordHashes(100_000)
LAST = np.uint64(2**64 - 1)

SPANS = "doc_id long, span long, times int"


def lowest(keys: np.ndarray, at: np.ndarray, reach: int) -> np.ndarray:
    """Those of the sorted places `at` with the lowest key within `reach` words, one of equal ones."""
    some = np.full(len(keys), LAST)
    some[at] = keys[at]
    low = some.copy()
    for k in range(1, reach + 1):
        np.minimum(low[k:], some[:-k], out=low[k:])
        np.minimum(low[:-k], some[k:], out=low[:-k])
    at = at[some[at] == low[at]]
    if len(at) < 2 or np.diff(at).min() > reach:
        return at
    kept = [-reach - 1]
    for i in at.tolist():
        if i - kept[-1] > reach:
            kept.append(i)
    return np.array(kept[1:], np.int64)


def joined(edges: np.ndarray, keys: np.ndarray, run: int, min_words: int) -> np.ndarray:
    """The cuts without some of those between short pieces, so that runs have `min_words` words.

    Of the cuts inside short runs those with the lowest hash within a reach stay, which again depends
    on the words around them only. Short runs stay where longer ones hold all of their pieces, as
    around a single short sentence, and at the ends of a text.
    """
    reach = REACH
    while len(edges) > run:
        short = edges[run:] - edges[:-run] < min_words
        if not short.any():
            break
        if short.all():
            hurt = short
        else:
            alone = np.ones(max(len(short) - run + 1, 0), bool)  # pieces of which all runs are short
            for k in range(run):
                alone &= short[k : k + len(alone)]
            hurt = np.zeros(len(short), bool)
            for k in range(run):
                hurt[k : k + len(alone)] |= alone
            if not hurt.any():
                break
        crowded = np.zeros(len(edges), bool)
        for k in range(1, run):
            crowded[k : k + len(hurt)] |= hurt
        if not crowded.any():
            break
        kept = lowest(keys, edges[crowded] - 1, reach) + 1
        edges = np.sort(np.concatenate([edges[~crowded], kept]))
        reach += 1
    return edges


def cuts(words: list[str], stops: np.ndarray, text: str, run: int, longest: int, min_words: int) -> np.ndarray:
    """Number of words before each cut of a text, from 0 to all of them.

    Cuts are the ends of sentences and, `APART` words or more from these, words with the lowest
    hash among the `REACH` words on both sides. So a cut depends on the few words around it only,
    and a passage is cut alike wherever it stands. A stretch of over `longest` words is cut again at
    its lowest hash.
    """
    n = len(words)
    if not n:
        return np.zeros(1, np.int64)
    ended = np.array([m.end() for m in END.finditer(text)], np.int64)
    sentence = np.isin(stops, ended)
    sentence[-1] = True
    hashes = HASHES.of(words)
    keys = hashes.copy()
    keys[1:] += hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)
    keys = mixed(keys) >> np.uint64(1)
    keys[~sentence] |= np.uint64(1 << 63)  # ends of sentences come before other words
    near = sentence.copy()
    for k in range(1, APART):
        near[k:] |= sentence[:-k]
        near[:-k] |= sentence[k:]
    near[: APART - 1] = True
    inner = np.flatnonzero(~near)
    if len(inner):
        sentence[lowest(keys, inner, REACH)] = True
    edges = np.concatenate([[0], np.flatnonzero(sentence) + 1])
    if n >= min_words:
        edges = joined(edges, keys, run, min_words)
    wide = np.flatnonzero(np.diff(edges) > longest)
    if not len(wide):
        return edges
    more, todo = [], list(zip(edges[wide].tolist(), edges[wide + 1].tolist()))
    while todo:
        a, b = todo.pop()
        if b - a > longest:
            away = min(APART, longest // 2)
            at = a + away + int(keys[a + away - 1 : b - away].argmin())
            more.append(at)
            todo += [(a, at), (at, b)]
    return np.sort(np.concatenate([edges, more]))


class Sentences:
    """A text's sentences: where each ends, its number of words, and the hashes of all runs."""

    def __init__(self, text: str, run: int, longest: int, min_words: int):
        words = text.lower().split()
        stops = np.array([m.end() for m in WORD.finditer(text)], np.int64)
        edges = cuts(words, stops, text, run, longest, min_words)
        self.ends: list[int] = stops[edges[1:] - 1].tolist()
        self.run = run
        self.sizes = np.diff(edges)
        if len(self.sizes) < run:
            self.spans, self.long = np.empty(0, np.int64), np.empty(0, bool)
            return
        at = edges.tolist()
        hashes = [xxhash.xxh3_64_intdigest(" ".join(words[a:b])) for a, b in zip(at, at[1:])]
        self.spans = run_hashes(np.array(hashes, np.uint64), run).view(np.int64)
        self.long = edges[run:] - edges[:-run] >= min_words

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.spans[self.long], return_counts=True)

    def covered(self, later: list[int]) -> np.ndarray:
        """Which sentences lie in a run that is in `later` or occurred before in this text."""
        marks = np.zeros(len(self.ends), bool)
        if not len(self.spans):
            return marks
        first = np.zeros(len(self.spans), bool)
        first[np.unique(np.where(self.long, self.spans, 0), return_index=True)[1]] = True
        repeat = self.long & (~first | np.isin(self.spans, np.array(later, np.int64)))
        for k in range(self.run):
            marks[k : k + len(repeat)] |= repeat
        edges = np.flatnonzero(np.diff(marks.astype(np.int8), prepend=0, append=0))
        for a, b in zip(edges[::2], edges[1::2]):
            if self.sizes[a:b].sum() < STRETCH:
                marks[a:b] = False
        return marks

    def without(self, text: str, marks: np.ndarray) -> str:
        starts = [0, *self.ends[:-1]]
        return "".join(text[a:b] for a, b, gone in zip(starts, self.ends, marks.tolist()) if not gone)


def post(docs: DataFrame, run: int, longest: int, min_words: int) -> DataFrame:
    """Each document's hashes with the times it holds them."""

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spans, times = [], [], []
            size = 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found, n = Sentences(text, run, longest, min_words).counted()
                ids.append(np.full(len(found), doc_id, np.int64))
                spans.append(found)
                times.append(n.astype(np.int32))
                size += len(found)
                if size > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, spans, times)], names=["doc_id", "span", "times"])
                    ids, spans, times, size = [], [], [], 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (ids, spans, times)], names=["doc_id", "span", "times"])

    some = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return some.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(posted, SPANS)


def repeats(docs: DataFrame, run: int = RUN, longest: int = LONGEST, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents that lose sentences: doc_id, `later` (hashes seen in documents before), first_doc_ids."""
    work = Workspace(docs.sparkSession, "spans")
    spans = work.store(post(docs, run, longest, min_words), "posted")
    known = (
        spans.groupBy("span").agg(F.min("doc_id").alias("first_doc"), F.sum("times").alias("n"))
        .where("n > 1").drop("n")
    )
    later = F.col("doc_id") > F.col("first_doc")
    hits = spans.join(known, "span").where(later | (F.col("times") > 1))
    found = hits.groupBy("doc_id").agg(
        F.collect_list(F.when(later, F.col("span"))).alias("later"),
        F.sort_array(F.collect_set("first_doc")).alias("first_doc_ids"),
    )
    found = work.store(found, "found")
    work.drop("posted")
    return found


def cut(docs: DataFrame, run: int = RUN, longest: int = LONGEST, min_words: int = MIN_WORDS, touched_only: bool = False) -> DataFrame:
    """The documents with repeats removed, and `n_sentences`, `n_removed`, `words_removed`, `first_doc_ids`.

    With `touched_only`, only the documents that lose something.
    """
    found = repeats(docs, run, longest, min_words)
    row = F.struct(*[F.col(c) for c in docs.columns])
    packed = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = packed.join(found, "doc_id", "inner" if touched_only else "left")
    report = T.StructType(
        [
            T.StructField("row", T.StructType([f for f in docs.schema if f.name != "text"])),
            T.StructField("text", T.StringType()),
            T.StructField("n_sentences", T.IntegerType()),
            T.StructField("n_removed", T.IntegerType()),
            T.StructField("words_removed", T.LongType()),
            T.StructField("first_doc_ids", T.ArrayType(T.LongType())),
        ]
    )

    def done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            later = batch.column("later")
            for i, text in enumerate(batch.column("text").to_pylist()):
                if text is None or not later[i].is_valid:
                    texts.append(text)
                    counts.append((None, 0, 0))
                    continue
                sentences = Sentences(text, run, longest, min_words)
                marks = sentences.covered(later[i].as_py())
                texts.append(sentences.without(text, marks) if marks.any() else text)
                counts.append((len(marks), int(marks.sum()), int(sentences.sizes[marks].sum())))
            n, removed, words = zip(*counts) if counts else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rest"), pa.array(texts, pa.string()), pa.array(n, pa.int32()),
                    pa.array(removed, pa.int32()), pa.array(words, pa.int64()), batch.column("first_doc_ids"),
                ],
                names=report.fieldNames(),
            )

    rest = F.struct(*[F.col("row")[c].alias(c) for c in docs.columns if c != "text"])
    return packed.select(rest.alias("rest"), "text", "later", "first_doc_ids").mapInArrow(done, report)


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """The documents, in their own columns, without repeated sentences; those left empty are dropped."""
    done = cut(docs, **options).where((F.col("n_removed") == 0) | F.col("text").rlike("\\S"))
    kept = [F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return done.select(*kept)


def op10(docs: DataFrame) -> DataFrame:
    """One row per document that loses sentences, with what is left of its text.

    Columns: doc_id, first_doc_ids (where its repeats occur first), n_sentences, n_removed,
    words_removed, text.
    """
    return cut(docs, touched_only=True).where("n_removed > 0").select(
        F.col("row.doc_id").alias("doc_id"), "first_doc_ids", "n_sentences", "n_removed", "words_removed", "text"
    )
