"""Alignment of two tokenizers' tokens by merge-path partitioning.

Both tokenizers cut the same bytes. Where a token of each ends at one byte, their texts agree so far,
and the tokens since the last such byte form a group. Finding these bytes is a merge of two ascending
lists of ends. `merge_path` cuts the merge into pieces of equal work, however the ends are dealt
over documents and lists: on each diagonal of the merge grid a binary search tells how many ends of
A lie before it. A piece is a slice of both lists and gives its common ends on its own; an end of A
that closes a piece and an end of B that opens the next may be one, so neighbours are stitched.
The ends of many documents are one list, as a document's last end is common; a very long text is many
pieces and a thousand short ones are one.

How often an id pair ends together in the corpus is counted from pairs already added up per
document and task. Pairs with at least one in `HOT` of all links are at most `HOT`, so these are sent to all
executors; documents meet the counts of the other pairs in a join, in which no pair is frequent.

Texts are cut before spaces (and line breaks) where neither tokenizer has a token across, which is proven
from the vocabularies; each distinct part is encoded once per worker. Other vocabularies get whole texts.

Defined results: null and empty texts, and texts that a tokenizer doesn't give back byte for byte (for
example with U+2581), have no tokens, zeros, and '' for the hash; repeated rows and null ids are judged row by row and
count in the corpus row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import Workspace
from rillstone.llm.sentencepiece_backend import BYTE, MARK, NORMAL, USER, Model, read_model
from rillstone.llm.token_store import CACHED_WORDS, in_worker, load_tokenizer, slices
from rillstone.llm.whole_tokens import byte_letters

PIECE = 1 << 16
HOT = 1_000_000
HELD_PAIRS = 2_000_000

ALIGNED = "row long, doc_id {}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, counts array<int>"


def merge_path(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each piece of `work` steps begins in two ascending lists; of equal values, A's comes first."""
    diagonal = np.minimum(np.arange(0, len(a) + len(b) + work, work), len(a) + len(b))
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        at = (low + high) >> 1
        ahead = np.zeros(len(at), bool)
        ahead[open_] = a[at[open_]] <= b[diagonal[open_] - 1 - at[open_]]
        low, high = np.where(open_ & ahead, at + 1, low), np.where(open_ & ~ahead, at, high)
    return low, diagonal - low


def common_ends(a: np.ndarray, b: np.ndarray, work: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in either list of the values that both hold; each list's values differ."""
    starts_a, starts_b = merge_path(a, b, work)
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, i_end, j, j_end in zip(starts_a[:-1], starts_a[1:], starts_b[:-1], starts_b[1:]):
        at = np.searchsorted(b[j:j_end], a[i:i_end])
        same = np.flatnonzero(at < j_end - j)
        same = same[b[j + at[same]] == a[i + same]]
        found_a.append(i + same)
        found_b.append(j + at[same])
        # the last end of A here and the first of B in the next piece
        if i < i_end and j_end < len(b) and a[i_end - 1] == b[j_end]:
            found_a.append(np.array([i_end - 1]))
            found_b.append(np.array([j_end]))
    return np.concatenate(found_a), np.concatenate(found_b)


def decimals(size: int) -> np.ndarray:
    """Per id its digits as bytes, then a comma, then zeros."""
    width = len(str(max(size - 1, 1))) + 1
    return np.array([f"{i},".encode() for i in range(size)], f"S{width}").view(np.uint8).reshape(size, width)


class Sides:
    """Both tokenizers in one Python worker."""

    def __init__(self, byte_path: str, model: bytes):
        import sentencepiece

        self.a = load_tokenizer(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            known = all(c in letters for c in piece)
            self.bytes_a[i] = bytes(letters[c] for c in piece) if known else piece.encode()
        parsed = Model.parse(model)
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(MARK, " ").encode()
            for piece, _, kind in parsed.pieces
        ]
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        width = max(len(str(len(self.bytes_a))), len(str(len(self.bytes_b)))) + 1
        self.decimals = [
            np.pad(table, ((0, 0), (0, width - table.shape[1]))) for table in (decimals(len(self.bytes_a)), decimals(len(self.bytes_b)))
        ]
        self.digits = [(table != 0).sum(axis=1) - 1 for table in self.decimals]
        self.mark = next((i for i, (piece, _, _) in enumerate(parsed.pieces) if piece == MARK), None)
        self.part = self.parts_pattern(parsed)
        self.known_a: dict[str, bytes] = {}
        self.known_b: dict[str, bytes] = {}
        self.differ: set[str] = set()

    def parts_pattern(self, model: Model) -> re.Pattern | None:
        """Cuts before spaces behind other characters, and before line breaks of which no piece of B holds one.

        A's pattern begins a new part at white space behind a character of another kind. What Python or
        Unicode may call white space counts as such here, so it is only cut where both agree.
        """
        rules = json.loads(self.a.to_str())
        steps = rules["pre_tokenizer"] or {}
        plain = steps.get("type") == "ByteLevel" and steps.get("use_regex", True) and not steps.get("add_prefix_space")
        if not plain or rules["normalizer"] or self.mark is None or not model.cuts_at_marks():
            return None
        if not (model.dummy_prefix and model.escape):
            return None
        pieces = [piece for piece, _, kind in model.pieces if kind in (NORMAL, USER)]
        hard = "".join(c for c in "\t\n\x0b\x0c\r" if not any(c in piece for piece in pieces))
        white = "\\s\\x1c-\\x1f\\x85\\u180e\\ufeff"
        soft = f"[^\\S {hard}]|[\\x1c-\\x1f\\x85\\u180e\\ufeff]"
        return re.compile(f"[{white}]*[^{white}]+(?:(?:{soft})[{white}]*(?:[^{white}]+|\\Z))*|[{white}]+")

    def learn(self, parts: list[str]) -> None:
        found_a = self.a.encode_batch_fast(parts, add_special_tokens=False)
        # the model puts a space before what it is given
        found_b = self.b.encode([p[1:] if p[0] == " " else p for p in parts])
        for part, a, b in zip(parts, found_a, found_b):
            if part == " ":
                b = [self.mark]
            elif part[0] != " ":
                b = b[1:] if b[0] == self.mark else []  # [] where the space wasn't on its own
            raw = part.encode()
            self.known_a[part], self.known_b[part] = array("i", a.ids).tobytes(), array("i", b).tobytes()
            if b"".join(map(self.bytes_a.__getitem__, a.ids)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
                self.differ.add(part)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Each text's ids by A and by B; none where they don't give the text back."""
        if self.part is None:
            cut = [[" " + t] if t else [] for t in texts]
        else:
            cut = [self.part.findall(" " + t) if t else [] for t in texts]
        if len(self.known_a) > CACHED_WORDS:
            self.known_a.clear()
            self.known_b.clear()
            self.differ.clear()
        new = list(set().union(*cut).difference(self.known_a))
        if new:
            self.learn(new)
        a, b = self.known_a.__getitem__, self.known_b.__getitem__
        return [
            (b"".join(map(a, ps)), b"".join(map(b, ps))) if self.differ.isdisjoint(ps) else (b"", b"") for ps in cut
        ]

    def align(self, texts: list[str], pair_bits: tuple[int, int]) -> dict[str, np.ndarray | list]:
        """Counts, group texts' hashes and added-up id pairs of each text."""
        encoded = self.encode(texts)
        n_a = np.array([len(a) // 4 for a, _ in encoded])
        n_b = np.array([len(b) // 4 for _, b in encoded])
        ids_a = np.frombuffer(b"".join(a for a, _ in encoded), np.int32)
        ids_b = np.frombuffer(b"".join(b for _, b in encoded), np.int32)
        at_a, at_b = common_ends(np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b]))
        n_groups = np.diff(np.searchsorted(at_a, np.cumsum(n_a)), prepend=0)
        hashes = self.group_hashes(ids_a, ids_b, at_a, at_b, n_a, n_b)
        # a text's equal pairs come together when sorted with the text's number in front
        bits = sum(pair_bits)
        pairs = (ids_a[at_a].astype(np.int64) << pair_bits[1]) | ids_b[at_b]
        keys = np.sort((np.repeat(np.arange(len(texts)), n_groups) << bits) | pairs)
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        per_text = np.bincount(keys[starts] >> bits, minlength=len(texts))
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "hashes": hashes, "ends": np.cumsum([0, *per_text]),
            "pairs": keys[starts] & ((1 << bits) - 1), "counts": np.diff(starts, append=len(keys)),
        }

    def group_hashes(self, ids_a, ids_b, at_a, at_b, n_a, n_b) -> list[str]:
        """sha256 of each text's groups written as `a,a|b;a|b,b`.

        Every id is a row of digits and what follows it; zeros are left out of the text.
        """
        sizes_a, sizes_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        to_a = np.arange(len(ids_a)) + np.repeat(at_b + 1 - sizes_b, sizes_a)
        to_b = np.arange(len(ids_b)) + np.repeat(at_a + 1, sizes_b)
        out = np.empty((len(ids_a) + len(ids_b), self.decimals[0].shape[1]), np.uint8)
        out[to_a], out[to_b] = self.decimals[0][ids_a], self.decimals[1][ids_b]
        out[to_a[at_a], self.digits[0][ids_a[at_a]]] = ord("|")
        out[to_b[at_b], self.digits[1][ids_b[at_b]]] = ord(";")
        lasts = (np.cumsum(n_a) + np.cumsum(n_b) - 1)[n_b > 0]
        flat = out.ravel()
        flat = flat[flat != 0].tobytes()
        sizes = (out != 0).sum(axis=1, dtype=np.int32)
        ends = iter(np.cumsum(sizes, dtype=np.int64)[lasts].tolist())
        hashes, start = [], 0
        for n in n_b.tolist():
            if not n:
                hashes.append("")
                continue
            end = next(ends)
            hashes.append(hashlib.sha256(memoryview(flat)[start : end - 1]).hexdigest())  # without the last semicolon
            start = end
        return hashes


def lists(ends: np.ndarray, values: np.ndarray, kind: type) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(kind)))


def aligned(docs: DataFrame, byte_path: str, model: bytes, pair_bits: tuple[int, int]) -> DataFrame:
    """A row per document with its counts and its different id pairs that end together."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "counts"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = in_worker(("sides", byte_path, len(model)), lambda: Sides(byte_path, model))
        for batch in batches:
            for part, texts in slices(batch, "text"):
                got = sides.align(texts, pair_bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("doc_id"),
                        *(pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups")),
                        pa.array(got["hashes"], pa.string()),
                        lists(got["ends"], got["pairs"], np.int64), lists(got["ends"], got["counts"], np.int32),
                    ],
                    names=names,
                )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return numbered.mapInArrow(align, ALIGNED.format(kind))


def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of a batch, their counts, and how many each row has."""
    pairs, counts = batch.column("pairs"), batch.column("counts")
    return pairs.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64), np.diff(pairs.offsets.to_numpy())


def added(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    different, place = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(different), np.int64)
    np.add.at(total, place, counts)
    return different, total


def pair_counts(rows: DataFrame, bits_b: int) -> DataFrame:
    """Per id pair its links in the corpus (`n`) and whether no pair of its B id has more (`best`)."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64), np.empty(0, np.int64))
        for batch in batches:
            pairs, counts, _ = flat(batch)
            held = added(np.concatenate([held[0], pairs]), np.concatenate([held[1], counts]))
            if len(held[0]) > HELD_PAIRS:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["pair", "n"])
                held = (np.empty(0, np.int64), np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["pair", "n"])

    each = rows.select("pairs", "counts").mapInArrow(add_up, "pair long, n long")
    return each.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << bits_b) - 1)))


def with_best(counts: DataFrame) -> DataFrame:
    tops = counts.groupBy("b").agg(F.max("n").alias("top"))
    return counts.join(tops, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def with_hot_sums(rows: DataFrame, hot: tuple) -> DataFrame:
    """The rows with `n_best` and `count_sum` of their hot pairs."""
    kept = [f for f in rows.schema.fields if f.name not in ("pairs", "counts")]
    names = [*(f.name for f in kept), "n_best", "count_sum"]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "n_best long", "count_sum long"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs_known, n_known, best_known = hot.value
        for batch in batches:
            pairs, counts, sizes = flat(batch)
            at, known = among(pairs_known, pairs)
            sums = []
            for worth in (best_known, n_known):
                total = np.zeros(len(pairs) + 1, np.int64)
                np.cumsum(np.where(known, counts * worth[at], 0) if len(worth) else counts * 0, out=total[1:])
                ends = np.cumsum([0, *sizes])
                sums.append(pa.array(total[ends[1:]] - total[ends[:-1]]))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), *sums], names=names)

    return rows.mapInArrow(add_up, schema)


def among(known: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each pair would stand in the known ones, and whether it does."""
    at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
    return at, (known[at] == pairs) if len(known) else np.zeros(len(pairs), bool)


def other_pairs(rows: DataFrame, hot: tuple) -> DataFrame:
    """(`row`, `pair`, `c`) of all pairs that aren't hot."""

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, counts, sizes = flat(batch)
            left = ~among(hot.value[0], pairs)[1]
            row = np.repeat(batch.column("row").to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(x[left]) for x in (row, pairs, counts)], names=["row", "pair", "c"])

    return rows.select("row", "pairs", "counts").mapInArrow(rest, "row long, pair long, c long")


def alignment(docs: DataFrame, byte_path: str, piece_path: str, hot_pairs: int = HOT) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    work = Workspace(spark, "alignment")
    model = read_model(piece_path)
    n_a = load_tokenizer(byte_path).get_vocab_size(with_added_tokens=True)
    pair_bits = (n_a.bit_length(), len(Model.parse(model).pieces).bit_length())
    delta = {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"}
    rows = work.store(aligned(docs, byte_path, model, pair_bits), "aligned", **delta)
    counts = work.store(with_best(work.store(pair_counts(rows, pair_bits[1]), "counts")), "pairs")
    links = counts.agg(F.sum("n")).first()[0] or 0
    # at most `hot_pairs` pairs can have that share of all links
    is_hot = F.col("n").cast("decimal(20,0)") * hot_pairs >= F.lit(links)
    found = counts.where(is_hot).toArrow()
    order = np.argsort(found.column("pair").to_numpy())
    hot = tuple(found.column(c).to_numpy()[order] for c in ("pair", "n", "best"))
    hot = spark.sparkContext.broadcast(hot)
    rest = other_pairs(rows, hot).join(counts.where(~is_hot), "pair").groupBy("row").agg(
        F.sum(F.col("c") * F.col("n")).alias("rest_sum"), F.sum(F.when(F.col("best"), F.col("c")).otherwise(0)).alias("rest_best")
    )
    return with_hot_sums(rows, hot).join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("rest_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rest_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def op11(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """The contract's columns."""
    return alignment(docs, byte_path, piece_path)
