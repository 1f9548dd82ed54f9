"""SentencePiece encoding and decoding with the tokenizers library.

The model file is parsed here; its normaliser, white-space marker, pieces, scores and byte fallback
are rebuilt as a tokenizer, for unigram and for pair-merge models. Where the pieces prove that no
token can span the start of a word, texts are cut there and each distinct part is encoded once per
worker, in multithreaded batches. Ids are those of the rebuilt tokenizer. Each part's ids are compared
with those of the sentencepiece library when it is first met, and documents with a part on which both
differ are reported. One kind of part is known beforehand to be rebuilt wrongly and is left to
sentencepiece: with unigram models, parts that hold the name of a control, unknown or byte piece, which the tokenizers
library's core takes for the piece itself.

Defined results: null texts stay null when decoded and have no ids; empty texts have no ids; lone
spaces, unknown characters and long texts are encoded whole; repeated rows and null ids are encoded row
by row; other columns are passed through if named.
"""

from __future__ import annotations

import base64
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rillstone.llm.token_store import CACHED_WORDS, id_lists, in_worker, slices

#: Parts that are decoded in one call of the library.
TOGETHER = 64

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # fixed values: kinds of pieces
UNIGRAM, MERGES = 1, 2  # fixed values: kinds of models


def fields(message: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield number, message[at : at + size]
        at += size


@dataclass
class Model:
    """What a SentencePiece model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    unk_id: int = 0
    byte_fallback: bool = False
    suffix: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    single_spaces: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, message: bytes) -> Model:
        model = cls()
        for number, value in fields(message):
            if number == 1:
                piece = dict(fields(value))
                score = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
                model.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
                model.kind = trainer.get(3, UNIGRAM)
                model.unk_id = trainer.get(40, 0)
                model.byte_fallback = bool(trainer.get(35, 0))
                model.suffix = bool(trainer.get(24, 0))
            elif number == 3:
                rules = dict(fields(value))
                model.charsmap = rules.get(2, b"")
                model.dummy_prefix = bool(rules.get(3, 1))
                model.single_spaces = bool(rules.get(4, 1))
                model.escape = bool(rules.get(5, 1))
        return model

    def cuts_at_marks(self) -> bool:
        """Whether no piece goes on past a character into a marker, so that words are independent."""
        inner = any(MARK in piece.lstrip(MARK) for piece, _, kind in self.pieces if kind in (NORMAL, USER))
        return not inner and not self.charsmap and not self.single_spaces and not self.suffix


def merges_of(model: Model) -> list[tuple[str, str]]:
    """The merges of a pair-merge model: every split of a piece into two pieces, best pieces first."""
    known = {piece: i for i, (piece, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER, UNUSED)}
    found = []
    for piece, score, kind in model.pieces:
        if kind not in (NORMAL, UNUSED):
            continue
        for at in range(1, len(piece)):
            left, right = piece[:at], piece[at:]
            if left in known and right in known:
                found.append((-score, known[left], known[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: Model):
    """The model as a tokenizer of the tokenizers library."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.suffix:
        raise ValueError("models that mark the ends of words are not supported")
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    elif model.kind == MERGES:
        vocab = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
        core = models.BPE(
            vocab, merges_of(model), unk_token=model.pieces[model.unk_id][0],
            fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"model kind {model.kind} is not supported")
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.single_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer = Tokenizer(core)
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    back = [decoders.Replace(MARK, " ")] if model.escape else []
    back += [decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    return tokenizer


class Pieces:
    """Encoder and decoder of one Python worker."""

    WORD = re.compile(" *[^ ]+| +")

    def __init__(self, message: bytes, threads: int, returns: bool = False):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = Model.parse(message)
        self.tokenizer = build_tokenizer(self.model)
        self.oracle = sentencepiece.SentencePieceProcessor(model_proto=message)
        self.cut = self.model.cuts_at_marks() and self.model.dummy_prefix and self.model.escape
        self.mark = np.array([self.tokenizer.token_to_id(MARK) or self.model.unk_id], "<i4").tobytes()
        self.known: dict[str, bytes] = {}
        self.differ = set()
        controls = [i for i, (_, _, kind) in enumerate(self.model.pieces) if kind == CONTROL]
        self.between = np.array(controls[:1], "<i4").tobytes()
        self.changed: set[str] | None = set() if returns and self.cut and controls else None
        names = [piece for piece, _, kind in self.model.pieces if kind in (UNKNOWN, CONTROL, BYTE)]
        self.named = re.compile("|".join(map(re.escape, names))) if names and self.model.kind == UNIGRAM else None

    def whole(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """Ids of each text by the tokenizers library, and whether those of sentencepiece are the same."""
        ours = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        theirs = self.oracle.encode(texts)
        found = []
        for text, a, b in zip(texts, ours, theirs):
            ids = a.ids
            if self.named and self.named.search(text):
                found.append((np.array(b, "<i4").tobytes(), True))
            else:
                found.append((np.array(ids, "<i4").tobytes(), ids == b))
        return found

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        # a marker in a text is a space to the model
        return self.WORD.findall(" " + text.replace(MARK, " ")) if self.cut else [text]

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        return self.encode_parts([self.parts(t) for t in texts])

    def encode_parts(self, cut: list[list[str]]) -> tuple[list[bytes], list[bool]]:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
            self.differ.clear()
            if self.changed:
                self.changed.clear()
        new = list(set().union(*cut).difference(self.known))
        # the dummy prefix stands for the part's first space
        for part, (ids, same) in zip(new, self.whole([p[1:] for p in new] if self.cut else new)):
            self.known[part] = self.mark if part == " " and self.cut else ids
            if not same:
                self.differ.add(part)
        if self.changed is not None:
            self.changed.update(self.not_returned(new))
        ids = self.known.__getitem__
        return (
            [b"".join(map(ids, ps)) for ps in cut],
            [self.differ.isdisjoint(ps) if self.differ else True for ps in cut],
        )

    def not_returned(self, parts: list[str]) -> list[str]:
        """Which parts their ids don't decode to; many are decoded at once, with a control piece between."""
        groups = [parts[i : i + TOGETHER] for i in range(0, len(parts), TOGETHER)]
        # the decoder strips a first space: the marker's, so that the part's own stays
        joined = [np.frombuffer(self.mark + self.between.join(map(self.known.get, g)), "<i4").tolist() for g in groups]
        name = self.model.pieces[int(np.frombuffer(self.between, "<i4")[0])][0]
        whole = [name.join(g) for g in groups]
        doubtful = [
            p for g, w, b in zip(groups, whole, self.decode(joined)) if w != b or w.count(name) >= len(g) for p in g
        ]
        back = self.decode([np.frombuffer(self.mark + self.known[p], "<i4").tolist() for p in doubtful])
        return [p for p, b in zip(doubtful, back) if p != b]

    def returned(self, texts: list[str], cut: list[list[str]], ids: list[bytes]) -> list[bool]:
        """Whether the ids of each text, as just encoded, decode to the text.

        Decoding puts pieces one after the other, so a text whose parts all come back does too. Any other is decoded whole.
        """
        sure = [
            self.changed is not None and MARK not in t and self.changed.isdisjoint(ps) for t, ps in zip(texts, cut)
        ]
        rest = [i for i, ok in enumerate(sure) if not ok]
        for i, back in zip(rest, self.decode([np.frombuffer(ids[i], "<i4").tolist() for i in rest])):
            sure[i] = back == texts[i]
        return sure

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def read_model(path: str) -> bytes:
    """The model file's bytes; a model has a fixed size and travels with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def in_task(message: str, threads: int, returns: bool = False) -> Pieces:
    raw = base64.b64decode(message)
    return in_worker(("pieces", zlib.crc32(raw), threads, returns), lambda: Pieces(raw, threads, returns))


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threads: int = 2) -> DataFrame:
    """The columns in `keep`, `ids`, and `parity`: whether both libraries gave the same ids."""
    message = base64.b64encode(read_model(path)).decode()
    out = T.StructType([docs.schema[c] for c in keep])
    out = out.add("ids", T.ArrayType(T.IntegerType())).add("parity", T.BooleanType())
    names = out.fieldNames()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = in_task(message, threads)
        for batch in batches:
            for part, texts in slices(batch, "_text"):
                ids, same = pieces.encode(texts)
                columns = [part.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, id_lists(ids), pa.array(same, pa.bool_())], names=names)

    return docs.select(*keep, docs[text].alias("_text")).mapInArrow(encoded, out)


def decode(frame: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), threads: int = 2) -> DataFrame:
    """The columns in `keep` and `text`, decoded from `ids` by the tokenizers library."""
    message = base64.b64encode(read_model(path)).decode()
    out = T.StructType([frame.schema[c] for c in keep]).add("text", T.StringType())
    names = out.fieldNames()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = in_task(message, threads)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column("_ids")
                texts = iter(pieces.decode([x for x in ids.to_pylist() if x is not None]))
                full = [next(texts) if ok else None for ok in ids.is_valid().to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(keep))), pa.array(full, pa.string())], names=names
                )

    return frame.select(*keep, frame["ids"].alias("_ids")).mapInArrow(decoded, out)


def op4(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_crc32, `parity` of both libraries and `round_trip`.

    `round_trip` says whether decoding the ids gives the text back byte for byte.
    """
    message = base64.b64encode(read_model(path)).decode()
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip"]

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = in_task(message, 2, True)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                cut = [pieces.parts(t) for t in texts]
                ids, same = pieces.encode_parts(cut)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([zlib.crc32(i) for i in ids], pa.int64()),
                        pa.array(same, pa.bool_()),
                        pa.array(pieces.returned(texts, cut, ids), pa.bool_()),
                    ],
                    names=names,
                )

    return docs.select("doc_id", "text").mapInArrow(
        digested, f"doc_id {kind}, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"
    )
