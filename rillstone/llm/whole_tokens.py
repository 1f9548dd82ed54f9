"""Token counts without tokenizing: whole-token words are counted, only the rest is merged.

`whole_tokens` proves, once and before any text is read, which strings of the vocabulary the tokenizer
itself encodes as one token. A text is cut into pre-tokens by the tokenizer's pattern. A pre-token
that is proven counts one; any other is merged by the library once per worker and remembered.
Special strings inside a text count one each, as is the library's default.

Defined results: null and empty texts have no bytes and no tokens; repeated rows and null ids are
counted row by row; long texts are worked on whole; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rillstone.llm.token_store import CACHED_WORDS, in_worker, load_tokenizer, slices

LIMIT = 1024

# Fixed value: the pre-token pattern of the byte-level vocabularies, with white space by its Unicode property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> dict[str, int]:
    """The printable letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings that are one pre-token and that the tokenizer encodes as one token."""
    tokenizer = load_tokenizer(path)
    rules = json.loads(tokenizer.to_str())
    cuts = rules["pre_tokenizer"] or {}
    if rules["normalizer"] or cuts.get("type") != "ByteLevel" or not cuts.get("use_regex", True) or cuts.get("add_prefix_space"):
        raise ValueError("texts are cut as byte-level vocabularies do, without a normaliser or a space put before them")
    letters, cut = byte_letters(), regex.compile(PATTERN)
    strings = []
    for piece in tokenizer.get_vocab(with_added_tokens=False):
        try:
            string = bytes(letters[c] for c in piece).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if (found := cut.match(string)) and found.end() == len(string):
            strings.append(string)
    encoded = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
    return [s for s, e in zip(strings, encoded) if len(e.ids) == 1]


class TokenCounts(dict):
    """Tokens of each pre-token met."""

    def __init__(self, path: str, proven: list[str]):
        super().__init__()
        self.tokenizer = load_tokenizer(path)
        self.proven = dict.fromkeys(proven, 1)
        self.update(self.proven)
        self.cut = regex.compile(PATTERN)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The text's pre-tokens and how many special strings it holds."""
        parts = self.special.split(text) if self.special and self.special.search(text) else [text]
        if len(parts) == 1:
            return self.cut.findall(text), 0
        return [p for part in parts for p in self.cut.findall(part)], len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.pre_tokens(t) for t in texts]
        if len(self) > CACHED_WORDS + len(self.proven):
            self.clear()
            self.update(self.proven)
        new = list(set().union(*(p for p, _ in cut)).difference(self.keys()))
        self.update(zip(new, (len(e.ids) for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False))))
        return [sum(map(self.__getitem__, p)) + n for p, n in cut]


def op8(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """The contract's columns."""
    proven = whole_tokens(path)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = in_worker(("token counts", path), lambda: TokenCounts(path, proven))
        for batch in batches:
            for part, texts in slices(batch, "text"):
                n = counts.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                        pa.array(n, pa.int64()),
                        pa.array([x > limit for x in n], pa.bool_()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
