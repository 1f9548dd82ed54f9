"""Language identification by a linear-chain conditional random field over words.

Every word of a text gets a label, a language, so texts that switch languages are labelled word by
word. A word's score for a language sums the weights of its letter n-grams of one to four letters,
with the word's ends marked (so that those at an end are its affixes), and of the lexicons that list it.
Transitions between languages are learned together with them. Forward-backward sums give each
word's probabilities; a document's language is the one with most of the words' probability, and its
score that language's share.

Training reads a bounded sample: for each language `documents` texts with a letter, of smallest hash, and of each
text `windows` runs of `window` words, spread over the whole text; a shorter text is one run. The runs are strung together
across languages, which is how the transitions learn to switch. The lexicons hold the words that
`lexicon_min` runs of a language contain.

Scoring cuts all texts' words into pieces of `PIECE` words. The pieces' transition products are formed
side by side and chained per text, which gives the exact sums for texts of any length.

Defined results: a null text, or one without letters, is `und` with score 0; words without letters have no
label; ties go to the language whose name comes first; rows without a language aren't learned from, and repeated
rows are one text to learn from, but are labelled row by row; without any row to learn from all texts are `und`;
rows with a null id count as held in; other columns are never read.
"""

from __future__ import annotations

import base64
import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.llm.common import crc32_mod, mixed
from rillstone.llm.token_store import in_worker, slices

HELD_OUT = 2  # fixed values of the contract: rows of this remainder by 4 aren't learned from
FOLDS = 4
UNKNOWN = "und"

BITS = 16
ORDERS = (1, 2, 3, 4)
PIECE = 128
CACHED = 300_000


def letters(word: str) -> str:
    return word.lower() if word.isalpha() else "".join(c for c in word.lower() if c.isalpha())


def ngram_features(words: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in a row, and the word each belongs to."""
    marked = "".join(f"^{w}$" for w in words)
    points = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # letters up to the word's end
    hashed, numbers, owners = np.zeros(len(points), np.uint64), [], []
    for n in ORDERS:
        step = np.zeros(len(points), np.uint64)
        step[: len(points) - n + 1] = points[n - 1 :]
        hashed = mixed(hashed * np.uint64(0x9E3779B97F4A7C15) + step + np.uint64(n))
        fits = left >= n
        numbers.append((hashed[fits] >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(owner[fits])
    return np.concatenate(numbers), np.concatenate(owners)


def scaled(values: np.ndarray) -> np.ndarray:
    return values / values.sum(axis=-1, keepdims=True)


@dataclass
class Crf:
    """Languages, n-gram weights, lexicons with their weights, and transition scores."""

    languages: list[str]
    weights: np.ndarray
    lexicon: dict[str, int]
    lexicon_weights: np.ndarray
    transitions: np.ndarray

    def listed(self, words: list[str]) -> np.ndarray:
        """Which lexicons list each word."""
        width = -(-len(self.languages) // 8)
        masks = b"".join(self.lexicon.get(w, 0).to_bytes(width, "little") for w in words)
        bits = np.unpackbits(np.frombuffer(masks, np.uint8).reshape(len(words), width), axis=1, bitorder="little")
        return bits[:, : len(self.languages)].astype(float)

    def emissions(self, words: list[str]) -> np.ndarray:
        """Each word's score for each language."""
        numbers, owner = ngram_features(words)
        sums = [np.bincount(owner, self.weights[numbers, k], len(words)) for k in range(len(self.languages))]
        return np.stack(sums, axis=1) + self.listed(words) @ self.lexicon_weights

    def posteriors(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Probabilities of every word's labels, for texts of the given sizes, one after the other."""
        k = scores.shape[1]
        step = np.exp(self.transitions - self.transitions.max())
        phi = np.exp(scores - scores.max(axis=1, keepdims=True))
        n_pieces = -(-sizes // PIECE)
        text_of = np.repeat(np.arange(len(sizes)), n_pieces)
        number = np.arange(len(text_of)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = np.repeat(np.cumsum(sizes) - sizes, n_pieces) + number * PIECE
        length = np.minimum(PIECE, np.repeat(sizes, n_pieces) - number * PIECE)
        order = np.argsort(-length, kind="stable")
        by_length, lengths = start[order], length[order]
        active = [int(np.searchsorted(-lengths, -t, "right")) for t in range(1, int(lengths[0]) + 1)]

        product = np.broadcast_to(np.eye(k), (len(order), k, k)).copy()
        for t, n in enumerate(active):
            after = (product[:n] @ step) * phi[by_length[:n] + t][:, None]
            product[:n] = after / after.sum(axis=(1, 2), keepdims=True)
        products = np.empty_like(product)
        products[order] = product

        # chain the pieces of each text; texts with most pieces first
        into, out = np.full((len(order), k), 1 / k), np.full((len(order), k), 1 / k)
        texts = np.argsort(-n_pieces, kind="stable")
        first = (np.cumsum(n_pieces) - n_pieces)[texts]
        pieces = n_pieces[texts]
        for j in range(1, int(pieces[0])):
            at = first[: np.searchsorted(-pieces, -j, "left")] + j
            into[at] = scaled((into[at - 1][:, None] @ products[at - 1])[:, 0])
        for j in range(int(pieces[0]) - 1, 0, -1):
            at = first[: np.searchsorted(-pieces, -j, "left")] + j
            out[at - 1] = scaled((products[at] @ out[at][:, :, None])[:, :, 0])

        forward = np.empty_like(phi)
        state = into[order]
        for t, n in enumerate(active):
            at = by_length[:n] + t
            state[:n] = scaled((state[:n] @ step) * phi[at])
            forward[at] = state[:n]
        state = out[order]
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            at = by_length[:n] + t
            # pieces that end here still hold what follows them
            forward[at] = scaled(forward[at] * state[:n])
            state[:n] = scaled((phi[at] * state[:n]) @ step.T)
        return forward


def fit(runs: list[tuple[str, list[str]]], rounds: int, lexicon_min: int, rate: float = 0.5, seed: int = 7) -> Crf | None:
    """Weights learned from runs of words of one language each, strung together at random.

    A run of fewer words than the longest is repeated until it is as long.
    """
    runs = [(lang, [w for w in map(letters, words) if w]) for lang, words in runs]
    size = max((len(words) for _, words in runs), default=0)
    runs = [(lang, (words * size)[:size]) for lang, words in runs if words]
    if not size:
        return None
    languages = sorted({lang for lang, _ in runs})
    number = {lang: i for i, lang in enumerate(languages)}
    k = len(languages)
    seen: dict[str, Counter] = {lang: Counter() for lang in languages}
    for lang, words in runs:
        seen[lang].update(set(words))
    lexicon: dict[str, int] = {}
    for lang, counts in seen.items():
        for word, n in counts.items():
            if n >= lexicon_min:
                lexicon[word] = lexicon.get(word, 0) | 1 << number[lang]
    model = Crf(languages, np.zeros((1 << BITS, k)), lexicon, np.zeros((k, k)), np.zeros((k, k)))
    words = sorted({w for _, ws in runs for w in ws})
    place = {w: i for i, w in enumerate(words)}
    features, owner = ngram_features(words)
    listed = model.listed(words)

    random = np.random.default_rng(seed)
    strung = 6
    order = np.concatenate([random.permutation(len(runs)) for _ in range(2 * strung)])
    order = order[: len(order) // strung * strung].reshape(-1, strung)
    word_ids = np.array([[place[w] for w in ws] for _, ws in runs])
    truth = np.array([number[lang] for lang, _ in runs])
    sequences = word_ids[order].reshape(len(order), -1)
    labels = np.repeat(truth[order], size, axis=1)
    n, length = sequences.shape
    told = np.zeros((k, k))
    np.add.at(told, (labels[:, :-1].ravel(), labels[:, 1:].ravel()), 1)

    history = [np.full_like(x, 1e-6) for x in (model.weights, model.lexicon_weights, model.transitions)]
    for _ in range(rounds):
        scores = np.stack([np.bincount(owner, model.weights[features, j], len(words)) for j in range(k)], axis=1)
        scores += listed @ model.lexicon_weights
        phi = np.exp(scores - scores.max(axis=1, keepdims=True))
        step = np.exp(model.transitions - model.transitions.max())
        forward = np.empty((length, n, k))
        state = np.full((n, k), 1 / k)
        for t in range(length):
            state = forward[t] = scaled((state @ step) * phi[sequences[:, t]])
        expected, pairs = np.zeros((len(words), k)), np.zeros((k, k))
        state = np.full((n, k), 1 / k)
        for t in range(length - 1, -1, -1):
            wrong = scaled(forward[t] * state)
            wrong[np.arange(n), labels[:, t]] -= 1
            for j in range(k):
                expected[:, j] += np.bincount(sequences[:, t], wrong[:, j], len(words))
            ahead = phi[sequences[:, t]] * state
            if t:
                both = forward[t - 1][:, :, None] * step * ahead[:, None]
                pairs += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            state = scaled(ahead @ step.T)
        slopes = (
            np.stack([np.bincount(features, expected[owner, j], 1 << BITS) for j in range(k)], axis=1),
            listed.T @ expected,
            pairs - told,
        )
        for values, slope, past in zip((model.weights, model.lexicon_weights, model.transitions), slopes, history):
            slope = slope / n + 1e-4 * values
            past += slope * slope
            values -= rate * slope / np.sqrt(past) / np.sqrt(len(ORDERS))
    return model


def training_runs(docs: DataFrame, documents: int, windows: int, window: int) -> DataFrame:
    """(lang, words, order): the bounded sample's runs of words.

    A language's texts are chosen by a hash of id and text. Only those whose hash lies below a share that
    leaves some three times the wanted number are ranked, so the ranked rows don't grow with the input.
    Repeated rows are one text.
    """
    open_rows = docs.where(crc32_mod("doc_id", FOLDS) != HELD_OUT).where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    hashed = open_rows.select("lang", F.xxhash64("doc_id", "text").alias("hash"), "text")
    different = hashed.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n"))
    share = (F.col("hash") / 2.0**64 + 0.5) * F.col("n") <= 3 * documents
    below = hashed.join(different, "lang").where(share).dropDuplicates(["lang", "hash"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    chosen = below.select("lang", "text", rank.alias("rank")).where(F.col("rank") <= documents)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, order, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = [w for w in text.split() if any(map(str.isalpha, w))]
                room = max(0, len(words) - window)
                cuts = min(windows, max(1, len(words) // window))
                for k in range(cuts):
                    at = room * k // max(1, cuts - 1)
                    found.append((lang, order * windows + k, words[at : at + window]))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int64(), pa.list_(pa.string())))],
                    names=["lang", "order", "words"],
                )

    return chosen.select("lang", F.col("rank").cast("long"), "text").mapInArrow(cut, "lang string, order long, words array<string>")


def train(
    docs: DataFrame, documents: int = 400, windows: int = 5, window: int = 8, rounds: int = 30, lexicon_min: int = 5,
) -> Crf | None:
    """A model of the languages in `docs`; at most documents * windows runs of each come to the driver."""
    runs = training_runs(docs, documents, windows, window).collect()
    runs = sorted((r["lang"], r["order"], r["words"]) for r in runs)
    return fit([(lang, words) for lang, _, words in runs], rounds, lexicon_min)


class Labeller:
    """A model with the scores of the words met, in one Python worker."""

    def __init__(self, packed: str):
        self.model: Crf = Crf(**pickle.loads(zlib.decompress(base64.b64decode(packed))))
        self.k = len(self.model.languages)
        self.numbers: dict[str, int] = {}
        self.scores = np.empty((0, self.k), np.float32)

    def learn(self, words: set[str]) -> None:
        if len(self.numbers) > CACHED:
            self.numbers.clear()
            self.scores = self.scores[:0]
        new = [w for w in words if w not in self.numbers]
        bare = list(map(letters, new))
        kept = [i for i, b in enumerate(bare) if b]
        self.numbers.update((new[i], -1) for i, b in enumerate(bare) if not b)
        at = len(self.scores)
        self.numbers.update((new[i], at + j) for j, i in enumerate(kept))
        found = [self.model.emissions([bare[i] for i in kept[j : j + 20_000]]) for j in range(0, len(kept), 20_000)]
        self.scores = np.concatenate([self.scores, *(f.astype(np.float32) for f in found)])

    def label(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Per text the numbers of its words (-1: no letters); its sizes; all labelled words' probabilities."""
        split = [t.split() for t in texts]
        self.learn(set().union(*split))
        numbers = [np.fromiter(map(self.numbers.__getitem__, ws), np.int64, len(ws)) for ws in split]
        labelled = [n[n >= 0] for n in numbers]
        sizes = np.array([len(n) for n in labelled])
        full = np.flatnonzero(sizes)
        if not len(full):
            return numbers, sizes, np.empty((0, self.k))
        scores = self.scores[np.concatenate([labelled[i] for i in full])].astype(float)
        return numbers, sizes, self.model.posteriors(scores, sizes[full])


def packed_model(model: Crf) -> str:
    state = model.__dict__ | {"weights": model.weights.astype(np.float32)}
    return base64.b64encode(zlib.compress(pickle.dumps(state))).decode()


def identify(docs: DataFrame, model: Crf | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in `keep`, lang_pred, score and n_switches (changes of label between words)."""
    if model is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).alias("n_switches"))
    packed = packed_model(model)
    out = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("n_switches", T.IntegerType())

    def identified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = in_worker(("language labels", zlib.crc32(packed.encode())), lambda: Labeller(packed))
        names = np.array([*labeller.model.languages, UNKNOWN])
        for batch in batches:
            for part, texts in slices(batch, "text"):
                _, sizes, chances = labeller.label(texts)
                best = np.full(len(texts), len(names) - 1)
                share, switches = np.zeros(len(texts)), np.zeros(len(texts), np.int32)
                full = np.flatnonzero(sizes)
                if len(full):
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    sums = np.add.reduceat(chances, starts) / sizes[full][:, None]
                    best[full] = sums.argmax(axis=1)
                    share[full] = np.clip(sums.max(axis=1), 0, 1)
                    label = chances.argmax(axis=1)
                    change = np.concatenate([[0], label[1:] != label[:-1]])
                    change[starts] = 0
                    switches[full] = np.add.reduceat(change, starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(len(keep))), pa.array(names[best].tolist(), pa.string()),
                        pa.array(share), pa.array(switches, pa.int32()),
                    ],
                    names=out.fieldNames(),
                )

    return docs.select(*keep, "text").mapInArrow(identified, out)


def label_words(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id and, for each word of the text, its language (null for words without letters)."""
    packed = packed_model(model)
    out = docs.select("doc_id").schema.add("labels", T.ArrayType(T.StringType()))

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = in_worker(("language labels", zlib.crc32(packed.encode())), lambda: Labeller(packed))
        for batch in batches:
            for part, texts in slices(batch, "text"):
                numbers, _, chances = labeller.label(texts)
                best = iter(chances.argmax(axis=1).tolist()) if len(chances) else iter(())
                labels = [[labeller.model.languages[next(best)] if n >= 0 else None for n in ns.tolist()] for ns in numbers]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(labels, pa.list_(pa.string()))], names=out.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(labelled, out)


def op1(docs: DataFrame) -> DataFrame:
    """The contract's columns, and how often a text switches languages."""
    model = train(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc32_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "n_switches"
    )
