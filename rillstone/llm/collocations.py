"""Phrases whose words belong together, counted in counting quotient filters.

A word's id is a 64-bit hash of its language and itself; `word_table` proves on all words of the corpus
that no two share an id (and takes the next seed if they do). An n-gram is the tuple of its words' ids.
`permuted` mixes all ids of a tuple into the first one, invertibly. The leading bits of that number
are the entry's quotient, which its place in the sorted filter tells; its other bits and the other
ids are the remainder, stored in full, so a filter counts without loss and gives its n-grams back. Every
task writes filters in slices by leading bits; slices of equal bits from all shards are merged in
order. The counts of a slice hold at most a few million entries, as the number of slices follows the
number of words.

Lengths are counted one after the other. An n-gram that occurs often enough consists of shorter ones that
do, so only those are counted whose two shorter parts are set in a bitmap of fixed size (`BITMAP_BITS`
bits, gathered and sent as 16 MB at most). A bit set by chance costs an entry and changes no result.

Defined results: null and empty texts have no words; a null language is `und`; repeated rows and null
ids count row by row; phrases never span separators; ties of score and count go by the phrase's bytes; an empty
table gives no rows; other columns are not read. Very long words are words like others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import WordHashes, Workspace, by_key, mixed
from rillstone.llm.token_store import slices

# Fixed values of the contract: what separates pieces and words, and its limits.
BREAKS = b".,;:!?\n\x0b\x0c\r"
LONGEST = 4
MIN_COUNT = 30
INSIDE_PERCENT = 80
SCALE = 2_000_000
FIRST = 2000

BITMAP_BITS = 27
QUOTIENT_BITS = 24
HELD_WORDS = 500_000
HELD_ENTRIES = 1_000_000
SLICE_ENTRIES = 1_000_000
BUCKETS = 64

BREAK = b"\xff"  # no byte of UTF-8
TO_BREAKS = bytes.maketrans(BREAKS, BREAK * len(BREAKS))

M1, M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB  # the multipliers of `mixed`
GOLDEN = 0x9E3779B97F4A7C15


def unmixed(values: np.ndarray) -> np.ndarray:
    """The inverse of `mixed`."""

    def unshift(x: np.ndarray, by: int) -> np.ndarray:
        return x ^ (x >> np.uint64(by)) ^ (x >> np.uint64(2 * by))

    values = unshift(values, 31) * np.uint64(pow(M2, -1, 1 << 64))
    values = unshift(values, 27) * np.uint64(pow(M1, -1, 1 << 64))
    return unshift(values, 30)


def rest_of(columns: list[np.ndarray]) -> np.ndarray:
    """One number of all ids but the first, and of their order."""
    total = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns[1:]:
        total = mixed(total * np.uint64(GOLDEN) + column)
    return total


def permuted(columns: list[np.ndarray]) -> list[np.ndarray]:
    """An invertible mixing of tuples of 64-bit ids; the first number depends on all ids."""
    return [mixed(columns[0] ^ rest_of(columns)), *columns[1:]]


def restored(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The tuples that `permuted` mixed."""
    return [unmixed(columns[0]) ^ rest_of(columns), *columns[1:]]


def short(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small numbers as bytes, with 255 for those that are held in full behind them."""
    return np.minimum(values, 255).astype(np.uint8), values[values >= 255].astype(np.uint64)


def full(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    values = small.astype(np.uint64)
    values[small == 255] = large
    return values


@dataclass
class QuotientFilter:
    """Permuted tuples in ascending order, each once, with their counts."""

    columns: list[np.ndarray]
    counts: np.ndarray

    @classmethod
    def of(cls, columns: list[np.ndarray], counts: np.ndarray) -> QuotientFilter:
        """Sort and add up. Runs that are sorted already are merged."""
        order = np.argsort(columns[0], kind="stable")
        ordered = [c[order] for c in columns]
        first, others = changes(ordered[:1]), changes(ordered)
        if not np.array_equal(first, others):  # tuples that share the first number may alternate
            order = np.lexsort(columns[::-1])
            ordered = [c[order] for c in columns]
            others = changes(ordered)
        if not len(order):
            return cls(columns, counts)
        return cls([c[others] for c in ordered], np.add.reduceat(counts[order], others))

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        columns = [np.concatenate(same) for same in zip(*(f.columns for f in filters))]
        return cls.of(columns, np.concatenate([f.counts for f in filters]))

    def slices(self, bits: int) -> Iterator[tuple[int, QuotientFilter]]:
        """The entries by the leading bits of their quotients."""
        part = (self.columns[0] >> np.uint64(64 - bits)) if bits else np.zeros(len(self.counts), np.uint64)
        starts = changes([part])
        for a, b in zip(starts, [*starts[1:], len(part)]):
            yield int(part[a]), QuotientFilter([c[a:b] for c in self.columns], self.counts[a:b])

    def to_bytes(self) -> bytes:
        """Quotients as gaps between entries, remainders in full, counts as a byte where they fit."""
        low = 64 - QUOTIENT_BITS
        gaps = np.diff(self.columns[0] >> np.uint64(low), prepend=np.uint64(0))
        remainder = (self.columns[0] & np.uint64((1 << low) - 1)).view(np.uint8).reshape(-1, 8)[:, : low // 8]
        packed = [*short(gaps), *short(self.counts)]
        header = np.array([len(self.counts), len(packed[1]), len(packed[3])], np.int64)
        rest = [c.tobytes() for c in self.columns[1:]]
        return b"".join([header.tobytes(), *(p.tobytes() for p in packed), remainder.tobytes(), *rest])

    @classmethod
    def from_bytes(cls, raw: bytes, words: int) -> QuotientFilter:
        low = 64 - QUOTIENT_BITS
        n, n_gaps, n_counts = np.frombuffer(raw, np.int64, 3).tolist()
        at = 24

        def take(count: int, kind: type) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, count, at)
            at += found.nbytes
            return found

        gaps = full(take(n, np.uint8), take(n_gaps, np.uint64))
        counts = full(take(n, np.uint8), take(n_counts, np.uint64)).astype(np.int64)
        remainder = np.zeros((n, 8), np.uint8)
        remainder[:, : low // 8] = take(n * (low // 8), np.uint8).reshape(n, -1)
        first = (np.cumsum(gaps, dtype=np.uint64) << np.uint64(low)) | remainder.view(np.uint64).ravel()
        return cls([first, *(take(n, np.uint64) for _ in range(words - 1))], counts)


def changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where runs of equal tuples begin."""
    n = len(columns[0])
    if not n:
        return np.empty(0, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def words_of(text: str) -> list[bytes]:
    """The words of a text, and BREAK wherever a piece ends; only A-Z are lower-cased."""
    return text.encode().lower().translate(TO_BREAKS).replace(BREAK, b" \xff ").split()


class Ids(dict):
    """The word ids of each language, remembered by one task."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, lang: str) -> WordHashes:
        prefix, seed = lang.encode() + b"\0", self.seed

        class Known(WordHashes):
            def __missing__(self, word: bytes) -> int:
                value = 0 if word == BREAK else xxhash.xxh3_64_intdigest(prefix + word, seed) or 1
                if len(self) >= self.limit:
                    self.clear()
                if len(word) <= 64:
                    self[word] = value
                return value

        if len(self) >= 16:  # many languages: remember the latest
            self.clear()
        self[lang] = Known(150_000)
        return self[lang]


def spoken(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")


def word_table(docs: DataFrame, work: Workspace, min_count: int, tries: int = 8) -> tuple[DataFrame, int]:
    """(`lang`, `word`, `id`, `n`) of every word, and the seed under which no frequent word shares its id."""
    for seed in range(tries):

        def counted(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            ids, held = Ids(seed), {}

            def rows() -> Iterator[pa.RecordBatch]:
                for lang, words in held.items():
                    words.pop(BREAK, None)
                    names = list(words)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(names), pa.string()),
                            pa.array(names, pa.binary()).cast(pa.string()),
                            pa.array(ids[lang].of(names).view(np.int64)),
                            pa.array(list(words.values()), pa.int64()),
                        ],
                        names=["lang", "word", "id", "n"],
                    )
                held.clear()

            for batch in batches:
                for part, texts in slices(batch, "text"):
                    for lang, text in zip(part.column("lang").to_pylist(), texts):
                        held.setdefault(lang, Counter()).update(words_of(text))
                    if sum(map(len, held.values())) > HELD_WORDS:
                        yield from rows()
            yield from rows()

        each = spoken(docs).mapInArrow(counted, "lang string, word string, id long, n long")
        words = work.store(each.groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), f"words-{seed}")
        shared = words.groupBy("id").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n"))
        if shared.where((F.col("words") > 1) & (F.col("n") >= min_count)).isEmpty():
            return words, seed
        work.drop(f"words-{seed}")
    raise RuntimeError("words share ids under every seed")


def bitmap(frequent: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bit for each frequent tuple by its first permuted number (`place`); at most 2 ** (bits - 6) rows meet."""
    place = F.col("place").bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    blocks = frequent.select(F.shiftright(place, 6).alias("block"), bit.alias("bit"))
    rows = blocks.groupBy("block").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows.column("block").to_numpy()] = rows.column("bit").to_numpy()
    return out.view(np.uint64)


def is_set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    places = places & np.uint64(len(bits) * 64 - 1)
    return (bits[(places >> np.uint64(6)).astype(np.int64)] >> (places & np.uint64(63))) & np.uint64(1) == 1


def grams(ids: np.ndarray, length: int, shorter: np.ndarray) -> list[np.ndarray]:
    """The permuted tuples of all runs of `length` ids whose two shorter parts are set in the bitmap.

    A 0 among the ids is the end of a piece.
    """
    if len(ids) < length:
        return [np.empty(0, np.uint64)] * length
    n = len(ids) - length + 2
    parts = [ids[k : k + n] for k in range(length - 1)]
    whole = np.logical_and.reduce([p != 0 for p in parts])
    whole[whole] = is_set(shorter, permuted([p[whole] for p in parts])[0])
    at = np.flatnonzero(whole[:-1] & whole[1:])
    return permuted([ids[at + k] for k in range(length)])


def count_grams(docs: DataFrame, seed: int, length: int, shorter: np.ndarray, slice_bits: int, min_count: int) -> DataFrame:
    """(`ids`, `place`, `n`) of all n-grams of this length that occur often enough."""
    sent = docs.sparkSession.sparkContext.broadcast(shorter)

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, size = Ids(seed), [], 0

        def rows() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(same) for same in zip(*held)]
            held.clear()
            found = list(QuotientFilter.of(columns, np.ones(len(columns[0]), np.int64)).slices(slice_bits))
            for start in range(0, len(found), 64):
                some = found[start : start + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in some], pa.int64()), pa.array([f.to_bytes() for _, f in some], pa.binary())],
                    names=["slice", "filter"],
                )

        for batch in batches:
            for part, texts in slices(batch, "text"):
                sequences = [np.zeros(1, np.uint64)]
                for lang, text in zip(part.column("lang").to_pylist(), texts):
                    sequences += [ids[lang].of(words_of(text)), np.zeros(1, np.uint64)]
                held.append(grams(np.concatenate(sequences), length, sent.value))
                size += len(held[-1][0])
                if size > HELD_ENTRIES:
                    yield from rows()
                    size = 0
        if size:
            yield from rows()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, "slice"):
            whole = QuotientFilter.merged([QuotientFilter.from_bytes(f, length) for f in table.column("filter").to_pylist()])
            often = whole.counts >= min_count
            columns = [c[often] for c in whole.columns]
            n = int(often.sum())
            flat = np.stack(restored(columns), axis=1).ravel().view(np.int64)
            ends = pa.array(np.arange(0, length * n + 1, length), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(ends, pa.array(flat)), pa.array(columns[0].view(np.int64)), pa.array(whole.counts[often])],
                names=["ids", "place", "n"],
            )

    shards = spoken(docs).mapInArrow(filters, "slice long, filter binary")
    dealt = shards.repartition("slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(merge, "ids array<long>, place long, n long")


def with_scores(counts: DataFrame) -> DataFrame:
    """(`ids`, `a`, `l`, `r`, `score`) of all phrases: each one's lowest cut, ties to the earliest."""
    phrases = counts.where(F.size("ids") > 1).select("ids", F.col("n").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1))).select(
        "ids", "a", "k",
        F.slice("ids", F.lit(1), F.col("k")).alias("first"),
        F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("rest"),
    )
    lefts = counts.select(F.col("ids").alias("first"), F.col("n").alias("l"))
    rights = counts.select(F.col("ids").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(lefts, "first").join(rights, "rest").withColumn(
        "score", F.expr(f"cast(a as decimal(20,0)) * {SCALE} div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    )
    best = scored.groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("ids", "a", "cut.l", "cut.r", "cut.score")


def not_inside(phrases: DataFrame, percent: int) -> DataFrame:
    """The phrases without those that mostly occur inside a longer one."""
    longer = phrases.where(F.size("ids") > 2).select(
        "ids", "a", F.explode(F.sequence(F.lit(2), F.size("ids") - 1)).alias("size")
    )
    longer = longer.select(
        "ids", "a", "size", F.explode(F.sequence(F.lit(1), F.size("ids") - F.col("size") + 1)).alias("at")
    )
    around = longer.groupBy(F.slice("ids", F.col("at"), F.col("size")).alias("ids")).agg(F.max("a").alias("around"))
    wide = F.col("around").cast("decimal(24,0)") * 100 >= F.col("a").cast("decimal(24,0)") * percent
    return phrases.join(around, "ids", "left").where(~F.coalesce(wide, F.lit(False))).drop("around")


def first_by(phrases: DataFrame, order: list, first: int, ties: bool, *keys: str) -> DataFrame:
    number = F.rank() if ties else F.row_number()
    return phrases.withColumn("rank", number.over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= first)


def collocations(
    docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, percent: int = INSIDE_PERCENT, first: int = FIRST
) -> DataFrame:
    """Per language its first phrases by score: lang, rank, phrase, a, l, r, n, score."""
    work = Workspace(docs.sparkSession, "collocations")
    words, seed = word_table(docs, work, min_count)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    spoken_words = words.agg(F.sum("n")).first()[0] or 0
    slice_bits = min(20, max(0, (spoken_words // SLICE_ENTRIES).bit_length()))
    often = words.where(F.col("n") >= min_count)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = permuted([batch.column("id").to_numpy().view(np.uint64)])[0].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place)], names=["place"])

    shorter = bitmap(often.select("id").mapInArrow(placed, "place long"))
    counts = often.select(F.array("id").alias("ids"), "n")
    for length in range(2, longest + 1):
        found = work.store(count_grams(docs, seed, length, shorter, slice_bits, min_count), f"grams-{length}")
        counts = counts.unionAll(found.select("ids", "n"))
        if length < longest:
            shorter = bitmap(found)
    scored = work.store(with_scores(counts), "scored")
    left = not_inside(scored, percent)
    langs = often.select("lang", F.col("id").alias("_first"))
    left = left.withColumn("_first", F.col("ids")[0]).join(langs, "_first").drop("_first")
    left = left.withColumn("bucket", F.pmod(F.xxhash64("ids"), F.lit(BUCKETS)))
    by_score = [F.desc("score"), F.desc("a")]
    # no bucket's first ones are missed; ties stay until their words are known
    left = work.store(first_by(left, by_score, first, True, "lang", "bucket"), "leading")
    spelled = left.select("ids", F.posexplode("ids").alias("at", "id")).join(often.select("id", "word"), "id")
    spelled = spelled.groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
    spelled = spelled.select("ids", F.concat_ws(" ", F.transform("words", lambda w: w["word"])).alias("phrase"))
    order = [*by_score, F.col("phrase")]
    left = first_by(left.join(spelled, "ids"), order, first, False, "lang", "bucket")
    left = first_by(left, order, first, False, "lang")
    return left.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
        F.col("total").alias("n"), F.col("score").cast("long").alias("score"),
    )


def op13(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    return collocations(docs)


ORACLE = rf"""
with pieces as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (select coalesce(lang, 'und') as lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[.,;:!?\x0A-\x0D]')) as piece
        from documents)),
sizes as (select unnest(range(1, {LONGEST + 1})) as k),
f as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as n
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from pieces, sizes where len(w) >= k)
  group by all),
totals as (select lang, sum(n) as total from f where k = 1 group by lang),
often as (select lang, k, phrase, n as a, string_split(phrase, ' ') as w from f where k > 1 and n >= {MIN_COUNT}),
cuts as (
  select o.lang, o.phrase, o.k, o.a, c.j, l.n as l, r.n as r, (({SCALE}::hugeint * o.a) // (l.n + r.n)) as score
  from (select *, unnest(range(1, k)) as j from often) c
  join often o using (lang, phrase)
  join f l on l.lang = c.lang and l.k = c.j and l.phrase = array_to_string(c.w[1:c.j], ' ')
  join f r on r.lang = c.lang and r.k = c.k - c.j and r.phrase = array_to_string(c.w[c.j + 1:], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
kept as (
  select * from best b
  where not exists (
    select 1 from often g
    where g.lang = b.lang and g.k > b.k and 100 * g.a >= {INSIDE_PERCENT} * b.a
      and contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ')))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
       a, l, r, total::bigint as n, score::bigint as score
from kept join totals using (lang)
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= {FIRST}
"""
