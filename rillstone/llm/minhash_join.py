"""Near-duplicate documents by an inverted join of signature coordinates.

A document's shingle set is summarised by `coordinates` minimum hashes. Documents are posted under
(coordinate, value) pairs, and two documents are compared if enough of their coordinates collide.
The threshold `matches` is the smallest at which a pair of the wanted similarity falls below it with a
chance of at most `miss`. Two skips keep the lists short, and lose no pair above the threshold:

- prefix: of two documents with at least m of k equal coordinates, any k - m + 1 coordinates of the one
  hold an equal one. With one order for all, rarest value first, each document is posted only
  under the first k - m + 1 of its own; values met once need no list.
- skip merging: a pair that meets in several lists is counted in the list of its first common
  coordinate only.

Lists longer than `block` are cut into blocks, and each pair of blocks is a group of its own. A group
first tells which of its documents have a pair over the threshold. Only for these are the full
sets built and their intersections counted. A group returns no pairs but the components it finds, a
row per document. Equal sets are one class from the start, represented by its smallest id.

A near-copy group of m different texts costs m * m / block rows of signatures, in groups of equal size.

Defined results: texts without words, and nulls, have an empty set and are linked with nothing; a text
with fewer words than a shingle has one shingle; rows with a null id have no component and are kept;
rows that share an id are judged each by its text, and `keep_one` keeps of a component the text of its
smallest id (of several texts under that id, the one of least hash; whole repeats of that row stay
with it); other columns pass through `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import Workspace, WordHashes, by_key, run_hashes
from rillstone.llm.components import components

COORDINATES = 64
MISS = 1e-6
BLOCK = 256
SEED = 20_240_601

MEMBER = "key long, side int, coord int, node long, posted long, signature binary"


def match_threshold(similarity: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The most matches that a pair of this similarity reaches but for a chance of `miss`."""
    below, matches = 0.0, 0
    while matches < coordinates:
        below += comb(coordinates, matches) * similarity**matches * (1 - similarity) ** (coordinates - matches)
        if below > miss:
            return max(matches, 1)
        matches += 1
    return matches


class Shingles:
    """Shingle sets and signatures as one task computes them."""

    def __init__(self, words: int, coordinates: int):
        self.words = words
        self.known = WordHashes()
        random = np.random.default_rng(SEED)
        self.factors = random.integers(0, 2**63, coordinates, np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = random.integers(0, 2**63, coordinates, np.uint64)

    def of(self, text: str | None) -> np.ndarray:
        """The sorted hashes of a text's different shingles; only A-Z are lower-cased."""
        return np.unique(run_hashes(self.known.of((text or "").encode().lower().split()), self.words))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factors), 2**32 - 1, np.uint32)
        for at in range(0, len(shingles), 512):
            hashed = shingles[at : at + 512, None] * self.factors + self.shifts
            least = np.minimum(least, (hashed >> np.uint64(32)).astype(np.uint32).min(axis=0))
        return least


def signed(docs: DataFrame, words: int, coordinates: int) -> DataFrame:
    """Per document a hash of its text, its set's size, the set's 128-bit hash and its signature."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words, coordinates)
        for batch in batches:
            n, keys, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles.of(text)
                n.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()))
                signatures.append(shingles.signature(found).tobytes() if len(found) else None)
            key = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()),
                    pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n_shingles", "k1", "k2", "signature"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        sign, "doc_id long, text_hash long, n_shingles long, k1 long, k2 long, signature binary"
    )


def tokens(nodes: DataFrame, coordinates: int) -> DataFrame:
    """A row per node and coordinate: `token` holds the coordinate above the value."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.arange(coordinates, dtype=np.int64) << np.int64(32)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                raw = b"".join(part.column("signature").to_pylist())
                values = np.frombuffer(raw, np.uint32).reshape(-1, coordinates).astype(np.int64) | places
                node = np.repeat(part.column("node").to_numpy(zero_copy_only=False), coordinates)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(values.ravel())], names=["node", "token"])

    return nodes.select("node", "signature").mapInArrow(spread, "node long, token long")


def postings(nodes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(node, token, posted): the tokens under which each node is posted, and their coordinates as bits."""
    each = tokens(nodes, coordinates)
    shared = each.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranked = each.join(shared, "token").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("ranked")
    )
    room = F.lit(coordinates - matches + 1) - (F.lit(coordinates) - F.size("ranked"))
    first = ranked.where(room > 0).select("node", F.slice("ranked", F.lit(1), room)["token"].alias("first"))
    one = F.lit(1).cast("long")
    bit = F.aggregate(
        "first", F.lit(0).cast("long"),
        lambda bits, token: bits.bitwiseOR(F.call_function("shiftleft", one, F.shiftright(token, 32).cast("int"))),
    )
    return first.select("node", bit.alias("posted"), F.explode("first").alias("token"))


def members(posted: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """Every list's members with their signatures, long lists dealt to pairs of blocks."""
    lists = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = posted.join(lists, "token").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("side", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    key = F.xxhash64("token", F.least("side", "other"), F.greatest("side", "other"))
    # within one block no pair is of two sides: all its pairs count
    side = F.when(F.col("side") == F.col("other"), -1).otherwise(F.col("side"))
    coord = F.shiftright("token", 32).cast("int")
    return dealt.select(key.alias("key"), side.alias("side"), coord.alias("coord"), "node", "posted").join(
        nodes.select("node", "signature"), "node"
    ).select("key", "side", "coord", "node", "posted", "signature")


class Group:
    """The members of one list, or of two blocks of it."""

    def __init__(self, rows: pa.Table, coordinates: int):
        self.nodes = rows.column("node").to_numpy()
        self.sides = rows.column("side").to_numpy()
        self.coords = rows.column("coord").to_numpy()
        raw = b"".join(rows.column("signature").to_pylist())
        self.signatures = np.frombuffer(raw, np.uint32).reshape(-1, coordinates)
        bits = rows.column("posted").to_numpy().view(np.uint64)
        self.posted = (bits[:, None] >> np.arange(coordinates, dtype=np.uint64)) & np.uint64(1) == 1

    def partners(self, i: int, matches: int) -> np.ndarray:
        """Later members with enough matches whose first common coordinate is this list's."""
        equal = self.signatures[i + 1 :] == self.signatures[i]
        enough = equal.sum(axis=1) >= matches
        if not enough.any():
            return np.empty(0, np.int64)
        common = equal & self.posted[i + 1 :] & self.posted[i]
        fits = (common.argmax(axis=1) == self.coords[i]) & (self.coords[i + 1 :] == self.coords[i])
        fits &= (self.sides[i + 1 :] != self.sides[i]) | (self.sides[i] == -1)
        return np.flatnonzero(enough & fits & (self.nodes[i + 1 :] != self.nodes[i])) + i + 1


def promising(rows: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """The members that have a pair over the threshold in their group."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, "key"):
            if table.num_rows < 2:
                continue
            group = Group(table, coordinates)
            keep = np.zeros(table.num_rows, bool)
            for i in range(table.num_rows - 1):
                found = group.partners(i, matches)
                if len(found):
                    keep[i] = True
                    keep[found] = True
            if keep.any():
                yield from table.filter(pa.array(keep)).to_batches()

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(chosen, MEMBER)


def shingle_sets(docs: DataFrame, wanted: DataFrame, words: int, coordinates: int) -> DataFrame:
    """The full sets of the wanted classes (`node`), as bytes, from the texts that stand for them."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words, coordinates)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [shingles.of(t).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])

    # the wanted ids grow with the input, so they are merged at every size and never broadcast
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").join(
        wanted.select("doc_id", "text_hash", "node").hint("merge"), ["doc_id", "text_hash"]
    )
    return texts.select("node", "text").mapInArrow(build, "node long, shingles binary")


def confirmed(rows: DataFrame, coordinates: int, matches: int, percent: int) -> DataFrame:
    """Links found on full sets: each group's components as (node, least node)."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_key(batches, "key"):
            group = Group(table, coordinates)
            raw = table.column("shingles").to_pylist()
            sizes = np.array([len(r) // 8 for r in raw])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            # shingles as numbers within the group, so that a set is a mask
            numbers = np.unique(np.frombuffer(b"".join(raw), np.uint64), return_inverse=True)[1]
            mask = np.zeros(numbers.max() + 1, np.int64)
            leader = np.arange(len(raw))
            for i in range(len(raw) - 1):
                found = group.partners(i, matches)
                found = found[leader[found] != leader[i]]
                if not len(found):
                    continue
                mine = numbers[ends[i] : ends[i + 1]]
                mask[mine] = 1
                for j in found.tolist():
                    both = int(mask[numbers[ends[j] : ends[j + 1]]].sum())
                    if 100 * both >= percent * (sizes[i] + sizes[j] - both) and leader[i] != leader[j]:
                        leader[leader == leader[j]] = leader[i]
                mask[mine] = 0
            least = {}
            for k, node in zip(leader.tolist(), group.nodes.tolist()):
                least[k] = min(node, least.get(k, node))
            pairs = [(node, least[k]) for k, node in zip(leader.tolist(), group.nodes.tolist()) if node != least[k]]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs)], names=["a", "b"])

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(linked, "a long, b long")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; for the options see `labelled`."""
    return labelled(docs, **options).select(
        "doc_id", "n_shingles", F.coalesce("first.doc_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("first.doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def labelled(
    docs: DataFrame, words: int = 5, percent: int = 80,
    coordinates: int = COORDINATES, miss: float = MISS, block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, text_hash, n_shingles and `first`, its component's smallest (doc_id, text_hash).

    Links are 100 * intersection >= percent * union of the sets of `words`-word shingles. Nodes are classes of equal
    sets, numbered, whatever ids their documents have. Rows without a component have no `first`.
    """
    work = Workspace(docs.sparkSession, "minhash")
    matches = match_threshold(percent / 100, coordinates, miss)
    every = work.store(signed(docs, words, coordinates), "signed")
    full = every.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = full.groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.min("signature").alias("signature")
    )
    classes = work.store(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = classes.select("node", "signature")
    posted = work.store(postings(nodes, coordinates, matches), "posted")
    groups = work.store(promising(members(posted, nodes, block), coordinates, matches), "groups")
    wanted = groups.select("node").distinct().join(classes.select("node", "first.*"), "node")
    sets = shingle_sets(docs, wanted, words, coordinates).dropDuplicates(["node"])
    links = confirmed(groups.join(sets, "node"), coordinates, matches, percent)
    links = work.store(links, "links")
    found = components(links, work)
    work.drop("groups", "posted", "links")
    # the smallest id of each component, over its classes
    rooted = found.unionAll(found.select(F.col("b").alias("a"), "b").distinct())
    firsts = rooted.join(classes.select(F.col("node").alias("a"), "first"), "a")
    firsts = firsts.groupBy("b").agg(F.min("first").alias("least"))
    rooted = rooted.join(firsts, "b").select(F.col("a").alias("node"), "least")
    named = classes.join(rooted, "node", "left").select("k1", "k2", F.coalesce("least", "first").alias("first"))
    has_node = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return every.join(named, ["k1", "k2"], "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(has_node, F.col("first")).alias("first")
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without those that are near copies of another one that is kept."""
    own = F.struct("doc_id", "text_hash")
    gone = labelled(docs, **options).where(F.col("first").isNotNull() & (F.col("first") != own))
    gone = gone.select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(gone, (docs["doc_id"] == gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_hash"]), "left_anti")


def op7(docs: DataFrame) -> DataFrame:
    """The contract's columns: three words, 85 percent."""
    return near_duplicates(docs, words=3, percent=85)
