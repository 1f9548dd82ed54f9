"""Exact top-k inner products by elimination with a pivot table.

The distances of every vector to some pivots are computed once. By the triangle inequality each pivot bounds
the distance of a query and a candidate from below. The distances to the pivots also fix where a vector's
projection on the pivots' span lies, and how far the vector is from it, and so its distance to every point of that
span: all of these serve as pivots, and the largest of their lower bounds is the distance of two points, each
the projection with the remaining length as one more coordinate. The inner product, (|q|^2 + |x|^2 - |q - x|^2) / 2,
is then at most that of these two points. The bounds of some queries and all candidates are one matrix product.

Candidates are evaluated in the order of that bound, a growing number at a time, until the k-th best exact score is
beyond all bounds left. The scores with the pivots themselves, which are rows too, drop many at the start.

Rows are dealt to blocks and queries to blocks, and a task takes one block of each: it keeps
k rows per query, of which the best k are kept in the end. Blocks have a fixed size, so memory doesn't
grow, and many equal vectors are dealt like any others.

Defined results: vectors that are null or hold null or non-finite components, and rows with a null
id, take no part; vectors of different lengths aren't compared; ties go to the smaller id;
repeated rows are candidates each, and one query; a score beyond 64 bits is an error; other columns aren't read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import Workspace, by_key

# Fixed values of the contract.
SCALE = 256
EVERY = 50
K = 5

PIVOTS = 56
SAMPLE = 1024
ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 8192
QUERIES_AT_ONCE = 64
FIRST = 64
EXACT = 2**53

# Share of the largest singular value under which a direction of the pivots is left out, and relative slack for rounding.
DEPENDENT = 1e-4
SLACK = 1e-9


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, dim and the vector in whole numbers, as float64 bytes."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            values = np.floor(scale * lists.values.to_numpy(zero_copy_only=False).astype(np.float64))
            ends = lists.offsets.to_numpy().tolist()
            raw = [values[a:b].tobytes() for a, b in zip(ends, ends[1:])]
            dims = pa.array([b - a for a, b in zip(ends, ends[1:])], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), dims, pa.array(raw, pa.binary())], names=["vec_id", "dim", "vector"])

    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        convert, "vec_id long, dim int, vector binary"
    )


def choose_pivots(rows: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length of vector the pivots' ids and vectors, far from each other, out of a bounded sample."""
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample).collect()
    chosen = {}
    for dim in sorted({r["dim"] for r in drawn}):
        ids = np.array([r["vec_id"] for r in drawn if r["dim"] == dim])
        points = np.array([np.frombuffer(r["vector"]) for r in drawn if r["dim"] == dim]).reshape(len(ids), dim)
        picked = [0]
        far = distances(points, points[:1])[:, 0]
        while len(picked) < min(pivots, len(ids)) and far.max() > 0:
            picked.append(int(far.argmax()))
            far = np.minimum(far, distances(points, points[picked[-1:]])[:, 0])
        chosen[dim] = (ids[picked], points[picked])
    return chosen


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def products(a: np.ndarray, b: np.ndarray, largest: float | None = None) -> np.ndarray:
    """Exact inner products of whole-number rows, none above `largest`, with one vector, as int64."""
    if largest is None:
        largest = np.abs(a).max(initial=0)
    if not a.size or largest * np.abs(b).max() * len(b) < EXACT:
        return (a @ b).astype(np.int64)
    exact = [sum(int(x) * int(y) for x, y in zip(row, b)) for row in a]
    if any(abs(x) >= 2**63 for x in exact):
        raise OverflowError("a score doesn't fit 64 bits")
    return np.array(exact, np.int64)


class Pivots:
    """Pivots, and what the distances to them tell of a vector."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.squares = (points * points).sum(1)
        u, s, _ = np.linalg.svd(points, full_matrices=False)
        kept = s > DEPENDENT * s.max(initial=0)
        self.combine = u[:, kept] / s[kept]

    def corners(self, rows: np.ndarray) -> np.ndarray:
        """Per row its projection's coordinates, the remaining length and a share of slack: the inner product
        of two rows is at most that of their corners."""
        squares = (rows * rows).sum(1)
        table = distances(rows, self.points) ** 2
        inner = (squares[:, None] + self.squares[None] - table) / 2
        places = inner @ self.combine
        # distances lose digits where pivots are longer than the vector
        scale = np.sqrt(squares) + np.sqrt(self.squares.max(initial=0))
        rest = np.sqrt(np.maximum(squares - (places * places).sum(1), 0) + SLACK * scale * scale)
        return np.column_stack([places, rest, np.sqrt(SLACK) * scale])


class Block:
    """Candidates of one task: vectors, ids and corners."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, pivots: Pivots):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points, self.pivots = ids[order], points[order], pivots
        self.corners = np.ascontiguousarray(pivots.corners(self.points).T)
        self.largest = np.abs(self.points).max(initial=0)
        self.evaluated = 0

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Per query and candidate a number that their inner product is not above."""
        bounds = self.pivots.corners(queries) @ self.corners + 1e-6
        bounds[np.isnan(bounds)] = np.inf
        return bounds

    def best(self, query_id: int, query: np.ndarray, bounds: np.ndarray, k: int, at_least: float) -> tuple[np.ndarray, np.ndarray]:
        """The k best (score, id): ids and scores. The bounds of candidates that are done with become nan."""
        bounds[np.searchsorted(self.ids, query_id) : np.searchsorted(self.ids, query_id, "right")] = np.nan
        rows, scores, step = np.empty(0, np.int64), np.empty(0, np.int64), FIRST
        while len(more := np.flatnonzero(bounds >= at_least)):
            if len(more) > step:
                more = more[np.argpartition(-bounds[more], step)[:step]]
            bounds[more] = np.nan
            self.evaluated += len(more)
            rows = np.concatenate([rows, more])
            scores = np.concatenate([scores, products(self.points[more], query, self.largest)])
            keep = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[keep], scores[keep]
            if len(rows) == k:
                at_least = max(at_least, float(scores[-1]))
            step *= 4
        return self.ids[rows], scores

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, known: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each query's place among the given ones, and the ids and scores of its k best candidates; `known` are the pivots' ids."""
        for start in range(0, len(ids), QUERIES_AT_ONCE):
            bounds = self.bounds(queries[start : start + QUERIES_AT_ONCE])
            for at, row in enumerate(bounds, start):
                seeds = np.sort(products(self.pivots.points[known != ids[at]], queries[at]))
                yield at, *self.best(ids[at], queries[at], row, k, float(seeds[-k]) if len(seeds) >= k else -np.inf)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, which are the ids divisible by `every`."""
    work = Workspace(vectors.sparkSession, "topk")
    rows = work.store(scaled(vectors), "scaled")
    chosen = choose_pivots(rows, pivots)
    sent = {d: (ids.tolist(), base64.b64encode(points.tobytes()).decode()) for d, (ids, points) in chosen.items()}
    queries = rows.where(F.col("vec_id") % every == 0).distinct()
    n, m = rows.count(), queries.count()
    row_blocks, query_blocks = -(-n // ROWS_PER_BLOCK) or 1, -(-m // QUERIES_PER_BLOCK) or 1
    deal = F.xxhash64("vec_id", "vector")
    # every pair of a block of rows and a block of queries is a group
    left = rows.withColumn("r", F.pmod(deal, F.lit(row_blocks))).withColumn(
        "q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    ).withColumn("asks", F.lit(False))
    right = queries.withColumn("q", F.pmod(deal, F.lit(query_blocks))).withColumn(
        "r", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))
    ).withColumn("asks", F.lit(True))
    columns = ["r", "q", "dim", "asks", "vec_id", "vector"]
    both = left.select(F.col("r").cast("long").alias("r"), F.col("q").cast("long").alias("q"), *columns[2:]).unionByName(
        right.select(F.col("r").cast("long").alias("r"), F.col("q").cast("long").alias("q"), *columns[2:])
    )
    pairs = both.select(F.concat_ws("-", "dim", "r", "q").alias("key"), "dim", "asks", "vec_id", "vector")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {d: (np.array(ids), np.frombuffer(base64.b64decode(p)).reshape(len(ids), d)) for d, (ids, p) in sent.items()}
        for table in by_key(batches, "key"):
            dim = table.column("dim")[0].as_py()
            asks = table.column("asks").to_numpy()
            ids = table.column("vec_id").to_numpy()
            raw = table.column("vector").to_pylist()
            points = np.frombuffer(b"".join(raw)).reshape(len(raw), dim)
            pivot_ids, pivot_points = known.get(dim, (np.empty(0, int), np.empty((0, dim))))
            block = Block(ids[~asks], points[~asks], Pivots(pivot_points))
            vectors = np.array(raw, object)[asks]
            found = [
                (int(ids[asks][at]), vectors[at], int(i), int(s))
                for at, best, scores in block.search(ids[asks], points[asks], k, pivot_ids) for i, s in zip(best, scores)
            ]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.binary(), pa.int64(), pa.int64()))],
                    names=["query_id", "query", "vec_id", "score"],
                )

    found = pairs.repartition("key").sortWithinPartitions("key").mapInArrow(
        searched, "query_id long, query binary, vec_id long, score long"
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op6(vectors: DataFrame) -> DataFrame:
    """The contract's columns."""
    return top_k(vectors)


ORACLE = f"""
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, x.vec_id, list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2]))::bigint as score
  from whole q join whole x on q.vec_id % {EVERY} = 0 and q.vec_id <> x.vec_id),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= {K}
"""
