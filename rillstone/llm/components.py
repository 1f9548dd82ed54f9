"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import Workspace


SALTS = 64


def with_least(edges: DataFrame) -> DataFrame:
    """The edges with the least neighbour of their node `a`.

    A node's edges are dealt over `SALTS` tasks: first the least of each share is found, then the least of at most
    `SALTS` rows per node, which goes back to every share.
    """
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    shares = dealt.groupBy("a", "salt").agg(F.min("b").alias("least"))
    least = shares.select("a", "salt", F.min("least").over(Window.partitionBy("a")).alias("least"))
    return dealt.join(least, ["a", "salt"]).select("a", "b", "least")


def outward(edges: DataFrame) -> DataFrame:
    """Connect each node's larger neighbours to the least node next to it."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = with_least(both).where("b > a")
    return near.select(F.col("b").alias("a"), F.least("a", "least").alias("b"))


def inward(edges: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the least of them; every edge leads down."""
    near = with_least(edges)
    moved = near.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(near.where("b = least").select("a", "b"))


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """Nodes (`a`) that aren't the least of their component, with that least node (`b`).

    `edges` has columns a and b, in any direction. Each round is written to the shared folder. The
    number of rounds is about the logarithm of the longest path. No node's edges meet in a task: they are
    dealt by their other end, and only the least of each share meets the others.
    """
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, now = None, work.store(down, "edges-0")
    for step in range(1, 200):
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state:
            return now
        state = tuple(found)
        after = work.store(inward(outward(now).distinct()).distinct(), f"edges-{step}")
        work.drop(f"edges-{step - 1}")
        now = after
    raise RuntimeError("the components did not settle")
