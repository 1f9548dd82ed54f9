"""Ordered per-key computations that stay parallel inside a hot key.

A plain `Window.partitionBy(key).orderBy(seq)` puts all rows of a key into one task. Here
the order column is cut into blocks and rows are shuffled by (key, block). What a block
needs from earlier blocks enters it as a few extra rows:

* `running` gives every block one seed row holding the folded partial results of all
  earlier blocks of its key, found from one small summary row per (key, block);
* `over_preceding` gives every block copies of the n rows before it.

After that an ordinary window function over (key, block) yields the exact result. Order
columns must not be null.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK = "__block"
IS_ROW = "__is_row"
HEAVY = "__heavy"

# A key is cut only if its bucket holds more than this share of all rows, so fewer than 10,000 buckets are; their table
# is sent to all executors. A key that stays whole is no larger than that share of the work.
HEAVY_SHARE = 10_000

# Rows are counted by a hash of their key into so many buckets, whose counts fit into every task's memory; the keys' own
# counts may be as many as the rows.
BUCKETS = 1 << 16
BUCKET = "__bucket"


@dataclass(frozen=True)
class Blocks:
    """Blocks of `width` units of an integer column, the leading order column.

    With `heavy_rows`, only keys in buckets with more rows than that, and more than a 10,000th of all rows, are cut;
    all others stay whole, as in a plain window, and need neither summaries nor seeds.
    """

    column: str
    width: int
    heavy_rows: int | None = None

    def of(self) -> Column:
        return F.expr(f"`{self.column}` div {self.width}L")

    def heavy(self, df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
        """The buckets whose keys are cut; None if all keys are. Every key with too many rows is in one of them."""
        if self.heavy_rows is None or not keys:
            return None
        counts = df.groupBy(bucket_of(keys).alias(BUCKET)).agg(F.count(F.lit(1)).alias("__n"))
        # one row with all buckets, so that the rows are counted once and not again for their total
        held = counts.agg(F.sum("__n").alias("__total"), F.collect_list(F.struct(BUCKET, "__n")).alias("__counts"))
        counts = held.select("__total", F.inline("__counts"))
        most = counts.filter((F.col("__n") > self.heavy_rows) & (F.col("__n") * HEAVY_SHARE > F.col("__total")))
        return most.select(BUCKET, F.lit(True).alias(HEAVY))

    def cut(self, df: DataFrame, keys: Sequence[str], heavy: DataFrame | None = None) -> DataFrame:
        """Add the block of every row, and whether its key is cut."""
        cut = flagged(df, keys, self.heavy(df, keys) if heavy is None else heavy)
        return cut.withColumn(BLOCK, F.when(F.col(HEAVY), self.of()).otherwise(F.lit(0).cast("bigint")))

    @classmethod
    def fit(cls, df: DataFrame, column: str, rows: int = 1_000_000) -> Blocks:
        """A width that keeps even the densest block within twice `rows` rows.

        Reads only this column; the driver gets a handful of numbers.
        """
        lo, hi, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
        if not n or n <= rows:
            return cls(column, max(1, 2 * max(abs(lo or 0), abs(hi or 0)) + 1))
        blocks = cls(column, max(1, (hi - lo + 1) * rows // n))
        while blocks.width > 1:
            densest = df.groupBy(blocks.of()).count().agg(F.max("count")).first()[0]
            if densest <= 2 * rows:
                break
            blocks = cls(column, max(1, blocks.width * rows // densest))
        return blocks


def bucket_of(keys: Sequence[str]) -> Column:
    # null is a key like any other
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def flagged(df: DataFrame, keys: Sequence[str], heavy: DataFrame | None) -> DataFrame:
    """Add whether a row's key is cut."""
    if heavy is None:
        return df.withColumn(HEAVY, F.lit(True))
    known = df.withColumn(BUCKET, bucket_of(keys)).join(F.broadcast(heavy), BUCKET, "left").drop(BUCKET)
    return known.withColumn(HEAVY, F.coalesce(F.col(HEAVY), F.lit(False)))


@dataclass(frozen=True)
class Running:
    """A running aggregate.

    `row` is what one row contributes, `part` the same aggregate over a whole block, and
    `fold` merges contributions in order. With `before` the current row is left out.
    """

    row: Column
    part: Column
    fold: Callable[[Column], Column]
    before: bool = False


def running_count(before: bool = False) -> Running:
    one = F.lit(1).cast("bigint")
    return Running(one, F.count(F.lit(1)), F.sum, before)


def running_sum(value: Column, before: bool = False) -> Running:
    return Running(value, F.sum(value), F.sum, before)


def running_max(value: Column, before: bool = False) -> Running:
    return Running(value, F.max(value), F.max, before)


def running_min(value: Column, before: bool = False) -> Running:
    return Running(value, F.min(value), F.min, before)


def running_first(value: Column, order: Sequence[str]) -> Running:
    return Running(value, F.min_by(value, _order_key(order)), F.first)


def _order_key(order: Sequence[str]) -> Column:
    # One numeric column keeps the aggregation buffer fixed-size, hence hash-aggregable.
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: Blocks,
    measures: Mapping[str, Running], initial: DataFrame | None = None,
) -> DataFrame:
    """Add running aggregates per key in the given order (`order[0]` is the block column).

    `initial` holds what came before these rows, as `running_state` gives it.
    """
    keys = list(keys)
    slots = {name: f"__m{i}" for i, name in enumerate(measures)}
    heavy = blocks.heavy(df, keys)
    cut = blocks.cut(df, keys, heavy)
    rows = with_slots(cut, measures, slots).withColumn(IS_ROW, F.lit(True)).unionByName(
        seeds(cut, keys, measures, slots, heavy, initial).withColumn(IS_ROW, F.lit(False)), allowMissingColumns=True
    )

    window = Window.partitionBy(*keys, BLOCK).orderBy(IS_ROW, *order)
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    prior = window.rowsBetween(Window.unboundedPreceding, -1)
    folded = rows.select(
        *df.columns,
        IS_ROW,
        *[
            m.fold(F.col(slots[n])).over(prior if m.before else upto).alias(n)
            for n, m in measures.items()
        ],
    )
    return folded.filter(IS_ROW).drop(IS_ROW)


def with_slots(cut: DataFrame, measures: Mapping[str, Running], slots: Mapping[str, str]) -> DataFrame:
    """Add what every row contributes to the measures."""
    return cut.withColumns({slots[n]: m.row for n, m in measures.items()})


def seeds(
    cut: DataFrame, keys: Sequence[str], measures: Mapping[str, Running], slots: Mapping[str, str],
    heavy: DataFrame | None = None, initial: DataFrame | None = None, cut_by: Sequence[str] | None = None,
) -> DataFrame:
    """What every block starts from: the folded partial results of the key's earlier blocks.

    `cut` is what `Blocks.cut` gives for the keys in `cut_by` (`keys`, or some of them), `heavy` the buckets it went by.
    """
    # A key in one block passes nothing on within these rows: it starts from what came before them.
    summary = cut.filter(HEAVY).groupBy(*keys, BLOCK).agg(*[m.part.alias(slots[n]) for n, m in measures.items()])
    whole = None
    if initial is not None:
        given = initial.select(*keys, *[F.col(n).alias(slots[n]) for n in measures])
        if heavy is not None:
            given = flagged(given, cut_by or keys, heavy)
            whole = given.filter(~F.col(HEAVY)).withColumn(BLOCK, F.lit(0).cast("bigint")).drop(HEAVY)
            given = given.filter(HEAVY).drop(HEAVY)
        summary = summary.unionByName(given.withColumn(BLOCK, F.lit(None).cast("bigint")))
    # One row per (key, block): small, and bounded by the number of blocks for any key.
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    folded = (
        summary.select(
            *keys,
            BLOCK,
            *[m.fold(F.col(slots[n])).over(earlier).alias(slots[n]) for n, m in measures.items()],
            F.row_number().over(Window.partitionBy(*keys).orderBy(BLOCK)).alias("__earlier"),
        )
        .filter(F.col("__earlier") > 1)
        .drop("__earlier")
    )
    return folded if whole is None else folded.unionByName(whole)


def running_state(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, Running], initial: DataFrame | None = None
) -> DataFrame:
    """The folded value of every measure per key after all rows: what the next rows start from."""
    keys = list(keys)
    state = df.groupBy(*keys).agg(*[m.part.alias(n) for n, m in measures.items()])
    if not keys:
        state = state.filter(F.exists(F.array(*[F.col(n).isNotNull() for n in measures]), lambda x: x))
    if initial is None:
        return state
    both = state.withColumn("__age", F.lit(1)).unionByName(initial.withColumn("__age", F.lit(0)))
    by_age = Window.partitionBy(*keys).orderBy("__age")  # two rows per key at most
    whole = by_age.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    folded = both.select(
        *keys, *[m.fold(F.col(n)).over(whole).alias(n) for n, m in measures.items()],
        F.row_number().over(by_age).alias("__nth"),
    )
    return folded.filter("__nth = 1").drop("__nth")


def over_preceding(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: Blocks, n: int,
    columns: Sequence[str], exprs: Mapping[str, Callable[[WindowSpec], Column]],
    initial: DataFrame | None = None,
) -> DataFrame:
    """Add window expressions that look back at most n rows of the key.

    `columns` are the columns the expressions read. Each expression gets the window, ordered,
    to which it may add a frame such as `rowsBetween(-n, 0)`. `initial` holds the rows that
    came before, as `preceding_state` gives them.
    """
    keys, order = list(keys), list(order)
    heavy = blocks.heavy(df, keys)
    cut = blocks.cut(df, keys, heavy)
    halo = halos(cut, keys, order, n, _held(order, columns), heavy, initial)
    rows = cut.withColumn(IS_ROW, F.lit(True)).unionByName(
        halo.withColumn(IS_ROW, F.lit(False)), allowMissingColumns=True
    )
    window = Window.partitionBy(*keys, BLOCK).orderBy(*order)
    looked = rows.select(*df.columns, IS_ROW, *[fn(window).alias(a) for a, fn in exprs.items()])
    return looked.filter(IS_ROW).drop(IS_ROW)


def halos(
    cut: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, held: Sequence[str],
    heavy: DataFrame | None = None, initial: DataFrame | None = None,
) -> DataFrame:
    """Copies of the n rows before every block of a key. `cut` and `heavy` as for `seeds`."""
    keys = list(keys)
    tails = _tails(cut.filter(HEAVY), [*keys, BLOCK], order, n, held)
    tails = tails.groupBy(*keys, BLOCK).agg(
        F.collect_list(F.struct(*held)).alias("__tail")  # at most n per group
    )
    whole = None
    if initial is not None:
        given = initial
        if heavy is not None:
            given = flagged(initial, keys, heavy)
            whole = given.filter(~F.col(HEAVY)).withColumn(BLOCK, F.lit(0).cast("bigint"))
            whole = whole.select(*keys, BLOCK, *[c for c in held if c not in keys])
            given = given.filter(HEAVY)
        given = given.groupBy(*keys).agg(F.collect_list(F.struct(*held)).alias("__tail"))
        tails = tails.unionByName(given.withColumn(BLOCK, F.lit(None).cast("bigint")))
    # Every block of a key holds a row, so its n predecessors lie in the n blocks before it.
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(-n, -1)
    carried = F.flatten(F.collect_list("__tail").over(earlier))
    nearest = tails.select(*keys, BLOCK, F.slice(F.sort_array(carried, False), 1, n).alias("__near"))
    near = nearest.select(*keys, BLOCK, F.explode("__near").alias("__h")).select(
        *keys, BLOCK, *[F.col("__h")[c].alias(c) for c in held if c not in keys]
    )
    return near if whole is None else near.unionByName(whole)


def preceding_state(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, columns: Sequence[str],
    initial: DataFrame | None = None,
) -> DataFrame:
    """The last n rows per key, those the next rows look back at."""
    wanted = list(dict.fromkeys([*keys, *_held(order, columns)]))
    rows = df.select(*wanted)
    if initial is not None:
        rows = rows.unionByName(initial.select(*wanted))
    return _tails(rows, list(keys), list(order), n, _held(order, columns)).select(*wanted)


def _tails(
    df: DataFrame, groups: list[str], order: list[str], n: int, held: Sequence[str]
) -> DataFrame:
    """The last n rows of every group."""
    others = [c for c in held if c not in groups]
    if n == 1 and len(order) == 1:
        # Fixed-size aggregates: no sort, and combined before the shuffle.
        at = order[0]
        picks = [F.max(c) if c == at else F.max_by(c, at) for c in others]
        return df.groupBy(*groups).agg(*[p.alias(c) for p, c in zip(picks, others)])
    last = Window.partitionBy(*groups).orderBy(*[F.desc(c) for c in order])
    ranked = df.select(*groups, *others, F.row_number().over(last).alias("__rn"))
    return ranked.filter(F.col("__rn") <= n).drop("__rn")


def _held(order: Sequence[str], columns: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([*order, *columns]))
