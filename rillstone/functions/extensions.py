"""Extension points: user scalar, table and aggregate functions.

The native column functions are the fast path. These helpers put a user's own function
behind the same names for both DataFrame and SQL use; the Python ones move Arrow batches.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import PandasUDFType, arrow_udf, pandas_udf, udtf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def register_scalar(
    spark: SparkSession, name: str, fn: Callable[[pd.Series], pd.Series], returns: str
) -> Callable[..., Column]:
    """A vectorised scalar function, callable from SQL by name and from DataFrames."""
    wrapped = pandas_udf(fn, returns)
    spark.udf.register(name, wrapped)
    return wrapped


def register_sql_scalar(spark: SparkSession, name: str, args: str, returns: str, body: str) -> None:
    """A scalar function written as a SQL expression: it is inlined and stays in the JVM."""
    spark.sql(f"create or replace temporary function {name}({args}) returns {returns} return {body}")


def register_table_function(spark: SparkSession, name: str, handler: type, returns: str):
    """A row-to-rows function; `handler.eval` yields tuples."""
    wrapped = udtf(handler, returnType=returns)
    spark.udtf.register(name, wrapped)
    return wrapped


def average_from_parts(value: Column) -> Column:
    """An average written as its accumulator, sum over count; nulls are skipped."""
    return F.sum(value) / F.count(value)


def map_with_setup(
    df: DataFrame,
    setup: Callable[[], object],
    apply: Callable[[object, pd.DataFrame], pd.DataFrame],
    teardown: Callable[[object], None],
    schema: str,
) -> DataFrame:
    """A batch-wise map with a hook before a partition's first batch and one after its last."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = setup()
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            teardown(resource)

    return df.mapInPandas(run, schema)


class Accumulator:
    """A user aggregate with partial results: subclass and give the four steps.

    `buffer` is the DDL schema of the partial result and `returns` that of the value.
    """

    buffer: str
    returns: str

    def create(self) -> tuple:
        raise NotImplementedError

    def add(self, acc: tuple, value: object) -> tuple:
        raise NotImplementedError

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def result(self, acc: tuple) -> object:
        raise NotImplementedError


# A task hands on its partial results when it holds this many keys; exact at any setting.
PARTIAL_KEYS = 100_000


def aggregate_by_key(
    df: DataFrame, key: str, value: str, agg: Accumulator, name: str
) -> DataFrame:
    """Run a user accumulator per key with partial results before the shuffle.

    Each task folds its own rows into one partial result per key; only partial results are
    shuffled. They arrive sorted by key and are merged one key after the other, so neither
    a hot key nor a large number of keys is held in memory.
    """
    key_type = df.schema[key].dataType.simpleString()
    width = len(StructType.fromDDL(agg.buffer))

    def batch_of(rows: list[tuple], like: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[] for _ in like]
        return pa.record_batch([pa.array(c, t.type) for c, t in zip(columns, like)], schema=like)

    partial_schema = f"`{key}` {key_type}, {agg.buffer}"
    partial_arrow = to_arrow_schema(StructType.fromDDL(partial_schema))
    result_schema = f"`{key}` {key_type}, `{name}` {agg.returns}"
    result_arrow = to_arrow_schema(StructType.fromDDL(result_schema))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[k] = agg.add(held[k] if k in held else agg.create(), v)
            if len(held) >= PARTIAL_KEYS:
                yield batch_of([(k, *acc) for k, acc in held.items()], partial_arrow)
                held = {}
        yield batch_of([(k, *acc) for k, acc in held.items()], partial_arrow)

    def merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        for batch in batches:
            done = []
            columns = [batch.column(i).to_pylist() for i in range(width + 1)]
            for k, *acc in zip(*columns):
                if current is not None and current[0] == k:
                    current = (k, agg.merge(current[1], tuple(acc)))
                else:
                    if current is not None:
                        done.append((current[0], agg.result(current[1])))
                    current = (k, tuple(acc))
            yield batch_of(done, result_arrow)
        if current is not None:
            yield batch_of([(current[0], agg.result(current[1]))], result_arrow)

    partials = df.select(key, value).mapInArrow(fold, partial_schema)
    by_key = partials.repartition(F.col(key)).sortWithinPartitions(key)
    return by_key.mapInArrow(merge_sorted, result_schema)


def register_aggregate(spark: SparkSession, name: str, agg: Accumulator) -> None:
    """Make a user aggregate callable by name in SQL and in `F.call_function`.

    SQL functions can't hand on partial results, so this form folds a group's rows in one task: it is
    for groups of bounded size. `aggregate_by_key` is the form for hot keys. In a column of
    doubles a NaN reads as null.
    """

    def fold(values: pd.Series):
        acc = agg.create()
        for v in values:
            acc = agg.add(acc, None if v is None or v != v else v)
        return agg.result(acc)

    spark.udf.register(name, pandas_udf(fold, agg.returns, PandasUDFType.GROUPED_AGG))


# Rows and partial results that one call of a two-level aggregate gets at most, for each key.
PART_ROWS = 100_000


def register_two_level(spark: SparkSession, name: str, agg: Accumulator) -> None:
    """A user aggregate as three functions callable by name in SQL, for groups of any size.

    Each gets what `collect_list` gathered of its groups: `<name>_part` folds values (in a struct each, so that nulls
    count) into a binary partial result, `<name>_more` merges partial results into one, and `<name>` gives the
    value. A call handles the lists of an Arrow batch, some thousands of groups; `parted` tells the parts that rows belong
    to, which bounds a list. In a column of doubles a NaN reads as null.
    """

    def lists(column: pa.Array) -> Iterator[list]:
        """The values of every list, made Python values a list at a time."""
        ends, values = column.offsets.to_pylist(), column.values
        if pa.types.is_struct(values.type):
            values = values.field(0)
        for start, end in zip(ends, ends[1:]):
            yield values.slice(start, end - start).to_pylist()

    def folded(values: list) -> bytes:
        acc = agg.create()
        for v in values:
            acc = agg.add(acc, None if v is None or v != v else v)
        return pickle.dumps(acc)

    def merged(partials: list) -> tuple:
        acc = agg.create()
        for p in partials:
            acc = agg.merge(acc, pickle.loads(p))
        return acc

    def part(column: pa.Array) -> pa.Array:
        return pa.array(map(folded, lists(column)), pa.binary())

    def more(column: pa.Array) -> pa.Array:
        return pa.array((pickle.dumps(merged(p)) for p in lists(column)), pa.binary())

    returns = to_arrow_schema(StructType.fromDDL(f"v {agg.returns}")).field(0).type

    def result(column: pa.Array) -> pa.Array:
        return pa.array((agg.result(merged(p)) for p in lists(column)), returns)

    for suffix, fn, kind in (("_part", part, "binary"), ("_more", more, "binary"), ("", result, agg.returns)):
        spark.udf.register(name + suffix, arrow_udf(fn, kind))


def parted(df: DataFrame, rows: int = PART_ROWS) -> DataFrame:
    """The rows with the number of their part (`part`): at most `rows` consecutive rows of a task."""
    return df.withColumn("part", F.expr(f"monotonically_increasing_id() div {rows}"))


def two_level_sql(name: str, key: str, value: str, view: str, out: str, rows: int = PART_ROWS) -> str:
    """The SQL of a two-level aggregate over a view made by `parted`: parts, groups of parts, keys."""
    return (
        f"select `{key}`, {name}(collect_list(p)) as `{out}` from ("
        f"select `{key}`, {name}_more(collect_list(p)) as p from ("
        f"select `{key}`, part, {name}_part(collect_list(struct(`{value}`))) as p from {view} group by `{key}`, part"
        f") group by `{key}`, part div {rows}) group by `{key}`"
    )


class TableAccumulator(Accumulator):
    """A user aggregate whose result is several rows: `returns` is their DDL schema.

    `result` gives a list of tuples.
    """


def table_aggregate_by_key(df: DataFrame, key: str, value: str, agg: TableAccumulator) -> DataFrame:
    """Run a user table aggregate per key, with partial results before the shuffle."""
    shape = StructType.fromDDL(agg.returns)

    class Listed(Accumulator):
        buffer, returns = agg.buffer, f"array<{shape.simpleString()}>"
        create, add, merge = (staticmethod(f) for f in (agg.create, agg.add, agg.merge))

        def result(self, acc):
            return [dict(zip(shape.names, row)) for row in agg.result(acc)]

    return aggregate_by_key(df, key, value, Listed(), "__rows").select(key, F.inline("__rows"))


class _Reducer(Accumulator):
    def __init__(self, fn: Callable[[object, object], object], dtype: str):
        self.fn, self.buffer, self.returns = fn, f"acc {dtype}", dtype

    def create(self) -> tuple:
        return (None,)

    def add(self, acc: tuple, value: object) -> tuple:
        return self.merge(acc, (value,))

    def merge(self, a: tuple, b: tuple) -> tuple:
        if a[0] is None or b[0] is None:
            return b if a[0] is None else a
        return (self.fn(a[0], b[0]),)

    def result(self, acc: tuple) -> object:
        return acc[0]


def reduce_by_key(
    df: DataFrame, key: str, value: str, fn: Callable[[object, object], object], name: str
) -> DataFrame:
    """A user's pairwise reducer per key; it must be associative and commutative.

    Reducers that depend on arrival order are the running operators' work.
    """
    dtype = df.schema[value].dataType.simpleString()
    return aggregate_by_key(df, key, value, _Reducer(fn, dtype), name)
