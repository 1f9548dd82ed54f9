"""Mixing sources to target weights: random keys, distributed prefix sums and exact cuts.

Each document gets a hash-random key. Within its source the documents are ordered by key, a
prefix sum of their sizes says which words come before each, and the source's budget is cut there:
whole epochs first, then the first documents of one more epoch. The prefix sums need no task that
sees a whole source: keys are cut into ranges of a few thousand documents, the ranges' totals are
summed up in order, and a window runs inside each range. So a source that holds most rows is spread
like any other. Everything is built from DataFrame functions.

Defined results: null texts have size 0 and are taken 0 times; a null source is a source of its own,
ordered last; repeated rows are separate documents next to each other in the order (rows alike in id and
text share a key, so all repeats of one row lie in one range); an empty table
gives an empty mix. Reruns agree, as nothing depends on partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import Workspace, words_of

# Fixed values of the contract.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2

ROWS_PER_RANGE = 4096


def n_words(text: Column | str) -> Column:
    return F.size(words_of(text)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = MAX_EPOCHS) -> DataFrame:
    """Each source's target: its share by weight, stopped at `cap` times its size.

    Resharing what the stopped sources leave ends where all others have one quotient of target
    and weight. In the order of size by weight the stopped sources come first, so running totals
    give that quotient at once. One row per source goes in and out.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    step = sizes.withColumn("weight", weight.cast("long"))
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.lit(cap) * F.col("source_size")
    spent = F.coalesce(F.sum(full).over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.lit(share) * F.sum("source_size").over(everything) - spent) / open_weight
    step = step.withColumn("level", level).withColumn("stopped", full <= F.col("level") * F.col("weight"))
    # the quotient of the first source that isn't stopped holds for all that follow
    shared = F.first(F.when(~F.col("stopped"), F.col("level")), ignorenulls=True).over(everything)
    target = F.when(F.col("stopped"), full.cast("double")).otherwise(shared * F.col("weight"))
    return step.select("source", "source_size", target.alias("target"))


def plan_mix(
    docs: DataFrame, size: Column, purpose: str = "mix", row: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = MAX_EPOCHS,
    ranges: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Every document with its size, its source's size and target, and the words before it.

    Columns: doc_id, `row` (what the caller wants to keep), size, source_size, target, `epochs` (whole passes over
    the source), `rest` (words of one more pass) and `before` (words of the source ahead of it).
    """
    spark = docs.sparkSession
    work = Workspace(spark, purpose)
    # rows without an id, or with one id, still get keys of their own
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    key = F.md5(named.cast("binary"))
    keyed = work.store(
        docs.select(
            "doc_id", "source", size.alias("size"), key.alias("key"),
            (F.lit(None).cast("int") if row is None else row).alias("row"),
        ),
        "keyed",
    )
    per_source = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    most = per_source.agg(F.max("n").alias("n")).first()["n"] or 0
    digits = 0
    while most > ranges * 16**digits:
        digits += 1
    keyed = keyed.withColumn("range", F.substring("key", 1, digits))
    totals = keyed.groupBy("source", "range").agg(F.sum("size").alias("total"))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("source", "range", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("start"))
    plan = targets(per_source.drop("n"), weights, share, cap)
    budget = F.floor("target")
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", (budget - F.col("epochs") * F.col("source_size")).cast("long"))
    starts = starts.alias("s").join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))).select(
        "s.source", "range", "start", "source_size", "target", "epochs", "rest"
    )
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    keyed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return keyed.alias("d").join(
        starts.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("d.range") == F.col("t.range"))
    ).select(
        "d.doc_id", "d.row", "d.size", "t.source_size", "t.target", "t.epochs", "t.rest",
        (F.col("t.start") + F.col("d.inside")).alias("before"),
    )


def op3(docs: DataFrame) -> DataFrame:
    """The contract's columns: words taken of each document, cut at the exact budget."""
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return plan_mix(docs, n_words("text"), "op3").select(
        "doc_id", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves, repeated as often as they are taken.

    Documents stay whole: the one at the cut is taken if at least half of it lies in the budget.
    """
    mix = plan_mix(docs, n_words("text"), "mix", row=F.struct(*[F.col(c) for c in docs.columns]), **options)
    last = (2 * (F.col("rest") - F.col("before")) >= F.col("size")) & (F.col("rest") > F.col("before"))
    copies = (F.col("epochs") + F.when(last, 1).otherwise(0)).cast("int")
    return mix.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).select("row.*")


ORACLE = rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as key
  from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from sources),
levels as (
  select *, (1.5 * sum(source_size) over () - coalesce(sum(2 * source_size) over before, 0))
            / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
  from weighed
  window before as (order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
stops as (select *, 2 * source_size <= level * weight as stopped from levels),
plan as (
  select source, source_size,
         case when stopped then (2 * source_size)::double
              else (select max(level) from stops where not stopped) * weight end as target
  from stops),
placed as (
  select d.doc_id, size, source_size, target, floor(target)::bigint as budget,
         coalesce(sum(size) over (partition by d.source order by key, d.doc_id, size
                                  rows between unbounded preceding and 1 preceding), 0) as before
  from sized d join plan p on d.source is not distinct from p.source)
select doc_id, size, source_size, target,
       (case when source_size = 0 then 0 else budget // source_size * size
          + greatest(0, least(size, budget % source_size - before)) end)::bigint as taken
from placed
"""
