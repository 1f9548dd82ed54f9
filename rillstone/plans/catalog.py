"""Registry of the catalogue's queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    oracle: str | None


CATALOG: dict[str, Query] = {}


def register(key: str, oracle: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        if key in CATALOG:
            raise ValueError(f"two queries are named {key}")
        CATALOG[key] = Query(run, oracle)
        return run

    return add


# Sums of doubles differ in the last bits with the order of addition. The nudge keeps values
# that lie exactly on a rounding tie from going either way.
NUDGE = 1e-9


def rounded(value: Column | str) -> Column:
    return F.round((F.col(value) if isinstance(value, str) else value) + NUDGE, 6)


def rounded_sql(value: str) -> str:
    return f"round({value} + 1e-9, 6)"


SENSOR = """
sensor as (
  select 'sensor_' || user_id as id, cast(floor(epoch(ts)) as bigint) as "timestamp",
         value as temperature, event_id as seq, event_type as kind,
         epoch_us(ts) // 1000 + (event_id * 7919) % 600000 as arrival_ms
  from events)"""

BEHAVIOR = """
behavior as (
  select user_id as "userId", cast(props->>'k' as bigint) as "itemId",
         cast(cast(props->>'k' as bigint) % 10 as int) as "categoryId",
         case when event_type = 'view' then 'pv' else event_type end as behavior,
         cast(floor(epoch(ts)) as bigint) as "timestamp"
  from events)"""

MAIL = """
mail as (
  select c_mktsegment as "appKey", cast(c_nationkey as varchar) as "appVersion",
         c_name as "deviceId", cast(c_custkey as varchar) as "phoneNo"
  from customer)"""

WORDS = """
split as (
  select doc_id, text, unnest(string_split(text, ' ')) as word,
         generate_subscripts(string_split(text, ' '), 1) as pos
  from documents),
words as (
  select doc_id, word, pos - 1 as pos
  from split
  qualify text = '' or pos <= max(case when word <> '' then pos else 0 end) over (partition by doc_id))"""

HOPS = """
hops as (
  select "itemId", cast(floor("timestamp" / 300) * 300 - k * 300 + 3600 as bigint) * 1000 as window_end
  from behavior cross join range(12) t(k)
  where behavior = 'pv'),
hop_counts as (
  select "itemId", window_end, count(*) as cnt from hops group by 1, 2),
ranked as (
  select *, row_number() over (partition by window_end order by cnt desc, "itemId") as row_num
  from hop_counts)"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"
