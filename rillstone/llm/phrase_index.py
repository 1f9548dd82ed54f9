"""Benchmark decontamination with a distributed positional inverted index.

`build_index` writes one posting (document row, term, position) for every occurrence of a test term in
the training texts, and one posting of term 0 that holds a text's length. `rank_terms` counts the stored
postings of each term, so the rarest terms of every test phrase are known. A phrase is found by
intersecting position lists from its rarest term on: a posting at position p of the term that is the
phrase's i-th word may start the phrase at p - i, the next rarest term must then be posted at its own
offset, and only the few starts that are left are compared with the lists of all other terms.
`proximity_matches` intersects the same lists with a slack instead of an offset.

Everything is DataFrame operations. Test terms are sent to the executors in parts of at most
`PART` rows, one pass each, so what is broadcast doesn't grow; hot terms are never a shuffle key, as lists
are joined by document row. Texts are read once per part, and after that only the postings.

Defined results: a null or empty text, or one without a word, has no words and no hits; null items, and
items without a word, match nothing; items with the same words are found each; an item with a null id
marks words but is not among the items counted; rows that share a doc_id, and null ids, are judged row by
row; empty tables give no rows, or documents without hits; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.llm.common import Workspace

# Fixed values of the contract: everything but digits, letters and what lies beyond ASCII separates words.
BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10

PART = 200_000


def lowered(text: Column) -> Column:
    """A-Z in lower case. `lower` is faster, and is the same where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: str) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(F.col(text), F.lit(""))), BREAKS), "")


def parts(df: DataFrame, key: str, most: int = PART) -> list[DataFrame]:
    """The stored rows in parts of about `most` rows by hash of `key`, each fit to be broadcast."""
    n = max(1, -(-df.count() // most))
    each = [df] if n == 1 else [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]
    return [F.broadcast(part) for part in each]


def phrase_windows(items: DataFrame, work: Workspace, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The different windows (`win`, its `words`) of all items, and which items hold them."""
    words = items.select("item_id", words_of("text").alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - width + 1))
    each = words.select("item_id", "words", F.explode(starts).alias("start")).select(
        "item_id", F.slice("words", F.col("start"), width).alias("words")
    )
    each = work.store(each.distinct(), "item-windows")
    windows = each.select("words").distinct().withColumn("win", F.monotonically_increasing_id())
    windows = work.store(windows, "windows")
    holders = each.where("item_id is not null").join(windows, "words").select("win", F.col("item_id").cast("string").alias("item_id"))
    return windows, work.store(holders, "holders")


def build_index(docs: DataFrame, windows: DataFrame, work: Workspace, most: int = PART) -> tuple[DataFrame, DataFrame]:
    """The terms (`word`, `term` from 1), and the postings (`row`, `doc_id`, `term`, `pos`) of the documents.

    A row of `docs` is known by its place, as ids may be null or repeated. Term 0 is posted once per
    document at its number of words, with the doc_id.
    """
    terms = windows.select(F.explode("words").alias("word")).distinct()
    terms = terms.withColumn("term", F.monotonically_increasing_id() + 1)
    terms = work.store(terms, "terms")
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of("text").alias("words"))
    found, dealt = None, parts(terms, "word", most)
    if len(dealt) > 1:  # rows keep their numbers from pass to pass
        texts = work.store(texts, "texts")
    for i, part in enumerate(dealt):
        # the length is the place of an empty word put after the last one
        words = F.concat("words", F.array(F.lit(""))) if i == 0 else F.col("words")
        each = texts.select("row", "doc_id", F.posexplode(words).alias("pos", "word"))
        ends = docs.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(0).cast("long").alias("term"))
        known = F.broadcast(part.unionAll(ends)) if i == 0 else part
        posted = each.join(known, "word").select(
            "row", F.when(F.col("term") == 0, F.col("doc_id")).alias("doc_id"), "term", "pos"
        )
        posted = work.store(posted, f"postings-{i}")
        found = posted if found is None else found.unionAll(posted)
    return terms, found


def rank_terms(windows: DataFrame, terms: DataFrame, postings: DataFrame, work: Workspace) -> DataFrame:
    """Per window its terms as (n, term, at), rarest first; windows with a term never posted are left out."""
    counts = postings.where("term > 0").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counts = terms.join(counts, "term")
    each = windows.select("win", F.size("words").alias("width"), F.posexplode("words").alias("at", "word"))
    ranked = each.join(counts, "word").groupBy("win", "width").agg(
        F.sort_array(F.collect_list(F.struct("n", "term", "at"))).alias("terms")
    )
    return work.store(ranked.where(F.size("terms") == F.col("width")), "ranked")


def only(postings: DataFrame, wanted: DataFrame, most: int = PART) -> DataFrame:
    """The postings of the wanted terms (a stored table of different terms)."""
    found = None
    for part in parts(wanted, "term", most):
        these = postings.join(part, "term", "left_semi")
        found = these if found is None else found.unionAll(these)
    return found


def phrase_matches(postings: DataFrame, ranked: DataFrame, work: Workspace, most: int = PART) -> DataFrame:
    """Where whole windows occur: (`row`, `win`, `start`, `width`)."""
    lists = postings.where("term > 0").select("row", "term", "pos")
    by_rarest = ranked.select(
        "win", "width",
        F.col("terms")[0]["term"].alias("term"), F.col("terms")[0]["at"].alias("at"),
        F.get("terms", F.lit(1))["term"].alias("next"), F.get("terms", F.lit(1))["at"].alias("next_at"),
    )
    by_rarest = work.store(by_rarest, "by-rarest")
    starts = None
    for part in parts(by_rarest, "term", most):
        these = lists.join(part, "term").select(
            "row", "win", "width", (F.col("pos") - F.col("at")).alias("start"), "next", "next_at"
        ).where("start >= 0")
        starts = these if starts is None else starts.unionAll(these)
    # the second rarest term at its offset; its lists are short too
    seconds = work.store(by_rarest.where("next is not null").select(F.col("next").alias("term")).distinct(), "seconds")
    second = only(lists, seconds, most).select("row", F.col("term").alias("next"), F.col("pos").alias("next_pos"))
    both = starts.where("next is not null").withColumn("next_pos", F.col("start") + F.col("next_at"))
    left = both.join(second, ["row", "next", "next_pos"], "left_semi").select("row", "win", "width", "start")
    single = starts.where("next is null").select("row", "win", "width", "start")
    left = work.store(left.unionAll(single), "starts")
    # all other terms at theirs
    rest = ranked.where("width > 2").select("win", F.slice("terms", F.lit(3), F.col("width") - 2).alias("rest"))
    needed = left.join(rest, "win").select(
        "row", "win", "start", "width", F.explode("rest").alias("t")
    ).select("row", "win", "start", "width", F.col("t.term").alias("term"), (F.col("start") + F.col("t.at")).alias("pos"))
    rows = work.store(left.where("width > 2").select("row").distinct(), "rows")
    there = needed.join(lists.join(rows, "row", "left_semi"), ["row", "term", "pos"])
    whole = there.groupBy("row", "win", "start", "width").agg(F.count(F.lit(1)).alias("n")).where("n = width - 2")
    return whole.select("row", "win", "start", "width").unionAll(left.where("width <= 2").select("row", "win", "start", "width"))


def proximity_matches(postings: DataFrame, ranked: DataFrame, within: int, work: Workspace, most: int = PART) -> DataFrame:
    """Occurrences (`row`, `win`, `pos`) of a window's rarest term with all its other terms at most `within` words away."""
    lists = postings.where("term > 0").select("row", "term", "pos")
    others = F.array_distinct(F.transform(F.slice("terms", F.lit(2), F.size("terms")), lambda t: t["term"]))
    anchors = ranked.select("win", F.col("terms")[0]["term"].alias("term"), others.alias("others"))
    anchors = anchors.withColumn("others", F.array_remove("others", F.col("term")))
    anchors = work.store(anchors, "anchors")
    near = None
    for part in parts(anchors, "term", most):
        these = lists.join(part, "term").select("row", "win", "pos", "others")
        near = these if near is None else near.unionAll(these)
    near = work.store(near, "near")
    width = within + 1
    block = F.floor(F.col("pos") / width)
    # a term at most `within` away lies in the same block of places or in one next to it
    asked = near.select("row", "win", "pos", F.size("others").alias("wanted"), F.explode("others").alias("term"))
    asked = asked.withColumn("block", F.explode(F.array(block - 1, block, block + 1)))
    wanted = work.store(anchors.select(F.explode("others").alias("term")).distinct(), "near-terms")
    there = only(lists, wanted, most).select("row", "term", block.alias("block"), F.col("pos").alias("there"))
    met = asked.join(there, ["row", "term", "block"]).where(F.abs(F.col("pos") - F.col("there")) <= within)
    met = met.groupBy("row", "win", "pos", "wanted").agg(F.count_distinct("term").alias("n")).where("n = wanted")
    return met.select("row", "win", "pos").unionAll(near.where(F.size("others") == 0).select("row", "win", "pos"))


def covered_words(matches: DataFrame) -> DataFrame:
    """Words of each document row under any match."""
    before = Window.partitionBy("row").orderBy("start", "width").rowsBetween(Window.unboundedPreceding, -1)
    ends = F.coalesce(F.max(F.col("start") + F.col("width")).over(before), F.lit(0))
    spans = matches.groupBy("row", "start").agg(F.max("width").alias("width"))
    spans = spans.withColumn("from", F.greatest("start", ends))
    return spans.groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("start") + F.col("width") - F.col("from"))).alias("n_hit"))


def contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW, most: int = PART) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    work = Workspace(docs.sparkSession, "phrases")
    windows, holders = phrase_windows(items, work, width)
    terms, postings = build_index(docs, windows, work, most)
    ranked = rank_terms(windows, terms, postings, work)
    matches = work.store(phrase_matches(postings, ranked, work, most), "matches")
    held = matches.select("row", "win").distinct().join(holders, "win").select("row", "item_id").distinct()
    named = held.groupBy("row").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    lengths = postings.where("term = 0").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    found = lengths.join(covered_words(matches), "row", "left").join(named, "row", "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return found.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def op12(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns."""
    return contaminated(docs, items)


ORACLE = rf"""
with docs as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
item_windows as (
  select distinct item_id, least(len(words), {WINDOW}) as width, array_to_string(words[i:i + {WINDOW} - 1], ' ') as win
  from (select item_id, words, unnest(range(1, greatest(1, len(words) - {WINDOW} + 1) + 1)) as i from items where len(words) > 0)),
widths as (select distinct width from item_windows),
grams as (
  select r, width, i, array_to_string(words[i:i + width - 1], ' ') as win
  from (select r, words, width, unnest(range(1, len(words) - width + 2)) as i from docs, widths where len(words) >= width)),
hits as (select distinct r, width, i, win from grams where win in (select win from item_windows)),
marked as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + width)) as p from hits) group by r),
named as (
  select r, count(distinct id) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct r, item_id::varchar as id from hits join item_windows using (width, win) where item_id is not null)
  group by r)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join marked using (r) left join named using (r)
"""
