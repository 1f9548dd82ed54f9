"""Quality rules as a bitmask ledger: measure once, keep the failure bits, judge by policy.

`ledger` scans the texts once and stores, per document, the measurements and one bit for each
rule that the document fails. A policy is a version and a set of rules; applying it, comparing
versions and asking what each rule adds (`ablation`) only read the bits. Everything is built from
DataFrame functions.

Defined results: a null or empty text has no words, lines or symbols and fails `few_words`; a text
shorter than the window repeats nothing; repeated rows and null ids are judged row by row; other
columns are passed through only if named in `keep`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.llm.common import SPACE, words_of

# Fixed values of the contract.
WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Rule:
    """A rule's bit number, its name and the condition on the measurements under which it fails."""

    bit: int
    name: str
    fails: str


RULES = [
    Rule(0, "few_words", f"n_words < {MIN_WORDS}"),
    Rule(1, "repeated_windows", f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule(2, "symbols", "n_symbols > 0.25 * n_words"),
    Rule(3, "word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    Rule(4, "repeated_lines", "n_dup_lines > 0.3 * n_lines"),
    Rule(5, "capitals", "n_capitals > 0.5 * word_chars"),
]


@dataclass(frozen=True)
class Policy:
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        known = {rule.name: rule.bit for rule in RULES}
        return sum(1 << known[name] for name in self.rules)


BASE = Policy(1, ("few_words", "repeated_windows"))
STRICT = Policy(2, tuple(rule.name for rule in RULES))


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row of measurements per document.

    Repeats inside a text are found by sorting its window hashes, so a text of n words costs
    n log n. Only texts in which some window occurs twice are sorted with positions.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.select(
        *keep,
        words_of(text).alias("_words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("_lines"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(body, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
    )
    step = step.select(
        *keep,
        "n_symbols",
        "n_capitals",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda total, word: total + F.length(word)).alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
    )
    measured = [c for c in step.columns if c != "_hashes"]

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)])

    windows = F.transform(F.sequence(F.lit(0), F.size("_hashes") - WINDOW), window)
    step = step.select(*measured, F.when(F.size("_hashes") >= WINDOW, windows).alias("_windows"))
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.select(
        *measured,
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed).alias("_placed"),
    )

    def if_repeated(here: Column, k: Column) -> Column:
        alike = [F.get("_placed", k + d)["h"] == here["h"] for d in (-1, 1)]
        return F.when(F.coalesce(alike[0], F.lit(False)) | F.coalesce(alike[1], F.lit(False)), here["i"])

    starts = F.sort_array(F.filter(F.transform("_placed", if_repeated), lambda i: i.isNotNull()))
    step = step.select(*measured, starts.alias("_starts"))
    return step.select(*measured, F.coalesce(covered_words("_starts"), F.lit(0)).cast("long").alias("n_repeat_words"))


def covered_words(starts: str) -> Column:
    """Words under windows that begin at the given ascending positions."""
    n = F.size(starts)
    gaps = F.zip_with(
        F.slice(starts, F.lit(2), n - 1),
        F.slice(starts, F.lit(1), n - 1),
        lambda after, before: F.least(F.lit(WINDOW), after - before),
    )
    return F.when(n > 0, F.aggregate(gaps, F.lit(WINDOW), lambda total, gap: total + gap))


def failure_bits() -> Column:
    """All rules' bits in one number."""
    bits = [F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)) for rule in RULES]
    return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")


def ledger(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The measurements of every document and its failure bits."""
    return measure(docs, text, keep).withColumn("failed", failure_bits())


def passes(policy: Policy, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablation(book: DataFrame, policies: list[Policy]) -> DataFrame:
    """For each policy and rule: documents kept, kept without that rule, and failed by it alone.

    The ledger is first counted by bit pattern, of which there are at most 2 ** rules.
    """
    patterns = book.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = F.array(
        *[
            F.struct(
                F.lit(p.version).alias("version"), F.lit(r.name).alias("rule"),
                F.lit(p.mask).cast("long").alias("mask"), F.lit(1 << r.bit).cast("long").alias("bit"),
            )
            for p in policies for r in RULES if r.name in p.rules
        ]
    )
    each = patterns.withColumn("case", F.explode(cases)).select("failed", "n", "case.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    others = hit.bitwiseAND(F.bitwise_not("bit"))
    return each.groupBy("version", "rule").agg(
        F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("kept"),
        F.sum(F.when(others == 0, F.col("n")).otherwise(0)).alias("kept_without"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
    )


def op9(docs: DataFrame) -> DataFrame:
    """The contract's columns; `failed` holds the bits of all rules."""
    book = ledger(docs)
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(STRICT)).alias("kept"),
        "failed",
    )


ORACLE = rf"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
words as (
  select r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as word,
         generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) as pos
  from docs),
sized as (select r, count(*) as n_words, sum(length(word)) as word_chars from words group by r),
windows as (
  select r, pos, list(word) over (partition by r order by pos rows between current row and 7 following) as win
  from words),
full_windows as (select r, pos, count(*) over (partition by r, win) as n from windows where len(win) = {WINDOW}),
marks as (select r, pos, lead(pos) over (partition by r order by pos) as after from full_windows where n > 1),
repeats as (select r, sum(least({WINDOW}, coalesce(after - pos, {WINDOW}))) as n_repeat_words from marks group by r),
lines as (
  select r, line from (select r, unnest(string_split(text, chr(10))) as line from docs)
  where regexp_matches(line, '[^\x20\x09-\x0D]')),
line_counts as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from lines group by r),
m as (
  select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
         (length(text) - length(translate(text, '{SYMBOLS}', '')))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_lines, 0) as n_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) as n_capitals
  from docs left join sized using (r) left join line_counts using (r) left join repeats using (r)),
b as (
  select *, {' | '.join(f"(case when {rule.fails} then {1 << rule.bit} else 0 end)" for rule in RULES)} as bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (bits & {BASE.mask}) <> 0 as base_failed, (bits & {BASE.mask | STRICT.mask}) = 0 as kept, bits::bigint as failed
from b
"""
