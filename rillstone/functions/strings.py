"""String functions with JVM string semantics, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 1 << 32
TWO_31 = 1 << 31

# A double-quoted, non-empty string that may hold escaped quotes, and runs of 3
# to 5 digits. The first takes plain characters in one possessive step, so that long strings
# don't exhaust the regex engine's stack.
QUOTED_STRING = r'"((?:[^"\\]++|\\"|\\)+)"'
DIGIT_RUN = r"\d{3,5}"


def _literal_pattern(sep: str) -> str:
    return "".join("\\" + c if c in r"\^$.|?*+()[]{}" else c for c in sep)


def java_split(value: Column, sep: str, regex: bool = False) -> Column:
    """Split as the JVM's `String.split` does: trailing empty strings are dropped.

    Leading and inner empty strings stay, `''` gives `['']`, and a string made only of
    separators gives `[]`. `sep` is taken literally unless `regex` is set.
    """
    if len(sep) == 1 and not regex:
        # Trailing empties come from trailing separators, so one right-trim removes them.
        body = F.rtrim(value) if sep == " " else F.rtrim(value, F.lit(sep))
        parts = F.split(body, _literal_pattern(sep), -1)
        return F.when((body == "") & (value != ""), F.slice(parts, 1, 0)).otherwise(parts)
    parts = F.split(value, sep if regex else _literal_pattern(sep), -1)
    last_word = F.array_max(
        F.transform(parts, lambda w, i: F.when(w != "", i + 1).otherwise(F.lit(0)))
    )
    return F.when(value == "", parts).otherwise(F.slice(parts, F.lit(1), last_word))


def utf16_length(value: Column) -> Column:
    """Length in UTF-16 code units, which is what the JVM's `String.length` counts."""
    return (F.octet_length(F.encode(value, "UTF-16BE")) / 2).cast("int")


def java_hash(value: Column, factor: int = 13) -> Column:
    """`String.hashCode() * factor` with 32-bit wrap-around, as a signed int."""
    units = F.regexp_extract_all(F.hex(F.encode(value, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))
    unsigned = F.aggregate(
        units,
        F.lit(0).cast("bigint"),
        lambda h, u: (h * 31 + F.conv(u, 16, 10).cast("bigint")) % TWO_32,
        lambda h: (h * (factor % TWO_32)) % TWO_32,
    )
    signed = F.when(unsigned >= TWO_31, unsigned - TWO_32).otherwise(unsigned)
    return signed.cast("int")


def find_all(value: Column, pattern: str, group: int = 0) -> Column:
    """Every match of a regex, left to right, as an array."""
    return F.regexp_extract_all(value, F.lit(pattern), F.lit(group))
