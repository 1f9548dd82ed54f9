"""Request signing: canonical strings, HMAC and URL coding as native expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.session import PAD_REDACTION

BLOCK_BYTES = 64
REDACTION = "spark.sql.redaction.string.regex"


def canonical_request(*parts: Column) -> Column:
    """The request parts joined by line feeds; a missing part counts as an empty one."""
    return F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts])


def _digest(data: Column, algorithm: str) -> Column:
    hexed = F.sha1(data) if algorithm == "sha1" else F.sha2(data, 256)
    return F.unhex(hexed)


def redact_plans() -> None:
    """Make sure that the active session redacts key pads."""
    spark = SparkSession.active()
    pattern = spark.conf.get(REDACTION, None)
    if not pattern:
        spark.conf.set(REDACTION, PAD_REDACTION)
    elif PAD_REDACTION not in pattern:
        spark.conf.set(REDACTION, f"{pattern}|{PAD_REDACTION}")


def hmac(message: Column, key: bytes, algorithm: str = "sha256") -> Column:
    """HMAC-SHA256 or HMAC-SHA1 of a string column, as binary.

    The key stays with the caller. Its padded forms are plan literals, which are kept out of plan texts
    and event logs: the session's redaction pattern is widened to cover them, or signing fails.
    """
    redact_plans()
    if algorithm not in ("sha1", "sha256"):
        raise ValueError(f"unknown HMAC algorithm: {algorithm}")
    if len(key) > BLOCK_BYTES:
        import hashlib

        key = hashlib.new(algorithm, key).digest()
    padded = key.ljust(BLOCK_BYTES, b"\0")
    inner = F.lit(bytes(b ^ 0x36 for b in padded))
    outer = F.lit(bytes(b ^ 0x5C for b in padded))
    data = F.encode(message, "UTF-8")
    return _digest(F.concat(outer, _digest(F.concat(inner, data), algorithm)), algorithm)


def sign(message: Column, key: bytes, algorithm: str = "sha256") -> Column:
    """Base64 of the HMAC."""
    return F.base64(hmac(message, key, algorithm))


def sign_requests(
    df: DataFrame, parts: Sequence[Column], key: bytes, algorithm: str = "sha256",
    name: str = "signature",
) -> DataFrame:
    """Add the signature of every request row."""
    return df.withColumn(name, sign(canonical_request(*parts), key, algorithm))


def verify_requests(
    df: DataFrame, parts: Sequence[Column], given: Column, key: bytes, algorithm: str = "sha256"
) -> DataFrame:
    """Add `valid`: whether the given signature is that of the row; a missing one is not."""
    good = sign(canonical_request(*parts), key, algorithm)
    return df.withColumn("valid", given.eqNullSafe(good))


def url_encode(value: Column) -> Column:
    return F.url_encode(value)


def url_decode(value: Column) -> Column:
    return F.url_decode(value)
