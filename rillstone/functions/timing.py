"""Epoch arithmetic that doesn't depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_of(ts: Column) -> Column:
    """Epoch seconds of a timestamp; one without a zone is read as UTC."""
    return F.unix_timestamp(ts)


def millis_of(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp; one without a zone is read as UTC."""
    return F.unix_timestamp(ts) * 1000 + (F.extract(F.lit("SECOND"), ts) * 1000).cast("int") % 1000


def event_time(seconds: Column) -> Column:
    """Epoch seconds to an event-time timestamp."""
    return F.timestamp_seconds(seconds)


def shift_hours(seconds: Column, hours: int) -> Column:
    return seconds + F.lit(hours * 3600)
