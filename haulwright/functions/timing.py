"""Time expressions. Timestamps are UTC without zone; the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds with fractions; null if a time is missing."""
    return (micros(end) - micros(start)) / F.lit(1000000.0)


def iso_to_utc(text: Column) -> Column:
    """ISO 8601 text to UTC; an offset is applied, bad text gives null."""
    stamped = F.when(
        text.rlike(r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}.*)?$"), F.try_to_timestamp(text)
    )
    return stamped.cast("timestamp_ntz")


def elapsed_text(seconds: Column) -> Column:
    """HH:MM:SS.sssss of a non-negative duration; null below zero."""
    hours = F.floor(seconds / 3600)
    minutes = F.floor((seconds % 3600) / 60)
    return F.when(
        seconds >= 0, F.format_string("%02d:%02d:%08.5f", hours, minutes, seconds % 60)
    )
