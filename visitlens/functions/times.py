"""Time parsing and formatting. Run with ``spark.sql.session.timeZone=UTC``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch milliseconds of the years 1 to 9999; anything outside is not a time.
MIN_MILLIS = -62_135_596_800_000
MAX_MILLIS = 253_402_300_799_999


def parse_time(c: Column) -> Column:
    """Text ``yyyy-MM-dd H:mm:ss`` (hour padded or not) or any timestamp type."""
    return c.cast("timestamp")


def from_millis(c: Column) -> Column:
    """Epoch milliseconds to a timestamp, NULL outside years 1 to 9999."""
    return F.timestamp_millis(F.when(c.between(MIN_MILLIS, MAX_MILLIS), c))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds, fractions cut off."""
    return F.floor((F.unix_millis(end) - F.unix_millis(start)) / F.lit(1000)).cast("long")


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def date_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def minute_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def date_hour(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd_HH")


def hour_text(ts: Column) -> Column:
    return F.date_format(ts, "HH")


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "mm")
