"""Epoch seconds, their text form and calendar day numbers (session time zone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text form of a time.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def day_number(seconds: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    day = F.to_date(F.timestamp_seconds(seconds))
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def time_text(seconds: Column) -> Column:
    return F.from_unixtime(seconds, TIME_FORMAT)


def parse_time(text: Column) -> Column:
    """Epoch seconds, null when the text is not a time."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit(TIME_FORMAT)))


def epoch_seconds(timestamp: Column) -> Column:
    return F.unix_timestamp(timestamp.cast("timestamp"))
