"""Time arithmetic on TIMESTAMP_NTZ columns.

All timestamps are zone-less UTC clock readings, so results do not depend on
the session time zone. ``as_of`` replaces the wall clock everywhere.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts(value: str | date | datetime | Column) -> Column:
    """Zone-less timestamp literal (or cast)."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def _seconds_of_day(c: Column) -> Column:
    return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole-second difference ``end - start`` as BIGINT, fractions cut off on both sides."""
    days = F.datediff(end, start).cast("bigint")
    return days * F.lit(86400) + (_seconds_of_day(end) - _seconds_of_day(start)).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def whole_minutes_between(start: Column, end: Column) -> Column:
    """Minutes cut towards zero, as INT."""
    return (seconds_between(start, end) / F.lit(60.0)).cast("int")


def plus_hours(c: Column, hours: int) -> Column:
    return c + F.make_dt_interval(hours=F.lit(hours))


def plus_days(c: Column, days: int) -> Column:
    return c + F.make_dt_interval(days=F.lit(days))


def parse_ts(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to a timestamp; NULL where the text does not parse."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")


def parse_date(c: Column) -> Column:
    """``yyyy-MM-dd`` text to a date; NULL where the text does not parse."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("date")
