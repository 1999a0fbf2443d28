"""Date arithmetic that counts calendar boundaries and never reads the clock.

Instants are kept as zone-less timestamps, so results do not depend on the session's
time zone. "Today" is always the parameter ``as_of``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: str | dt.date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds as a zone-less UTC timestamp (negative seconds allowed)."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def local_day(seconds: Column, zone: str) -> Column:
    """Calendar day of an epoch second in ``zone``."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), epoch_to_timestamp(seconds)))


def years_crossed(start: Column, end: Column) -> Column:
    """New Year's days between two dates; the built-in difference counts elapsed years."""
    return F.year(end) - F.year(start)


def months_crossed(start: Column, end: Column) -> Column:
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def dow_sunday0(day: Column) -> Column:
    return F.dayofweek(day) - 1


def dow_monday0(day: Column) -> Column:
    return F.weekday(day)


def months_before(as_of: str | dt.date | Column, months: int) -> Column:
    return F.add_months(as_date(as_of), -months)
