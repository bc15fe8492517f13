"""Calendar arithmetic that counts boundaries crossed, not elapsed time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(as_of: dt.datetime) -> Column:
    """The run's "now" as a zone-free timestamp literal."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def day(as_of: dt.datetime) -> Column:
    return F.lit(as_of.date())


def years_crossed(start: Column, end: Column) -> Column:
    """31 Dec to 1 Jan is one year."""
    return F.year(end) - F.year(start)


def days_crossed(start: Column, end: Column) -> Column:
    """23:59 to 00:01 is one day."""
    return F.date_diff(F.to_date(end), F.to_date(start))


def date_key(date: Column) -> Column:
    """yyyymmdd as an int, by arithmetic: no text is formatted or parsed."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def compact_stamp(as_of: dt.datetime) -> str:
    return as_of.strftime("%Y%m%d_%H%M%S")


def compact_day(as_of: dt.datetime) -> str:
    return as_of.strftime("%Y%m%d")
