"""Epoch-millisecond times, period keys and period series. Zone: the session's (UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period key formats.
HOUR_KEY = "yyyyMMddHH"
LOG_HOUR_KEY = "yyyy-MM-dd-HH"
DAY_KEY = "yyyy-MM-dd"
MONTH_KEY = "yyyy-MM"


def span(days: int = 0, hours: int = 0) -> Column:
    """A fixed length of time."""
    return F.make_dt_interval(F.lit(days), F.lit(hours))


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("bigint"))


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def period_key(ts: Column, fmt: str = DAY_KEY) -> Column:
    return F.date_format(ts, fmt)


def parse_period_key(key: Column, fmt: str = DAY_KEY) -> Column:
    """Start of the period; null when the text does not have the format."""
    return F.try_to_timestamp(key, F.lit(fmt))


def day_series(start: Column, count: int, step_days: int = 1) -> Column:
    """``count + 1`` dates, ``step_days`` apart, first one included."""
    first = start.cast("date")
    return F.sequence(first, F.date_add(first, count * step_days), span(days=step_days))


def hours_of_day(day: Column) -> Column:
    """The 24 hour starts of a day."""
    first = F.date_trunc("day", day)
    return F.sequence(first, first + span(hours=23), span(hours=1))


def half_open_hours(start: Column, end: Column) -> Column:
    """Hour starts in ``[start, end)``."""
    # Without a lambda function Spark computes the list of constant bounds once, not per row.
    return F.array_remove(F.sequence(start, end, span(hours=1)), end)


def previous_day(as_of: Column) -> Column:
    return F.date_sub(as_of.cast("date"), 1)


def previous_week(as_of: Column) -> Column:
    return F.date_sub(as_of.cast("date"), 7)


def previous_hour(as_of: Column) -> Column:
    """Start of the hour before the one that holds ``as_of``."""
    return F.date_trunc("hour", as_of) - span(hours=1)


def past_hour_paths(root: str, as_of, hours: int = 24, folder: str = "{day}/{hour}") -> list[str]:
    """Folders ``root/yyyy-MM-dd/H`` of the last hours, newest first; the hour is not padded. ``folder`` names
    them otherwise."""
    from datetime import timedelta

    slots = (as_of - timedelta(hours=i) for i in range(1, hours + 1))
    return [f"{root.rstrip('/')}/{folder.format(day=f'{t:%Y-%m-%d}', hour=t.hour)}" for t in slots]
