"""Time predicates and parts. "Now" is always an argument."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000


def ts(value: datetime | str | Column) -> Column:
    """Timestamp column from a literal or a column."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def on_day(column: Column, day: date | str) -> Column:
    """Half-open range, so the predicate reaches the scan."""
    start = date.fromisoformat(str(day))
    return within(column, start, start + timedelta(days=1))


def within(column: Column, start: date | datetime | str, end: date | datetime | str) -> Column:
    """start <= column < end."""
    return (column >= ts(start)) & (column < ts(end))


def trailing(column: Column, as_of: datetime | str, **interval: int) -> Column:
    """column >= as_of - interval, with the interval as timedelta keywords."""
    start = datetime.fromisoformat(str(as_of)) - timedelta(**interval)
    return column >= ts(start)


def trailing_days(column: Column, as_of: date | datetime | str, days: int) -> Column:
    """Dates from as_of - days on, both ends included, hence days + 1 dates."""
    start = datetime.fromisoformat(str(as_of)).date() - timedelta(days=days)
    return column >= F.lit(start)


def between_times(column: Column, start: datetime | str, end: datetime | str) -> Column:
    """Closed range."""
    return column.between(ts(start), ts(end))


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(float(MICROS_PER_HOUR))


def with_date_parts(column: Column) -> dict[str, Column]:
    """The archive's partition columns."""
    return {"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)}


def month_start(column: Column) -> Column:
    return F.trunc(F.to_date(column), "month")


def previous_day(as_of: date | datetime | str) -> date:
    return datetime.fromisoformat(str(as_of)).date() - timedelta(days=1)


def bounded(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must lie between {low} and {high}, got {value}")
    return value
