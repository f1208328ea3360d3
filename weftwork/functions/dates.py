"""Date and time expressions. Those that depend on today take the day as an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(column: str | Column, pattern: str) -> Column:
    """A date, or null where the text does not fit the pattern."""
    return F.try_to_date(column, pattern)


def parse_date_any(column: str | Column, *patterns: str) -> Column:
    """The date by the first pattern that fits."""
    return F.coalesce(*[parse_date(column, p) for p in patterns])


def day_age(column: str | Column, as_of: Column) -> Column:
    """Days between, over 365: an age that ignores leap days."""
    return F.date_diff(as_of, column) / 365


def full_years(column: str | Column, as_of: Column) -> Column:
    """Completed calendar years; a birthday on 29 February is completed on 1 March of a common year."""
    column = F.col(column) if isinstance(column, str) else column
    early = F.month(as_of) * 100 + F.day(as_of) < F.month(column) * 100 + F.day(column)
    return (F.year(as_of) - F.year(column) - early.cast("int")).cast("int")


def from_epoch_ms(column: str | Column) -> Column:
    return F.timestamp_millis(column)


def epoch_seconds(column: str | Column) -> Column:
    """Whole seconds since 1970, for a timestamp with or without zone."""
    column = F.col(column) if isinstance(column, str) else column
    return F.unix_timestamp(column.cast("timestamp"))


def from_epoch_seconds(column: str | Column) -> Column:
    return F.timestamp_seconds(column)


def nearest_slot(column: str | Column, seconds: int) -> Column:
    """Number of the time slot whose start is nearest."""
    return F.round(epoch_seconds(column) / seconds).cast("int")


def today() -> Column:
    return F.current_date()


def now() -> Column:
    return F.current_timestamp()


def add_days(column: str | Column, days: int) -> Column:
    return F.date_add(column, days)
