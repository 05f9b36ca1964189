"""Dates: lenient parsing, the pinned "today", trailing horizons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | Column | None
RunTime = dt.datetime | Column | None


def to_day(raw: Column | str) -> Column:
    """Date of the value; text that is no date gives NULL."""
    column = F.col(raw) if isinstance(raw, str) else raw
    return column.try_cast("date")


def as_of_day(as_of: AsOf = None) -> Column:
    """The reporting day: the one given, else the current date."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def run_time(run_ts: RunTime = None) -> Column:
    """The processing time: the one given, else the current timestamp."""
    if run_ts is None:
        return F.current_timestamp()
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts)


def within_days(day: Column | str, days: int, as_of: Column) -> Column:
    """True when ``day`` lies at most ``days`` before ``as_of`` (later days count too)."""
    return F.datediff(as_of, day) <= F.lit(days)


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end``, as a bigint, whatever the session's time zone."""
    gap = end - start

    def part(name: str, micros: int) -> Column:
        return (F.extract(F.lit(name), gap) * F.lit(micros)).cast("bigint")

    return part("DAY", 86_400_000_000) + part("HOUR", 3_600_000_000) + part("MINUTE", 60_000_000) + part("SECOND", 1_000_000)
