"""Time expressions that work on zoned and zone-free timestamps alike."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def wall_seconds(ts: Column) -> Column:
    """Seconds since 1970 of the clock reading, as if no zone existed."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def zoned_seconds(ts: Column) -> Column:
    """Whole seconds since 1970; a zone-free value is read in the session zone."""
    return F.unix_seconds(ts.cast("timestamp"))


def elapsed_minutes(start: Column, end: Column, clock: str = "session_tz") -> Column:
    """Minutes between two instants, each floored to its second.

    ``session_tz`` counts real elapsed time, so a trip across a clock change
    is measured right. ``wall`` subtracts clock readings.
    """
    seconds = {"session_tz": zoned_seconds, "wall": wall_seconds}.get(clock)
    if seconds is None:
        raise ValueError(f"unknown clock {clock!r}")
    return (seconds(end) - seconds(start)) / F.lit(60.0)


def on_or_after(ts: Column, day: dt.date) -> Column:
    """True from local midnight of ``day``; a DATE literal fits both timestamp types."""
    return ts >= F.lit(day)


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%04d-%02d", year, month)


def readable(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
