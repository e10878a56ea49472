"""Date and time expressions on naive UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_naive(iso_with_offset: Column) -> Column:
    """ISO text with a zone offset as a naive UTC timestamp, whatever the session zone."""
    local = iso_with_offset.cast("timestamp").cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit("UTC"), local)


def iso_naive(iso: Column) -> Column:
    return F.to_timestamp_ntz(iso)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def age_hours(newest: Column, now: Column) -> Column:
    return seconds_between(newest, now) / F.lit(3600)


def season(date: Column) -> tuple[Column, Column]:
    """Day of year on a circle, so that the last and first day of a year are neighbours."""
    angle = F.lit(2.0) * F.pi() * F.dayofyear(date) / F.lit(365.25)
    return F.sin(angle), F.cos(angle)


def run_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss")


def run_date(ts: Column, cutoff_hour: int = 5) -> Column:
    """The day whose window ``[day-1 cutoff, day cutoff)`` holds the timestamp."""
    return F.date_add(F.to_date(ts - F.expr(f"INTERVAL {int(cutoff_hour)} HOURS")), 1)
