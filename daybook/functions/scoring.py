"""Small numeric and status expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a status shows on a report.
LIGHTS = {
    "success": "green", "warning": "yellow", "failed": "red",
    "pass": "green", "warn": "yellow", "fail": "red",
}


def light(status: Column) -> Column:
    out = F.lit("white")
    for name, colour in LIGHTS.items():
        out = F.when(status == name, colour).otherwise(out)
    return out


def rounded(c: Column, digits: int) -> Column:
    """Round the scaled double, half away from zero, which is what C's ``round`` does to it.

    Spark's ``round(c, digits)`` rounds the shortest decimal text of the value instead,
    which differs where arithmetic lands a hair beside a tie.
    """
    scale = 10.0**digits
    return F.round(c * scale) / scale


def clip_at_zero(c: Column) -> Column:
    """Negative values become 0 and NULL stays NULL (``greatest`` would turn NULL into 0)."""
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def celsius(fahrenheit: Column) -> Column:
    return rounded((fahrenheit - 32) * 5 / 9, 1)


def kmh(mph: Column) -> Column:
    return rounded(mph * 1.609, 1)


def call_correct(settled: Column, call: Column, verified: Column, happened: Column) -> Column:
    """Was a yes/no call right? NULL while unsettled, for a hedge, or when its evidence was not found.

    A NULL ``verified`` does not block scoring: only a known False does.
    """
    unscored = ~settled | (call == "possible") | ~verified
    return F.when(unscored, F.lit(None).cast("boolean")).otherwise((call == "likely") == happened)


def model_correct(settled: Column, predicted: Column, threshold: float, happened: Column) -> Column:
    unscored = ~settled | predicted.isNull()
    return F.when(unscored, F.lit(None).cast("boolean")).otherwise((predicted > threshold) == happened)
