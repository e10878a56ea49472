"""Lag, rolling and seasonal features on daily rows.

Input holds one row per key and day, so a key's window partition is bounded by the
number of calendar days (a century is 36,525 rows) however many raw rows the key has.
Every function shares the window ``partitionBy(key).orderBy(date)``: one exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daybook.functions.dates import season


def by_day(*keys: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("date")


def add_season(df: DataFrame) -> DataFrame:
    sin, cos = season(F.col("date"))
    return df.withColumns({"doy_sin": sin, "doy_cos": cos})


def lag_features(daily: DataFrame, metrics: Sequence[str], depth: int = 1) -> DataFrame:
    """``lag_1_<metric>`` … ``lag_<depth>_<metric>``: earlier *rows*, whatever the calendar gap."""
    days = by_day("key")
    lags = {f"lag_{k}_{m}": F.lag(m, k).over(days) for m in metrics for k in range(1, depth + 1)}
    return daily.withColumns(lags)


def roll7_features(daily: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean of the seven rows before the current one; NULL unless all seven have a value."""
    before = by_day("key").rowsBetween(-7, -1)
    rolls = {
        f"roll7_{m}": F.when(F.count(m).over(before) == 7, F.avg(m).over(before)) for m in metrics
    }
    return daily.withColumns(rolls)


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str) -> DataFrame:
    """An indicator column per listed value. A value that is not listed stops the query; NULL is all zeros."""
    unlisted = F.raise_error(F.concat(F.lit(f"{column} has an unlisted value: "), F.col(column).cast("string")))
    known = F.col(column).isNull() | F.col(column).isin(*values)
    flags: dict[str, Column] = {
        f"{prefix}_{v}": F.when(known, F.coalesce((F.col(column) == v).cast("int"), F.lit(0))).otherwise(unlisted.cast("int")) for v in values
    }
    return df.withColumns(flags)
