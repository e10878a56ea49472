"""Keep one row per key without sorting: struct maxima combine before the shuffle.

A key that holds a third of all rows costs one partial result per map task, where
a row_number window would sort the whole group in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], best: Column) -> DataFrame:
    picked = df.groupBy(*keys).agg(best.alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in df.columns if c not in keys])


def _rest(df: DataFrame, keys: Sequence[str]) -> Column:
    return F.struct(*[c for c in df.columns if c not in keys])


def latest_wins(df: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest version, then the largest tie columns."""
    return _pick(df, keys, F.max_by(_rest(df, keys), F.struct(version, *ties)))


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest values of the order columns."""
    return _pick(df, keys, F.min_by(_rest(df, keys), F.struct(*order)))


def prefer_live(forecasts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A real prediction wins over a backtest point for the same day."""
    return first_wins(forecasts, keys, ["is_backtest", "model_type"])
