"""Fits kept as moments: a run adds its new days to a stored row per key and metric and never reads history again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators import regression
from daybook.operators.features import add_season, by_day
from daybook.plans.forecast import FEATURES, reduced
from daybook.session import materialise


def _values(days: DataFrame, metrics: Sequence[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("y")) for m in metrics])
    return days.select("key", "date", F.inline(pairs))


def _with_features(rows: DataFrame) -> DataFrame:
    return add_season(rows.withColumn("lag_1", F.lag("y").over(by_day("key", "metric"))))


def fit_state(history: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """key, metric, the moments, last_date and last_y, from whole history."""
    return reduced(_with_features(_values(history, metrics)), ["key", "metric"])


def advance(state: DataFrame, days: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """The state with the daily rows ``days`` added. Rows up to a key's last day are in the state already and ignored.

    Only the new rows are read and sorted; a state is the row before them in the one exchange by key and metric, so it
    is their first lag as well. A key without new rows keeps its state, one without a state starts anew.
    """
    names = [c for c in state.columns if c not in ("key", "metric")]
    was = state.select("key", "metric", F.col("last_date").alias("date"), F.col("last_y").alias("y"), F.struct(*names).alias("_was"))
    rows = was.unionByName(_values(days, metrics), allowMissingColumns=True)
    known = F.max("_was.last_date").over(Window.partitionBy("key", "metric"))
    rows = rows.withColumn("_known", known).where("_was IS NOT NULL OR _known IS NULL OR date > _known")
    fresh = _with_features(rows).withColumn("_y", F.when(F.col("_was").isNull(), F.col("y")))
    moments = regression.moments("_y", FEATURES)
    added = fresh.groupBy("key", "metric").agg(
        F.first("_was", ignorenulls=True).alias("_was"), F.max("date").alias("last_date"), F.max_by("y", "date").alias("last_y"),
        *[c.alias(k) for k, c in moments.items()])
    both = added.select("key", "metric", "_was", "last_date", "last_y", F.struct(*moments).alias("_new"))
    merged = [c.alias(k) for k, c in regression.merged_moments("_was", "_new").items()]
    return both.select("key", "metric", *merged, "last_date", "last_y").select("key", "metric", *names)


def advance_by_runs(state: DataFrame, daily: DataFrame, days: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """The state after one run for each of ``days``, in that order; every run stores its state, as the next one reads it."""
    wanted = materialise(daily.where(F.col("date").isin(*[F.lit(d).cast("date") for d in days])).select("key", "date", *metrics))
    for day in days:
        state = materialise(advance(state, wanted.where(F.col("date") == F.lit(day).cast("date")), metrics))
    return state
