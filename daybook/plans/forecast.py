"""Next-day forecasts, their walk-forward backtest and the comparison with what happened.

Metrics become rows (key, metric, date, y): each metric then runs through the same
expressions. The daily rows are hashed by key once; the windows per (key, metric) and
the pivot per (key, date) both reuse that partitioning, so the whole backtest costs one
exchange after the rollup.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.dates import season
from daybook.functions.scoring import clip_at_zero, rounded
from daybook.operators import regression
from daybook.operators.blocked import BLOCK, lagged, running_sums
from daybook.operators.dedupe import first_wins
from daybook.operators.features import add_season, by_day
from daybook.operators.joins import lookup

MODEL_TYPE = "linear_regression_v1"
MIN_TRAINING_ROWS = 10


def settled_history(daily: DataFrame, as_of: str, metrics: Sequence[str], strict: bool = False) -> DataFrame:
    limit = F.lit(as_of).cast("date")
    settled = F.col("date") < limit if strict else F.col("date") <= limit
    return daily.where(settled).select("key", "date", *metrics)


def _long(history: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Rows (key, metric, date, y) with lag and season, hashed by key.

    The rows travel in their wide form and are unpivoted after the exchange, by a
    generator, as that keeps the partitioning.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("y")) for m in metrics])
    rows = history.select("key", "date", *metrics).repartition("key").select("key", "date", F.inline(pairs))
    return add_season(rows.withColumn("lag_1", F.lag("y").over(by_day("key", "metric"))))


FEATURES = ("lag_1", "doy_sin", "doy_cos")


def _wide(points: DataFrame, metrics: Sequence[str], non_negative: Sequence[str], is_backtest: bool | Column,
          run: Sequence[str] = ()) -> DataFrame:
    """Pivot predictions to one row per key and day, only where every metric could be predicted."""
    value = F.when(F.col("metric").isin(*non_negative), clip_at_zero(F.col("yhat"))).otherwise(F.col("yhat"))
    points = points.withColumn("yhat", rounded(value, 1))
    per_metric = [F.max(F.when(F.col("metric") == m, F.col("yhat"))).alias(f"predicted_{m}") for m in metrics]
    last_count = F.max(F.when(F.col("metric") == metrics[-1], F.col("n"))).alias("training_rows")
    wide = points.groupBy("key", "target_date", *run).agg(
        *per_metric, last_count, F.count("yhat").alias("_done")
    )
    return wide.where(F.col("_done") == len(metrics)).select(
        "key", "target_date", *[f"predicted_{m}" for m in metrics],
        F.lit(MODEL_TYPE).alias("model_type"), "training_rows", (F.lit(is_backtest) if isinstance(is_backtest, bool) else is_backtest).alias("is_backtest"),
    )


def reduced(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row per group: moments and the last day, all that a fit and the next forecast need."""
    agg = regression.moments("y", FEATURES)
    return rows.groupBy(*groups).agg(
        *[c.alias(k) for k, c in agg.items()],
        F.max("date").alias("last_date"), F.max_by("y", "date").alias("last_y"),
    )


def fitted(state: DataFrame) -> DataFrame:
    """The moments with slopes and intercept; NULL slopes below the minimum."""
    enough = F.col("n") >= MIN_TRAINING_ROWS
    sloped = state.withColumns({k: F.when(enough, b) for k, b in regression.coefficients().items()})
    return sloped.withColumn("intercept", regression.intercept())


def fit_per_key(history: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One fit per key and metric on its whole history."""
    return fitted(reduced(_long(history, metrics), ["key", "metric"]))


def _next_day(fitted: DataFrame) -> DataFrame:
    """Predict the day after the last row, that row's own value serving as the lag."""
    target = F.date_add("last_date", 1)
    sin, cos = season(target)
    return fitted.withColumns({"target_date": target, "yhat": regression.predicted((F.col("last_y"), sin, cos))})


def state_forecast(state: DataFrame, metrics: Sequence[str], non_negative: Sequence[str] = ()) -> DataFrame:
    """The day after the last one of each key, from stored moments."""
    return _wide(_next_day(fitted(state)), metrics, non_negative, is_backtest=False)


def next_day_forecast(history: DataFrame, metrics: Sequence[str], non_negative: Sequence[str] = ()) -> DataFrame:
    return _wide(_next_day(fit_per_key(history, metrics)), metrics, non_negative, is_backtest=False)


def _moments_by_block(history: DataFrame, metrics: Sequence[str], block: Column) -> DataFrame:
    """The rows of :func:`_long` with the moments of all rows before, made per key, metric and block of days."""
    keys, order = ["key", "metric"], ["date"]
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("y")) for m in metrics])
    rows = history.select("key", "date", block.alias(BLOCK), F.inline(pairs))
    rows = add_season(lagged(rows, keys, order, "y", "lag_1"))
    middle = rows.groupBy(*keys).agg(F.coalesce(F.avg("y"), F.lit(0.0)).alias("_middle"))
    rows = lookup(rows, middle, keys)
    sums = regression.shifted_sums("y", FEATURES, F.col("_middle"))
    return running_sums(rows, keys, order, sums).withColumns(regression.moments_of_sums(F.col("_middle"))).drop(BLOCK, "_middle", *sums)


def walk_forward(
    history: DataFrame, metrics: Sequence[str], non_negative: Sequence[str] = (), block: Column | None = None,
) -> DataFrame:
    """For every day, the prediction of a model fitted on the earlier days only.

    One task works on a key. For series too long for that, ``block`` names the stretch of a row, a column that never falls with
    the date: tasks then work on stretches, and moments are carried from one to the next.
    """
    if block is None:
        before = by_day("key", "metric").rowsBetween(Window.unboundedPreceding, -1)
        rows = _long(history, metrics)
        rows = rows.withColumns(regression.moments("y", FEATURES, over=before))
    else:
        rows = _moments_by_block(history, metrics, block)
    rows = rows.where(F.col("n") >= MIN_TRAINING_ROWS)
    rows = rows.withColumns(regression.coefficients())
    points = rows.withColumns({"target_date": F.col("date"), "yhat": regression.predicted(tuple(F.col(c) for c in FEATURES))})
    return _wide(points, metrics, non_negative, is_backtest=True)


def skipped_keys(history: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Keys without a prediction, as warnings for the run log."""
    keys = history.groupBy("key").agg(F.count("*").alias("days"))
    detail = F.concat(F.lit("no prediction for "), "key", F.lit(" from "), F.col("days"), F.lit(" settled days"))
    missing = keys.join(forecasts.select("key").distinct(), "key", "left_anti")
    return missing.select("key", "days", F.lit("warn").alias("status"), detail.alias("detail"))


def stored_runs(
    daily: DataFrame, live_days: Sequence[str], as_of: str, metrics: Sequence[str], non_negative: Sequence[str] = ()
) -> DataFrame:
    """What the forecast table holds after runs on ``live_days`` and a backtest up to ``as_of``.

    One pass over the rows of a key makes both kinds: the fit of a run is that of all rows up to the last
    one it knew, the fit of a backtest point that of all rows before its own. A day that a run predicted
    gets no backtest point. Everything after the rollup stays in the partitioning by key.
    """
    days = by_day("key", "metric")
    rows = _long(settled_history(daily, max(as_of, *live_days), metrics), metrics)
    frames = {"before": days.rowsBetween(Window.unboundedPreceding, -1), "upto": days.rowsBetween(Window.unboundedPreceding, 0)}
    fits = {}
    for frame, over in frames.items():
        fits |= {f"{frame}_{name}": c for name, c in regression.moments("y", FEATURES, over=over).items()}
    names = list(regression.moments("y", FEATURES))
    rows = rows.withColumns(fits | {"next_date": F.lead("date").over(days)})

    def point(frame: str, is_backtest: bool, target: Column, x: Sequence[Column]) -> Column:
        values = {"is_backtest": F.lit(is_backtest), "target_date": target, **dict(zip(("x_lag", "x_sin", "x_cos"), x))}
        return F.struct(*[c.alias(n) for n, c in values.items()], *[F.col(f"{frame}_{n}").alias(n) for n in names])

    knew = [(F.col("date") <= F.lit(d).cast("date")) & (F.col("next_date").isNull() | (F.col("next_date") > F.lit(d).cast("date")))
            for d in live_days]
    enough = lambda frame: F.col(f"{frame}_n") >= MIN_TRAINING_ROWS
    tomorrow = F.date_add("date", 1)
    live = F.when(reduce(Column.__or__, knew) & enough("upto"), point("upto", False, tomorrow, (F.col("y"), *season(tomorrow))))
    past = F.when((F.col("date") <= F.lit(as_of).cast("date")) & enough("before"),
                  point("before", True, F.col("date"), [F.col(c) for c in FEATURES]))
    points = rows.select("key", "metric", F.explode(F.array(live, past)).alias("p")).where("p IS NOT NULL")
    points = points.select("key", "metric", "p.*")
    points = points.withColumns(regression.coefficients())
    points = points.withColumn("yhat", regression.predicted((F.col("x_lag"), F.col("x_sin"), F.col("x_cos"))))
    made = _wide(points, metrics, non_negative, F.col("is_backtest"), run=["is_backtest"])
    return first_wins(made, ["key", "target_date"], ["is_backtest"]).select(*made.columns)


def forecast_evaluation(forecasts: DataFrame, daily: DataFrame, as_of: str, metrics: Sequence[str]) -> DataFrame:
    """Predicted next to actual for every settled target day. Both sides hold one row per key and day."""
    settled = forecasts.where(F.col("target_date") < F.lit(as_of).cast("date"))
    actual = daily.select("key", F.col("date").alias("target_date"), *[F.col(m).alias(f"actual_{m}") for m in metrics])
    pairs = [c for m in metrics for c in (f"predicted_{m}", f"actual_{m}")]
    return settled.join(actual, ["key", "target_date"]).select("key", "target_date", "is_backtest", "model_type", *pairs)
