"""Registered queries: per-key fits, next-day forecasts, backtests, evaluation, accuracy."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators.dedupe import prefer_live
from daybook.plans import compare, reports
from daybook.plans.forecast import (
    fit_per_key, forecast_evaluation, next_day_forecast, settled_history, stored_runs, walk_forward,
)
from daybook.registered.base import (
    EVENT_METRICS, EVENT_NON_NEGATIVE, EVENTS_DAILY, LINE_METRICS, LINE_NON_NEGATIVE, LINES_DAILY,
    events_daily, lines_daily,
)

LIVE_DAYS = ["2024-01-20", "2024-01-25"]
AS_OF = "2024-01-28"
LINES_AS_OF = "2001-06-30"


def stored_forecasts(spark, d):
    """The daily rollup, and the forecasts that the table would hold."""
    daily = events_daily(spark, d)
    return daily, stored_runs(daily, LIVE_DAYS, AS_OF, EVENT_METRICS, EVENT_NON_NEGATIVE)


def evaluation(spark, d):
    daily, forecasts = stored_forecasts(spark, d)
    return forecast_evaluation(forecasts, daily, AS_OF, EVENT_METRICS)


def _ols_fit(spark, d):
    fitted = fit_per_key(settled_history(lines_daily(spark, d), LINES_AS_OF, LINE_METRICS), LINE_METRICS)
    slopes = [F.round(c, 4).alias(c) for c in ("intercept", "b1", "b2", "b3")]
    return fitted.select("key", "metric", F.col("n").alias("training_rows"), *slopes)


def _live_latest(spark, d):
    daily, forecasts = stored_forecasts(spark, d)
    return reports.live_latest(forecasts, ["click", "purchase", "view"])


def _unpivot_errors(spark, d):
    return compare.linear_errors(evaluation(spark, d), EVENT_METRICS)


QUERIES = {
    "ols_fit": _ols_fit,
    "next_day_forecast": lambda s, d: next_day_forecast(
        settled_history(events_daily(s, d), LIVE_DAYS[-1], EVENT_METRICS), EVENT_METRICS, EVENT_NON_NEGATIVE),
    "next_day_forecast_lineitem": lambda s, d: next_day_forecast(
        settled_history(lines_daily(s, d), LINES_AS_OF, LINE_METRICS), LINE_METRICS, LINE_NON_NEGATIVE),
    "walk_forward": lambda s, d: walk_forward(
        settled_history(events_daily(s, d), AS_OF, EVENT_METRICS), EVENT_METRICS, EVENT_NON_NEGATIVE),
    "walk_forward_lineitem": lambda s, d: walk_forward(
        settled_history(lines_daily(s, d), LINES_AS_OF, LINE_METRICS), LINE_METRICS, LINE_NON_NEGATIVE),
    "forecast_evaluation": evaluation,
    "prefer_live": lambda s, d: prefer_live(stored_forecasts(s, d)[1], ["key", "target_date"]),
    "live_latest": _live_latest,
    "backtest_split": lambda s, d: reports.backtest_split(evaluation(s, d)),
    "accuracy_pair": lambda s, d: reports.accuracy_pair(evaluation(s, d), "purchase", "value_avg"),
    "unpivot_errors": _unpivot_errors,
    "mae_summary": lambda s, d: compare.mae_summary(
        _unpivot_errors(s, d), "linear_per_key", "linear_error", EVENT_METRICS),
}

# ---- the same as SQL ----------------------------------------------------------------------


def _long_sql(history: str, metrics: list[str]) -> str:
    """Rows (key, metric, date, y) with lag and season, masked where the fit must not use them."""
    rows = " UNION ALL ".join(f"SELECT key, date, '{m}' AS metric, {m} AS y FROM {history}" for m in metrics)
    return f"""
    SELECT *, CASE WHEN x1 IS NOT NULL THEN y END AS vy, CASE WHEN y IS NOT NULL THEN x1 END AS v1,
           CASE WHEN y IS NOT NULL AND x1 IS NOT NULL THEN x2 END AS v2,
           CASE WHEN y IS NOT NULL AND x1 IS NOT NULL THEN x3 END AS v3
    FROM (SELECT *, LAG(y) OVER (PARTITION BY key, metric ORDER BY date) AS x1,
                 SIN(2 * PI() * dayofyear(date) / 365.25) AS x2, COS(2 * PI() * dayofyear(date) / 365.25) AS x3
          FROM ({rows}))"""


_PAIRS = ("11", "12", "13", "22", "23", "33", "1y", "2y", "3y")


def _moments_sql(over: str) -> str:
    means = [f"AVG(v{k}){over} AS m{k}" for k in "123y"]
    covs = [f"COVAR_POP(v{p[0]}, v{p[1]}){over} AS c{p}" for p in _PAIRS]
    return ", ".join([f"COUNT(vy){over} AS n", *means, *covs])


_DET = "(c11 * (c22 * c33 - c23 * c23) - c12 * (c12 * c33 - c23 * c13) + c13 * (c12 * c23 - c22 * c13))"
_SLOPES = f"""
    CASE WHEN c11 <= 1e-20 * m1 * m1 THEN 0.0
         WHEN abs({_DET}) > 1e-10 * c11 * c22 * c33 THEN
              (c1y * (c22 * c33 - c23 * c23) - c12 * (c2y * c33 - c23 * c3y) + c13 * (c2y * c23 - c22 * c3y)) / {_DET}
    END AS b1,
    CASE WHEN c11 <= 1e-20 * m1 * m1 THEN (c2y * c33 - c3y * c23) / (c22 * c33 - c23 * c23)
         WHEN abs({_DET}) > 1e-10 * c11 * c22 * c33 THEN
              (c11 * (c2y * c33 - c23 * c3y) - c1y * (c12 * c33 - c23 * c13) + c13 * (c12 * c3y - c2y * c13)) / {_DET}
    END AS b2,
    CASE WHEN c11 <= 1e-20 * m1 * m1 THEN (c3y * c22 - c2y * c23) / (c22 * c33 - c23 * c23)
         WHEN abs({_DET}) > 1e-10 * c11 * c22 * c33 THEN
              (c11 * (c22 * c3y - c2y * c23) - c12 * (c12 * c3y - c2y * c13) + c1y * (c12 * c23 - c22 * c13)) / {_DET}
    END AS b3"""


def _fit_sql(history: str, metrics: list[str]) -> str:
    return f"""
    SELECT *, my - b1 * m1 - b2 * m2 - b3 * m3 AS intercept FROM (
        SELECT *, {_SLOPES} FROM (
            SELECT key, metric, {_moments_sql('')}, MAX(date) AS last_date, arg_max(y, date) AS last_y
            FROM ({_long_sql(history, metrics)}) GROUP BY key, metric) WHERE n >= 10)"""


def _wide_sql(points: str, metrics: list[str], non_negative: list[str], is_backtest: bool) -> str:
    clipped = ", ".join(f"'{m}'" for m in non_negative)
    columns = ", ".join(f"MAX(yhat) FILTER (WHERE metric = '{m}') AS predicted_{m}" for m in metrics)
    return f"""
    SELECT key, target_date, {columns}, 'linear_regression_v1' AS model_type,
           MAX(n) FILTER (WHERE metric = '{metrics[-1]}') AS training_rows, {str(is_backtest).upper()} AS is_backtest
    FROM (SELECT key, metric, target_date, n,
                 ROUND(CASE WHEN metric IN ({clipped}) AND yhat < 0 THEN 0.0 ELSE yhat END, 1) + 0.0 AS yhat
          FROM ({points}))
    GROUP BY key, target_date HAVING COUNT(yhat) = {len(metrics)}"""


def next_day_sql(history: str, metrics: list[str], non_negative: list[str]) -> str:
    angle = "2 * PI() * dayofyear(last_date + 1) / 365.25"
    points = f"""
    SELECT key, metric, n, last_date + 1 AS target_date,
           my + b1 * (last_y - m1) + b2 * (SIN({angle}) - m2) + b3 * (COS({angle}) - m3) AS yhat
    FROM ({_fit_sql(history, metrics)})"""
    return _wide_sql(points, metrics, non_negative, False)


def walk_forward_sql(history: str, metrics: list[str], non_negative: list[str]) -> str:
    over = " OVER (PARTITION BY key, metric ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    points = f"""
    SELECT key, metric, n, date AS target_date, my + b1 * (x1 - m1) + b2 * (x2 - m2) + b3 * (x3 - m3) AS yhat
    FROM (SELECT *, {_SLOPES} FROM (
        SELECT key, metric, date, x1, x2, x3, {_moments_sql(over)} FROM ({_long_sql(history, metrics)})) WHERE n >= 10)"""
    return _wide_sql(points, metrics, non_negative, True)


def event_history(day: str) -> str:
    return f"(SELECT * FROM daily WHERE date <= DATE '{day}')"


_LINE_HISTORY = f"(SELECT * FROM daily WHERE date <= DATE '{LINES_AS_OF}')"
_LIVE = " UNION ALL ".join(
    f"SELECT * FROM ({next_day_sql(event_history(day), EVENT_METRICS, EVENT_NON_NEGATIVE)})" for day in LIVE_DAYS)

FORECASTS = f"""{EVENTS_DAILY},
live AS ({_LIVE}),
backtest AS ({walk_forward_sql(event_history(AS_OF), EVENT_METRICS, EVENT_NON_NEGATIVE)}),
forecasts AS (
    SELECT * FROM live UNION ALL
    SELECT * FROM backtest b WHERE NOT EXISTS (
        SELECT 1 FROM live l WHERE l.key = b.key AND l.target_date = b.target_date)
),
settled AS (
    SELECT key, date AS target_date, COLUMNS(* EXCLUDE (key, date)) AS "actual_\\0" FROM daily WHERE date < DATE '{AS_OF}'
),
evaluation AS (
    SELECT * EXCLUDE (training_rows) FROM settled JOIN forecasts USING (key, target_date)
)"""

_ERRORS = " UNION ALL ".join(
    f"SELECT key, target_date, '{m}' AS metric, ROUND(ABS(predicted_{m} - actual_{m}), 6) AS linear_error FROM evaluation"
    f" WHERE is_backtest AND model_type = 'linear_regression_v1'"
    for m in EVENT_METRICS)

ORACLES = {
    "ols_fit": f"""
        WITH {LINES_DAILY} SELECT key, metric, n AS training_rows, ROUND(intercept, 4) + 0.0 AS intercept,
               ROUND(b1, 4) + 0.0 AS b1, ROUND(b2, 4) + 0.0 AS b2, ROUND(b3, 4) + 0.0 AS b3
        FROM ({_fit_sql(_LINE_HISTORY, LINE_METRICS)})""",
    "next_day_forecast": f"""
        WITH {EVENTS_DAILY} {next_day_sql(event_history(LIVE_DAYS[-1]), EVENT_METRICS, EVENT_NON_NEGATIVE)}""",
    "next_day_forecast_lineitem": f"WITH {LINES_DAILY} {next_day_sql(_LINE_HISTORY, LINE_METRICS, LINE_NON_NEGATIVE)}",
    "walk_forward": f"""
        WITH {EVENTS_DAILY} {walk_forward_sql(event_history(AS_OF), EVENT_METRICS, EVENT_NON_NEGATIVE)}""",
    "walk_forward_lineitem": f"WITH {LINES_DAILY} {walk_forward_sql(_LINE_HISTORY, LINE_METRICS, LINE_NON_NEGATIVE)}",
    "forecast_evaluation": f"WITH {FORECASTS} SELECT * FROM evaluation",
    "prefer_live": f"""
        WITH {FORECASTS} SELECT * EXCLUDE (rn) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY key, target_date ORDER BY is_backtest, model_type) AS rn
            FROM forecasts) WHERE rn = 1""",
    "live_latest": f"""
        WITH {FORECASTS} SELECT * EXCLUDE (rn) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY target_date DESC) AS rn FROM forecasts
            WHERE NOT is_backtest AND key IN ('click', 'purchase', 'view')) WHERE rn = 1""",
    "backtest_split": f"""
        WITH {FORECASTS} SELECT COUNT(*) AS n_points, COUNT(*) FILTER (WHERE is_backtest) AS n_backtest,
               COUNT(*) FILTER (WHERE NOT is_backtest) AS n_live FROM evaluation""",
    "accuracy_pair": f"""
        WITH {FORECASTS} SELECT target_date, predicted_value_avg AS predicted, actual_value_avg AS actual,
               ROUND(ABS(predicted_value_avg - actual_value_avg), 2) AS error
        FROM evaluation WHERE key = 'purchase' ORDER BY target_date""",
    "unpivot_errors": f"WITH {FORECASTS} {_ERRORS}",
    "mae_summary": f"""
        WITH {FORECASTS}, errors AS ({_ERRORS})
        SELECT 'linear_per_key' AS run, {', '.join(
            f"ROUND(AVG(linear_error) FILTER (WHERE metric = '{m}'), 2) AS {m}" for m in EVENT_METRICS)},
            COUNT(*) // {len(EVENT_METRICS)} AS n_points FROM errors""",
}
