"""Versions, lags, fits, forecasts and backtests."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators.dedupe import latest_wins, prefer_live
from daybook.operators.features import lag_features, one_hot, roll7_features
from daybook.operators.rollup import Measure, daily_rollup
from daybook.plans import compare
from daybook.plans.forecast import (
    fit_per_key, forecast_evaluation, next_day_forecast, settled_history, skipped_keys, walk_forward,
)
from tests.conftest import rows

DAY0 = date(2024, 3, 1)


def _series(spark, values, key="a", start=DAY0, skip=()):
    days = [start + timedelta(days=i) for i in range(len(values) + len(skip))]
    days = [d for i, d in enumerate(days) if i not in skip]
    return spark.createDataFrame([(key, d, v) for d, v in zip(days, values)], "key string, date date, m double")


def _noisy(n, seed=0):
    return [float(v) for v in np.round(10 + 3 * np.random.default_rng(seed).standard_normal(n), 1)]


def _lstsq(values, first, target_lag, target_day):
    """Plain least squares on (lag, sin, cos), the first row having no lag."""
    def season(d):
        a = 2 * np.pi * d.timetuple().tm_yday / 365.25
        return [np.sin(a), np.cos(a)]

    x = np.array([[1.0, values[i - 1], *season(first + timedelta(days=i))] for i in range(1, len(values))])
    coef, *_ = np.linalg.lstsq(x, np.array(values[1:]), rcond=None)
    return float(np.dot(coef, [1.0, target_lag, *season(target_day)]))


def test_latest_version_wins_and_ties_are_settled(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 1, 7, "y"), ("a", 1, 7, "z"), ("a", 2, 1, "w")],
                               "key string, ts int, version int, source string")
    assert rows(latest_wins(df, ["key", "ts"], "version", ["source"]), "ts") == [("a", 1, 7, "z"), ("a", 2, 1, "w")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=25))
def test_latest_wins_is_the_maximum_and_idempotent(spark, data):
    df = spark.createDataFrame(data, "key int, version int, tie int")
    once = latest_wins(df, ["key"], "version", ["tie"])
    best = {}
    for k, v, t in data:
        best[k] = max(best.get(k, (v, t)), (v, t))
    assert rows(once, "key") == [(k, *best[k]) for k in sorted(best)]
    assert rows(latest_wins(once, ["key"], "version", ["tie"]), "key") == rows(once, "key")


def test_live_beats_backtest(spark):
    df = spark.createDataFrame([("a", 1, True, "m"), ("a", 1, False, "m"), ("a", 2, True, "m")],
                               "key string, d int, is_backtest boolean, model_type string")
    assert rows(prefer_live(df, ["key", "d"]).select("d", "is_backtest"), "d") == [(1, False), (2, True)]


def test_decimal_sum_ignores_order(spark):
    values = [0.05, 1e6, 0.1, -1e6, 0.15, 0.75]
    measure = [Measure("s", "sum", "v", 1, scale=2)]
    for order in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([("a", datetime(2024, 1, 1), v) for v in order], "key string, ts timestamp_ntz, v double")
        assert daily_rollup(df, "key", "ts", measure).first().s == 1.1


def test_rollup_keeps_missing_as_missing(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1), None)], "key string, ts timestamp_ntz, v double")
    out = daily_rollup(df, "key", "ts", [Measure("s", "sum", "v"), Measure("x", "max", "v"), Measure("m", "avg", "v")])
    assert out.first()[2:] == (None, None, None)


def test_lag_is_the_previous_row_whatever_the_gap(spark):
    df = lag_features(_series(spark, [1.0, 2.0, 3.0], skip=(1,)), ["m"], depth=2)
    assert rows(df.select("lag_1_m", "lag_2_m").orderBy("date")) == [(None, None), (1.0, None), (2.0, 1.0)]


def test_roll7_needs_seven_values(spark):
    df = roll7_features(_series(spark, [float(i) for i in range(1, 10)]), ["m"])
    assert [r[0] for r in rows(df.select("roll7_m").orderBy("date"))] == [None] * 7 + [4.0, 5.0]


def test_one_hot(spark):
    df = one_hot(spark.createDataFrame([("a",), ("b",)], "key string"), "key", ["a", "b"], "is")
    assert rows(df, "key") == [("a", 1, 0), ("b", 0, 1)]


def test_settled_history_bounds(spark):
    daily = _series(spark, [1.0, 2.0, 3.0])
    assert settled_history(daily, "2024-03-02", ["m"]).count() == 2
    assert settled_history(daily, "2024-03-02", ["m"], strict=True).count() == 1


@pytest.mark.parametrize("n,points", [(11, 0), (12, 1), (30, 19)])
def test_backtest_starts_after_ten_training_rows(spark, n, points):
    assert walk_forward(_series(spark, _noisy(n)), ["m"]).count() == points


def test_backtest_equals_least_squares(spark):
    values = _noisy(30, seed=7)
    made = {r.target_date: (r.predicted_m, r.training_rows) for r in walk_forward(_series(spark, values), ["m"]).collect()}
    for i in range(11, 30):
        day = DAY0 + timedelta(days=i)
        assert made[day][0] == pytest.approx(_lstsq(values[:i], DAY0, values[i - 1], day), abs=0.051)
        assert made[day][1] == i - 1


def test_next_day_equals_least_squares(spark):
    values = _noisy(25, seed=3)
    row = next_day_forecast(_series(spark, values), ["m"]).first()
    day = DAY0 + timedelta(days=25)
    assert row.target_date == day and row.training_rows == 24 and row.is_backtest is False
    assert row.predicted_m == pytest.approx(_lstsq(values, DAY0, values[-1], day), abs=0.051)


def test_constant_series_predicts_its_value(spark):
    """A lag without variance carries no information: the fit falls back to the season."""
    history = _series(spark, [5.0] * 15)
    assert next_day_forecast(history, ["m"]).first().predicted_m == 5.0
    assert {r.predicted_m for r in walk_forward(history, ["m"]).collect()} == {5.0}


def test_missing_values_leave_the_fit_and_skip_the_key(spark):
    values = _noisy(20, seed=1)
    holed = values[:8] + [None] + values[9:]
    fit = fit_per_key(_series(spark, holed), ["m"]).first()
    assert fit.n == 17  # the first row, the hole and the row after it
    made = walk_forward(_series(spark, holed), ["m"])
    assert made.agg(F.min("target_date")).first()[0] == DAY0 + timedelta(days=13)
    at_end = _series(spark, values + [None])
    assert next_day_forecast(at_end, ["m"]).count() == 0
    assert rows(skipped_keys(at_end, next_day_forecast(at_end, ["m"])).select("key", "days", "status")) == [("a", 21, "warn")]


def test_a_day_needs_every_metric(spark):
    n = 14
    a = _noisy(n, 1)
    b = [None] * 6 + _noisy(n - 6, 2)
    history = spark.createDataFrame([("a", DAY0 + timedelta(days=i), a[i], b[i]) for i in range(n)],
                                    "key string, date date, m double, k double")
    assert walk_forward(history, ["m"]).count() == 3
    assert walk_forward(history, ["m", "k"]).count() == 0
    assert next_day_forecast(history, ["m", "k"]).count() == 0


def test_non_negative_metrics_are_clipped(spark):
    falling = _series(spark, [float(30 - 2 * i) + (i % 3) * 0.5 for i in range(16)])
    below = next_day_forecast(falling, ["m"]).first().predicted_m
    assert below < 0 and next_day_forecast(falling, ["m"], ["m"]).first().predicted_m == 0.0


def test_evaluation_is_strictly_before_the_day(spark):
    daily = _series(spark, _noisy(20))
    points = walk_forward(daily, ["m"])
    assert forecast_evaluation(points, daily, "2024-03-13", ["m"]).count() == 1


def test_error_table_and_summary(spark):
    evaluation = spark.createDataFrame(
        [("a", DAY0, True, "linear_regression_v1", 1.0, 3.0, 5.0, 4.0), ("b", DAY0, False, "linear_regression_v1", 1.0, 9.0, 1.0, 9.0)],
        "key string, target_date date, is_backtest boolean, model_type string, predicted_m double, actual_m double, predicted_k double, actual_k double")
    errors = compare.linear_errors(evaluation, ["m", "k"])
    assert rows(errors.select("metric", "linear_error"), "metric") == [("k", 1.0), ("m", 2.0)]
    summary = compare.mae_summary(errors, "linear", "linear_error", ["m", "k"])
    assert rows(summary) == [("linear", 2.0, 1.0, 1)]
    record = compare.experiment_record(summary, {"model": "linear"}, ["m", "k"]).first()
    assert record.params == {"model": "linear"} and record.metrics == {"mae_m": 2.0, "mae_k": 1.0, "n_points": 1.0}


def test_experiment_log_grows(spark):
    record = spark.sql("SELECT 'r' AS run, map('model', 'linear') AS params, map('mae_m', 1.5D) AS metrics")
    for minute in (1, 2):
        compare.log_experiments(record, datetime(2024, 1, 1, 0, minute), "t_ops.experiments")
    log = spark.table("t_ops.experiments")
    assert rows(log.select("run", F.col("metrics")["mae_m"], "logged_at"), "logged_at") == [
        ("r", 1.5, datetime(2024, 1, 1, 0, 1)), ("r", 1.5, datetime(2024, 1, 1, 0, 2))]
