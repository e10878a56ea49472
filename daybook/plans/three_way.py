"""A free-text call, the model and reality side by side, one row per target day: as a DataFrame, and as a view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.scoring import call_correct, celsius, kmh, model_correct
from daybook.operators.dedupe import prefer_live
from daybook.sources.tables import publish_view


def three_way_compare(
    calls: DataFrame, forecasts: DataFrame, daily: DataFrame, key: str, as_of: str, event_metric: str,
    high_metric: str, low_metric: str, wind_metric: str, threshold: float,
) -> DataFrame:
    """Score the call and the model against what happened.

    Every input is cut to the one key before the joins, so each side has at most one
    row per calendar day. Conditions on the right sides are filters below the left
    joins: a call without a forecast or a settled day stays, with NULLs.
    """
    model = prefer_live(forecasts.where(F.col("key") == key), ["target_date"]).select(
        "target_date",
        F.col(f"predicted_{high_metric}").alias("model_high"),
        F.col(f"predicted_{low_metric}").alias("model_low"),
        F.col(f"predicted_{event_metric}").alias("model_amount"),
        F.col("is_backtest").alias("model_is_backtest"),
    )
    actual = daily.where((F.col("key") == key) & (F.col("date") < F.lit(as_of).cast("date"))).select(
        F.col("date").alias("target_date"), F.lit(True).alias("settled"),
        F.col(high_metric).alias("actual_high"), F.col(low_metric).alias("actual_low"),
        F.col(event_metric).alias("actual_amount"), F.col(wind_metric).alias("actual_wind"),
    )
    joined = calls.join(model, "target_date", "left").join(actual, "target_date", "left")

    settled = F.coalesce("settled", F.lit(False))
    happened = F.col("actual_amount") > threshold
    return joined.select(
        F.lit(key).alias("key"), "target_date", "issued_at", "call",
        celsius(F.col("high_f")).alias("call_high"), celsius(F.col("low_f")).alias("call_low"),
        kmh(F.col("gust_mph")).alias("call_gust"), "hazards", "summary", "verified",
        "model_high", "model_low", "model_amount", "model_is_backtest",
        "actual_high", "actual_low", "actual_amount", "actual_wind",
        call_correct(settled, F.col("call"), F.col("verified"), happened).alias("call_correct"),
        model_correct(settled, F.col("model_amount"), threshold, happened).alias("model_correct"),
    )


def publish_comparison_view(
    spark: SparkSession, extractions: str, forecasts: str, daily: str, key: str, event_metric: str, high_metric: str,
    low_metric: str, wind_metric: str, threshold: float, name: str = "gold.call_comparison",
) -> None:
    """What :func:`three_way_compare` gives for stored weather extractions, as a view up to the day before today."""
    def one_decimal(value: str) -> str:
        return f"round(({value}) * 10) / 10"

    event = f"actual.{event_metric} > {threshold}"
    publish_view(spark, name, f"""
        SELECT '{key}' AS key, target_date, issued_at, rain_expected AS call,
               {one_decimal('(high_temp_f - 32) * 5 / 9')} AS call_high, {one_decimal('(low_temp_f - 32) * 5 / 9')} AS call_low,
               {one_decimal('max_wind_gust_mph * 1.609')} AS call_gust, hazards, summary, evidence_verified AS verified,
               model.predicted_{high_metric} AS model_high, model.predicted_{low_metric} AS model_low,
               model.predicted_{event_metric} AS model_amount, model.is_backtest AS model_is_backtest,
               actual.{high_metric} AS actual_high, actual.{low_metric} AS actual_low, actual.{event_metric} AS actual_amount,
               actual.{wind_metric} AS actual_wind,
               CASE WHEN coalesce(evidence_verified, true) THEN map('none', false, 'likely', true)[rain_expected] = ({event}) END AS call_correct,
               (model.predicted_{event_metric} > {threshold}) = ({event}) AS model_correct
        FROM {extractions}
        LEFT JOIN (SELECT target_date, min_by(struct(*), struct(is_backtest, model_type)) AS model
                   FROM {forecasts} WHERE key = '{key}' GROUP BY target_date) USING (target_date)
        LEFT JOIN (SELECT date AS target_date, struct(*) AS actual FROM {daily}
                   WHERE key = '{key}' AND date < current_date()) USING (target_date)""")
