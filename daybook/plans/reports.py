"""The report queries behind a dashboard."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.dates import seconds_between
from daybook.functions.scoring import light, rounded
from daybook.operators.dedupe import latest_wins

def distinct_keys(df: DataFrame) -> DataFrame:
    return df.select("key").distinct().orderBy("key")


def data_up_to(daily: DataFrame, as_of: str) -> DataFrame:
    return daily.where(F.col("date") <= F.lit(as_of).cast("date")).agg(F.max("date").alias("data_up_to"))


def report_daily(daily: DataFrame, keys: Sequence[str], as_of: str, metrics: Sequence[str]) -> DataFrame:
    chosen = daily.where(F.col("key").isin(*keys) & (F.col("date") <= F.lit(as_of).cast("date")))
    return chosen.select("key", "date", *metrics).orderBy(F.desc("date"), "key")


def newest_first(rows: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str]) -> DataFrame:
    """Rows of the chosen keys, newest first; the tie columns keep the range partitions of the sort even."""
    return rows.where(F.col("key").isin(*keys)).orderBy(F.desc(ts), *ties)


def fetch_log(raw: DataFrame, key: str, version: str, source: str, payload: str, keys: Sequence[str] = ()) -> DataFrame:
    """What was fetched when, newest first, for the chosen keys or all."""
    chosen = raw.where(F.col(key).isin(*keys)) if keys else raw
    return chosen.select(key, version, source, F.length(payload).alias("payload_chars")).orderBy(F.desc(version), key, source)


def _is_vector(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))


def table_preview(df: DataFrame, skip: Sequence[str], order: Sequence[str],
                  clip: Callable[[Column], Column], n: int = 5) -> DataFrame:
    """A few rows without raw payloads and vectors, long strings cut."""
    shown = [f for f in df.schema.fields if f.name not in skip and not _is_vector(f.dataType)]
    cut = [clip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in shown]
    return df.orderBy(*order).limit(n).select(*cut)


def live_latest(forecasts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest live forecast of each chosen key."""
    live = forecasts.where(~F.col("is_backtest") & F.col("key").isin(*keys))
    return latest_wins(live, ["key"], "target_date", ["model_type"])


def backtest_split(evaluation: DataFrame) -> DataFrame:
    """How many evaluated predictions are retroactive and how many were live."""
    return evaluation.agg(
        F.count("*").alias("n_points"),
        F.count_if("is_backtest").alias("n_backtest"),
        F.count_if(~F.col("is_backtest")).alias("n_live"),
    )


def accuracy_pair(evaluation: DataFrame, key: str, metric: str) -> DataFrame:
    """Predicted and actual of one metric for one key, complete pairs only, with the error."""
    pairs = evaluation.where(F.col("key") == key).select(
        "target_date", F.col(f"predicted_{metric}").alias("predicted"), F.col(f"actual_{metric}").alias("actual")
    )
    pairs = pairs.dropna(subset=["predicted", "actual"])
    return pairs.withColumn("error", rounded(F.abs(F.col("predicted") - F.col("actual")), 2)).orderBy("target_date")


def run_history(runs: DataFrame, n: int = 14) -> DataFrame:
    """The latest runs with their light, duration and error; a limit after a sort keeps n rows per task."""
    latest = runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(n)
    return latest.select(
        "run_id", "started_at", "finished_at", "status", light(F.col("status")).alias("light"), "n_pass", "n_warn", "n_fail",
        seconds_between(F.col("started_at"), F.col("finished_at")).alias("duration_s"), "error",
    )


def run_checks(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Every check of the latest run."""
    latest = runs.agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))
    shown = results.join(latest, "run_id", "left_semi")
    return shown.select(
        light(F.col("status")).alias("light"), "step", "check_name", "target", "detail"
    ).orderBy("step", "check_name", "target")
