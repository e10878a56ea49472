"""The daily run on stored tables: land, clean, summarise, forecast, each behind its gate.

Raw tables only grow: every source lands once per version, under the number of its landing. A
refresh merges the landings that came after the last one merged into the days they touch and
summarises those days again; the mark moves only when both tables are written, so what a failed
or broken run left over is merged by the next one. ``rebuild`` derives the same tables from all raw rows.
Forecasts come from stored fits, to which a run adds its days, and replace only the days they are made for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.dedupe import latest_wins
from daybook.operators.quality import (
    Check, fresh, group_count_record, group_counts, no_nulls, non_negative, not_empty, value_range,
)
from daybook.operators.rollup import Measure, daily_rollup
from daybook.plans.fit_state import advance, fit_state
from daybook.plans.forecast import next_day_forecast, settled_history, skipped_keys, state_forecast, walk_forward
from daybook.plans.gates import MAX_STALENESS_HOURS, Gate, RunLog, run_gates, warning
from daybook.schemas import MERGED, RAW_PAYLOADS, forecast_schema
from daybook.session import materialise
from daybook.sources.json_payload import unpack_payloads
from daybook.sources.landing import land_raw, list_files, new_payloads, new_versions
from daybook.sources.tables import absent, append, ensure_table, publish, replace_partitions

RAW, CLEAN, DAILY, FORECAST = "bronze.raw_payloads", "silver.hourly", "gold.daily_summary", "gold.forecast"
FITS = "gold.fit_state"
MARKS = "ops.merged"


@dataclass(frozen=True)
class DailyConfig:
    """What a run works on. Ranges are (column, low, high), bounds included, and become checks of their gate."""

    keys: Sequence[str]
    payload_measures: Sequence[str]
    measures: Sequence[Measure]
    non_negative: Sequence[str] = ()
    key_of_file: str = r"([^/]+?)(?:-[^/]*)?\.json$"
    required: Sequence[str] = field(default=("key", "ts"))
    clean_ranges: Sequence[tuple[str, float, float]] = ()
    forecast_ranges: Sequence[tuple[str, float, float]] = ()

    @property
    def metrics(self) -> list[str]:
        return [m.name for m in self.measures]

    @property
    def predictions(self) -> list[str]:
        return [f"predicted_{m}" for m in self.metrics]

    def clean_gate(self) -> tuple[Check, ...]:
        return (not_empty(), no_nulls(list(self.required)), *[value_range(*r) for r in self.clean_ranges])

    def forecast_gate(self) -> tuple[Check, ...]:
        return (no_nulls(["key", "target_date", *self.predictions]),
                *[non_negative(f"predicted_{m}") for m in self.non_negative],
                *[value_range(*r) for r in self.forecast_ranges])


def _last_landing(spark: SparkSession) -> int:
    return spark.table(RAW).agg(F.max("landing")).first()[0] or 0


def land(
    spark: SparkSession, path: str, config: DailyConfig, landed_at: datetime, since: str | None = None, until: str | None = None,
) -> int:
    """Append the files that have not landed in their present version; returns the number of the landing. No other file is opened."""
    ensure_table(spark, RAW, RAW_PAYLOADS, partition_by=["landed_on", "landing"])
    number = _last_landing(spark) + 1
    key: Column = F.regexp_extract("source_url", config.key_of_file, 1)
    new = materialise(new_versions(spark.table(RAW), list_files(spark, path, since, until)))
    for payloads in new_payloads(spark, new, key):
        rows = land_raw(payloads, "key", "source_url", "raw_json", F.col("fetched_at"))
        rows.withColumns({"landed_on": F.lit(landed_at.date()), "landing": F.lit(number).cast("long")}).write.insertInto(RAW)
    return number


def _unpacked(raw: DataFrame, config: DailyConfig) -> DataFrame:
    rows = unpack_payloads(raw, "raw_json", config.payload_measures, keep=["key", "fetched_at", "source_url"])
    return rows.withColumn("date", F.to_date("ts"))


def _newest(rows: DataFrame) -> DataFrame:
    """The newest fetch of every (key, hour); equal fetch times fall back to the source."""
    return latest_wins(rows, ["key", "ts"], "fetched_at", ["source_url"])


def _summary(clean: DataFrame, config: DailyConfig) -> DataFrame:
    return daily_rollup(clean, "key", "ts", config.measures)


def _merged(spark: SparkSession) -> int:
    """The last landing that is in both tables; 0 before the first."""
    ensure_table(spark, MARKS, MERGED)
    return spark.table(MARKS).where(F.col("target") == CLEAN).agg(F.max("landing")).first()[0] or 0


def _mark(spark: SparkSession, landing: int) -> None:
    row = spark.createDataFrame([(CLEAN, landing)], "target string, landing bigint")
    append(row.withColumn("merged_at", F.to_timestamp_ntz(F.current_timestamp())), MARKS)


def rebuild(spark: SparkSession, config: DailyConfig) -> None:
    """Full refresh of the clean and daily tables from every raw row."""
    ensure_table(spark, MARKS, MERGED)
    last = _last_landing(spark)
    raw = spark.table(RAW).where(F.col("landing") <= last)
    publish(_newest(_unpacked(raw, config)), CLEAN, partition_by=["date"])
    publish(_summary(spark.table(CLEAN), config), DAILY, partition_by=["date"])
    _mark(spark, last)


def refresh(spark: SparkSession, config: DailyConfig) -> list[date] | None:
    """Merge the landings since the last merged one into the days they touch; other days are neither read nor written.

    Returns those days, or None where all days were made anew.
    """
    done, last = _merged(spark), _last_landing(spark)
    if not (done and spark.catalog.tableExists(CLEAN) and spark.catalog.tableExists(DAILY)):
        rebuild(spark, config)
        return None
    raw = spark.table(RAW).where(F.col("landing").between(done + 1, last))
    fresh_rows = materialise(_unpacked(raw, config))
    # The list of days is bounded by the calendar and prunes partitions at planning time.
    days = [r.date for r in fresh_rows.select("date").distinct().collect()]
    if days:
        stored = spark.table(CLEAN).where(F.col("date").isin(*days))
        merged = _newest(stored.unionByName(fresh_rows.select(*stored.columns)))
        replace_partitions(materialise(merged), CLEAN)
        replace_partitions(_summary(spark.table(CLEAN).where(F.col("date").isin(*days)), config), DAILY)
    if last > done:
        _mark(spark, last)
    return days


def _fitted_to(spark: SparkSession) -> tuple[date, int] | None:
    """The day that the stored fits go to, and the last landing that was merged when they were made."""
    if not spark.catalog.tableExists(FITS):
        return None
    known = spark.table(FITS).select("as_of", "landing").limit(1).collect()
    return (known[0].as_of, known[0].landing) if known else None


def refit(spark: SparkSession, config: DailyConfig, as_of: str, merged_before: int, days: list[date] | None) -> None:
    """Bring the stored fits up to ``as_of``: the days after those they know are added, history is not read.

    Fits are made from whole history where there are none, where they missed a landing, where a day that they know has changed, or
    where they know more than ``as_of`` allows. ``merged_before`` and ``days`` tell what the refresh before has merged.
    """
    known, limit = _fitted_to(spark), date.fromisoformat(as_of)
    unchanged = known is not None and known[1] == merged_before and known[0] <= limit and days is not None and all(d > known[0] for d in days)
    history = settled_history(spark.table(DAILY), as_of, config.metrics)
    if unchanged:
        stored = spark.table(FITS).drop("as_of", "landing")
        state = advance(stored, history.where(F.col("date") > F.lit(known[0])), config.metrics)
    else:
        state = fit_state(history, config.metrics)
    publish(state.withColumns({"as_of": F.lit(limit), "landing": F.lit(_merged(spark)).cast("long")}), FITS)


def forecast(spark: SparkSession, config: DailyConfig, as_of: str) -> DataFrame:
    """From whole history; a run takes the stored fits."""
    history = settled_history(spark.table(DAILY), as_of, config.metrics)
    return next_day_forecast(history, config.metrics, config.non_negative)


def backtest(spark: SparkSession, config: DailyConfig, as_of: str) -> None:
    """Add retroactive points for days that have no forecast of either kind yet."""
    ensure_table(spark, FORECAST, forecast_schema(config.metrics), partition_by=["target_date"])
    stored = spark.table(FORECAST)
    history = settled_history(spark.table(DAILY), as_of, config.metrics)
    points = walk_forward(history, config.metrics, config.non_negative)
    absent(stored, points, ["key", "target_date"]).select(*stored.columns).write.insertInto(FORECAST)


def _of_days(table: DataFrame, days: list[date] | None) -> DataFrame:
    return table if days is None else table.where(F.col("date").isin(*days))


def run(
    spark: SparkSession, path: str, config: DailyConfig, now: datetime, triggered_by: str = "local",
    since: str | None = None, until: str | None = None,
) -> None:
    """One run. A failed gate stops it; the log records it either way."""
    with RunLog(spark, now, triggered_by) as log:
        steps(spark, log, path, config, now, since, until)


def steps(
    spark: SparkSession, log: RunLog, path: str, config: DailyConfig, now: datetime, since: str | None = None, until: str | None = None,
) -> None:
    """The numeric steps of a run, recorded in ``log``. Gates look at what the run touched."""
    as_of, stamp = now.date().isoformat(), now.isoformat(sep=" ")
    number = land(spark, path, config, now, since, until)
    newest = spark.table(RAW).where(F.col("landing") == _last_landing(spark))
    log.record(run_gates({RAW: newest}, [Gate("bronze", RAW, (not_empty(), fresh("fetched_at", stamp, MAX_STALENESS_HOURS)))]))
    landed = spark.table(RAW).where(F.col("landing") == number)
    if landed.isEmpty():
        log.record(warning(spark, "bronze", "new_payloads", RAW, "nothing new has landed"))
    else:
        log.record(group_count_record(group_counts(landed, "key", config.keys), "bronze", RAW, 1))

    merged_before = _merged(spark)
    days = refresh(spark, config)
    if days is None or days:
        log.record(run_gates({CLEAN: _of_days(spark.table(CLEAN), days)}, [Gate("silver", CLEAN, config.clean_gate())]))
        log.record(run_gates({DAILY: _of_days(spark.table(DAILY), days)}, [Gate("gold", DAILY, (not_empty(),))]))
    today = group_counts(spark.table(DAILY).where(F.col("date") == F.lit(as_of).cast("date")), "key", config.keys)
    log.record(group_count_record(today, "gold", DAILY, 1))

    ensure_table(spark, FORECAST, forecast_schema(config.metrics), partition_by=["target_date"])
    refit(spark, config, as_of, merged_before, days)
    made = materialise(state_forecast(spark.table(FITS), config.metrics, config.non_negative))  # one row per key
    if made.isEmpty():
        log.record(warning(spark, "forecast", "forecast_produced", FORECAST, "not enough settled history for any key"))
    else:
        replace_partitions(made, FORECAST)
        log.record(run_gates({FORECAST: made}, [Gate("forecast", FORECAST, config.forecast_gate())]))
    skipped = skipped_keys(settled_history(spark.table(DAILY), as_of, config.metrics), made)
    log.record(skipped.select(
        F.lit("forecast").alias("step"), F.lit("key_predicted").alias("check_name"), F.lit(FORECAST).alias("target"), "status", "detail"))
