"""The stored daily run, end to end."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from daybook.operators.quality import DataQualityError
from daybook.operators.rollup import Measure
from daybook.plans import daily_run
from tests.conftest import rows

CONFIG = daily_run.DailyConfig(
    keys=["oslo", "rome"], payload_measures=["t", "p"], non_negative=["p_sum"], clean_ranges=[("t", -90, 60)],
    forecast_ranges=[("predicted_t_avg", -90, 60)],
    measures=[Measure("t_avg", "avg", "t"), Measure("p_sum", "sum", "p", scale=2)],
)
START = datetime(2024, 3, 1)


@pytest.fixture(autouse=True)
def empty_tables(spark):
    """Every test starts without stored tables."""
    for database in ("bronze", "silver", "gold", "ops"):
        if spark.catalog.databaseExists(database):
            for t in spark.catalog.listTables(database):
                spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} IF EXISTS {database}.{t.name}")


def _write(folder, name: str, fetched: datetime, days: int, shift: float = 0.0, start: datetime = START, bad: float | None = None):
    """One payload file as a fetch at ``fetched`` would have left it."""
    folder.mkdir(exist_ok=True)
    hours = [start + timedelta(hours=6 * i) for i in range(4 * days)]
    n = sum(map(ord, name[:4])) % 5
    payload = {"time": [h.strftime("%Y-%m-%dT%H:%M") for h in hours],
               "t": [round(10 + n + shift + (i * 7 % 11) * 0.3, 1) for i in range(len(hours))],
               "p": [round((i * 5 % 7) * 0.1, 1) for i in range(len(hours))]}
    if bad is not None:
        payload["t"][0] = bad
    file = folder / f"{name}.json"
    file.write_text(json.dumps({"hourly": payload}))
    stamp = fetched.replace(tzinfo=timezone.utc).timestamp()
    os.utime(file, (stamp, stamp))
    return str(folder)


def _daily(spark):
    return rows(spark.table(daily_run.DAILY).select("key", F.col("date").cast("string"), "t_avg", "p_sum"), "key", "date")


def _assert_as_rebuilt(spark):
    merged = _daily(spark)
    daily_run.rebuild(spark, CONFIG)
    assert _daily(spark) == merged


def test_daily_run(spark, tmp_path):
    folder = tmp_path / "feed"
    now = datetime(2024, 3, 20, 6)
    for key in ("oslo", "rome"):
        path = _write(folder, f"{key}-1", now, 20)
    daily_run.run(spark, path, CONFIG, now)
    assert spark.table(daily_run.RAW).count() == 2
    assert spark.table(daily_run.CLEAN).count() == 160
    assert spark.table(daily_run.DAILY).count() == 40
    made = spark.table(daily_run.FORECAST)
    assert rows(made.select("key", F.col("target_date").cast("string"), "is_backtest"), "key") == [
        ("oslo", "2024-03-21", False), ("rome", "2024-03-21", False)]

    daily_run.backtest(spark, CONFIG, "2024-03-20")
    daily_run.backtest(spark, CONFIG, "2024-03-20")
    assert spark.table(daily_run.FORECAST).where("is_backtest").count() == 18
    before = spark.table(daily_run.DAILY).where("key = 'oslo'").agg(F.min("t_avg")).first()[0]

    # newer files in the same folder, with names that sort before the old ones
    later = datetime(2024, 3, 21, 6)
    for key in ("oslo", "rome"):
        _write(folder, f"{key}-0", later, 21, 5.0)
    daily_run.run(spark, path, CONFIG, later)
    assert spark.table(daily_run.RAW).count() == 4 and spark.table(daily_run.CLEAN).count() == 168
    after = spark.table(daily_run.DAILY).where("key = 'oslo'").agg(F.min("t_avg")).first()[0]
    assert after == pytest.approx(before + 5.0)  # the newer fetch replaced every hour
    _assert_as_rebuilt(spark)
    live = spark.table(daily_run.FORECAST).where("NOT is_backtest").groupBy("target_date").count()
    assert rows(live.select(F.col("target_date").cast("string"), "count"), "target_date") == [("2024-03-21", 2), ("2024-03-22", 2)]

    # nothing new: nothing lands, nothing fails
    daily_run.run(spark, path, CONFIG, later + timedelta(minutes=30))
    assert spark.table(daily_run.RAW).count() == 4

    _write(folder, "oslo-2", later + timedelta(hours=1), 21, 5.0)
    with pytest.raises(DataQualityError, match="rome"):
        daily_run.run(spark, path, CONFIG, later + timedelta(hours=1))
    log = spark.table("ops.pipeline_runs").select("run_id", "status", "n_fail")
    assert rows(log, "run_id") == [("20240320T060000", "success", 0), ("20240321T060000", "success", 0),
                                   ("20240321T063000", "warning", 0), ("20240321T070000", "failed", 1)]


def test_what_a_failed_gate_left_is_merged_by_the_next_run(spark, tmp_path):
    folder, now = tmp_path / "feed", datetime(2024, 3, 20, 6)
    for key in ("oslo", "rome"):
        path = _write(folder, f"{key}-1", now, 20)
    daily_run.run(spark, path, CONFIG, now)
    _write(folder, "oslo-2", now + timedelta(hours=1), 20, 3.0)
    with pytest.raises(DataQualityError, match="rome"):
        daily_run.run(spark, path, CONFIG, now + timedelta(hours=1))
    for key in ("oslo", "rome"):
        _write(folder, f"{key}-3", now + timedelta(days=1), 1, start=datetime(2024, 3, 21))
    daily_run.run(spark, path, CONFIG, now + timedelta(days=1))
    assert spark.table(daily_run.CLEAN).count() == 168
    oslo = spark.table(daily_run.CLEAN).where("key = 'oslo' AND date = '2024-03-01'").agg(F.min("t")).first()[0]
    rome = spark.table(daily_run.CLEAN).where("key = 'rome' AND date = '2024-03-01'").agg(F.min("t")).first()[0]
    assert oslo >= 13.0 > rome
    _assert_as_rebuilt(spark)


def test_a_crash_between_the_tables_is_made_good(spark, tmp_path, monkeypatch):
    folder, now = tmp_path / "feed", datetime(2024, 3, 20, 6)
    for key in ("oslo", "rome"):
        path = _write(folder, f"{key}-1", now, 20)
    daily_run.run(spark, path, CONFIG, now)
    for key in ("oslo", "rome"):
        _write(folder, f"{key}-2", now + timedelta(hours=1), 20, 3.0)

    def broken(df, name, replace=daily_run.replace_partitions):
        if name == daily_run.DAILY:
            raise RuntimeError("lost")
        replace(df, name)

    monkeypatch.setattr(daily_run, "replace_partitions", broken)
    with pytest.raises(RuntimeError, match="lost"):
        daily_run.run(spark, path, CONFIG, now + timedelta(hours=1))
    monkeypatch.undo()
    daily_run.run(spark, path, CONFIG, now + timedelta(hours=2))
    _assert_as_rebuilt(spark)


def test_a_key_skipped_today_is_reported(spark, tmp_path):
    folder, now = tmp_path / "feed", datetime(2024, 3, 20, 6)
    for key in ("oslo", "rome"):
        path = _write(folder, f"{key}-1", now, 20)
    daily_run.run(spark, path, CONFIG, now)
    # rome has an older forecast, but its newest day lacks a value, so that nothing can be predicted from it today
    _write(folder, "oslo-2", now + timedelta(hours=1), 20)
    file = folder / "rome-2.json"
    hours = [f"2024-03-20T{6 * i:02d}:00" for i in range(4)]
    file.write_text(json.dumps({"hourly": {"time": hours, "t": [None] * 4, "p": [0.0] * 4}}))
    stamp = (now + timedelta(hours=1)).replace(tzinfo=timezone.utc).timestamp()
    os.utime(file, (stamp, stamp))
    daily_run.run(spark, path, CONFIG, now + timedelta(hours=1))
    warned = spark.table("ops.dq_results").where("check_name = 'key_predicted'").select("status", "detail")
    assert [r.status for r in warned.collect()] == ["warn"] and "rome" in warned.first().detail


def test_ranges_are_gates(spark, tmp_path):
    folder, now = tmp_path / "feed", datetime(2024, 3, 20, 6)
    _write(folder, "oslo-1", now, 20)
    path = _write(folder, "rome-1", now, 20, bad=75.0)
    with pytest.raises(DataQualityError, match=r"t outside \[-90, 60\]"):
        daily_run.run(spark, path, CONFIG, now)


def test_a_backfill_is_bounded(spark, tmp_path):
    folder = tmp_path / "feed"
    for n, fetched in enumerate((datetime(2024, 2, 1), datetime(2024, 3, 1), datetime(2024, 4, 1))):
        path = _write(folder, f"oslo-{n}", fetched, 2, float(n))
    daily_run.land(spark, path, CONFIG, datetime(2024, 4, 2), since="2024-02-15T00:00:00", until="2024-03-15T00:00:00")
    assert [r.fetched_at for r in spark.table(daily_run.RAW).collect()] == [datetime(2024, 3, 1)]
    daily_run.land(spark, path, CONFIG, datetime(2024, 4, 2))
    assert spark.table(daily_run.RAW).count() == 3
