"""All steps of a run over stored tables, and the library functions for boosted trees."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daybook.operators.features import one_hot
from daybook.operators.quality import DataQualityError
from daybook.operators.rollup import Measure, daily_rollup
from daybook.plans import compare, daily_run, text_run, whole_run
from daybook.plans.metrics import Metric
from daybook.plans.reports import table_preview
from daybook.schemas import LINEAGE_NODES, RAW_DOCUMENTS
from daybook.sources.tables import publish
from tests.conftest import rows
from tests.test_daily_run import _write, empty_tables  # noqa: F401

CONFIG = daily_run.DailyConfig(
    keys=["oslo"], payload_measures=["t", "p"], non_negative=["p_sum"],
    measures=[Measure("t_max", "max", "t"), Measure("t_min", "min", "t"), Measure("p_sum", "sum", "p", scale=2)],
)


def _documents(spark, now):
    issued = [now - timedelta(days=d) for d in (3, 2, 1)]
    body = ".TOMORROW...rain is likely over all of the city and its surroundings\n$$\n"
    return spark.createDataFrame(
        [(f"d{i}", "x", t, t, "u", json.dumps({"productText": body})) for i, t in enumerate(issued)], RAW_DOCUMENTS)


def test_whole_run(spark, tmp_path):
    now = datetime(2024, 3, 20, 6)
    path = _write(tmp_path / "feed", "oslo-1", now, 20)
    publish(_documents(spark, now), "bronze.documents")

    def extract(text, day, issued):
        if day.isoformat() == "2024-03-19":
            raise RuntimeError("quota")
        return {"rain_expected": "likely", "high_temp_f": 50.0, "max_wind_gust_mph": 10.0, "hazards": ["flood"], "summary": "wet",
                "evidence": "rain is likely"}

    text = whole_run.TextConfig(
        "bronze.documents", extract, lambda texts: [[1.0] for _ in texts], ("rules", "ones"), comparison=dict(
            key="oslo", event_metric="p_sum", high_metric="t_max", low_metric="t_min", wind_metric="t_max", threshold=0.1))
    nodes = lambda s: s.createDataFrame([("bronze.raw_payloads", "table", None, None, None, [])], LINEAGE_NODES)
    catalog = whole_run.CatalogConfig(
        [Metric("wet", "Wet days", "", "gold.daily_summary", "COUNT(*)", "TRUE", "d")], nodes,
        lambda s: s.createDataFrame([], "path string, text string"), documented_layers=())
    with pytest.raises(DataQualityError, match="exists but not declared"):  # the catalog comes last and everything before it is stored
        whole_run.run(spark, path, CONFIG, now, text, catalog)

    compared = spark.table("gold.call_comparison")
    assert len(compared.columns) == 20
    shown = compared.select(F.col("target_date").cast("string"), "call", "call_high", "call_gust", "hazards", "summary", "verified", "call_correct")
    assert rows(shown, "target_date") == [
        ("2024-03-20", "likely", 10.0, 16.1, ["flood"], "wet", True, True),
        ("2024-03-21", "likely", 10.0, 16.1, ["flood"], "wet", True, None)]  # not settled
    log = spark.table("ops.dq_results")
    assert log.where("check_name = 'enriched' AND status = 'warn' AND detail LIKE '%d0, RuntimeError: quota'").count() == 1
    problems = log.where("check_name = 'lineage' AND status = 'fail' AND detail LIKE '%exists but not declared'")
    names = {t.name for db in ("bronze", "silver", "gold", "ops") for t in spark.catalog.listTables(db)}
    assert problems.count() == len(names) - 1  # one record per object that is not declared
    assert spark.table("ops.pipeline_runs").first().status == "failed"
    assert spark.table("gold.forecast_evaluation").columns[-2:] == ["predicted_p_sum", "actual_p_sum"]
    assert spark.table(text_run.SECTION_TABLE).count() == 2


def test_boosted_sweep(spark):
    days = [datetime(2024, 1, 1).date() + timedelta(days=i) for i in range(24)]
    daily = spark.createDataFrame([(k, d, float(n + i % 5), float(i)) for n, k in enumerate("ab") for i, d in enumerate(days)],
                                  "key string, date date, m double, k double")
    pooled = compare.pooled_history(daily, ["m", "k"], ["a", "b"])
    evaluation = daily.where("date > '2024-01-14'").select(
        "key", F.col("date").alias("target_date"), F.lit(True).alias("is_backtest"), F.lit(compare.MODEL_TYPE).alias("model_type"),
        (F.col("m") + 1).alias("predicted_m"), F.col("m").alias("actual_m"), (F.col("k") + 2).alias("predicted_k"), F.col("k").alias("actual_k"))
    runs, errors = compare.sweep_errors(evaluation, pooled, ["m", "k"], ["a", "b"], ["2024-01-15", "2024-01-20"], "2024-01-25",
                                        max_depths=(2,), max_iter=3)
    log = {r.run: (r.params, r.metrics) for r in compare.sweep_records(runs, errors, ["m", "k"]).collect()}
    assert set(log) == {"linear_per_key", "boosted_pooled_basic_depth2", "boosted_pooled_rich_depth2"}
    assert log["linear_per_key"][1] == {"mae_m": 1.0, "mae_k": 2.0, "n_points": 20.0}
    assert log["boosted_pooled_rich_depth2"][0]["max_depth"] == "2"
    assert log["boosted_pooled_rich_depth2"][1]["n_points"] == 20.0 and log["boosted_pooled_rich_depth2"][1]["mae_m"] < 3


def test_boosted_trees_on_a_short_series(spark):
    days = [datetime(2024, 1, 1).date() + timedelta(days=i) for i in range(7)]
    daily = spark.createDataFrame([(k, d, float(i)) for k in "abc" for i, d in enumerate(days)], "key string, date date, m double")
    pooled = compare.pooled_history(daily, ["m"], ["a", "b", "c"])
    made = compare.boosted_backtest(pooled, ["m"], ["a", "b", "c"], ["2024-01-07"], "2024-01-08", "rich", 2, max_iter=2)
    assert made.count() == 3


def test_extra_digits_stop_a_rollup(spark):
    rows_ = spark.createDataFrame([("a", datetime(2024, 1, 1), 0.004)] * 1000, "key string, ts timestamp_ntz, v double")
    with pytest.raises(Exception, match="v has more than 2 decimals"):
        daily_rollup(rows_, "key", "ts", [Measure("s", "sum", "v", scale=2)]).collect()
    exact = daily_rollup(rows_, "key", "ts", [Measure("s", "sum", "v", scale=3)]).first()
    assert exact.s == 4.0


def test_unlisted_keys_stop(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(one_hot(df, "k", ["a"], "is").select("is_a")) == [(0,), (1,)] or rows(one_hot(df, "k", ["a"], "is").select("is_a")) == [(1,), (0,)]
    with pytest.raises(Exception, match="unlisted value: b"):
        one_hot(spark.createDataFrame([("b",)], "k string"), "k", ["a"], "is").collect()


def test_preview_shows_arrays_of_strings(spark):
    df = spark.createDataFrame([(1, ["x"], [1.0])], "id int, names array<string>, v array<double>")
    assert table_preview(df, [], ["id"], lambda c: c).columns == ["id", "names"]
