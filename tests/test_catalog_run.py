"""The catalog step on stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import search
from daybook.plans import catalog_run
from daybook.plans.metrics import Metric
from daybook.schemas import LINEAGE_NODES
from daybook.sources.tables import publish, publish_view
from tests.conftest import rows

LAYER = "t_layer"


def test_catalog_step(spark, monkeypatch):
    monkeypatch.setattr(catalog_run, "METRIC_TABLE", f"{LAYER}.metrics")
    monkeypatch.setattr(catalog_run, "EDGE_TABLE", f"{LAYER}.edges")
    publish(spark.sql("SELECT 'a' AS key, DATE'2024-01-01' AS date, 2.0D AS rain"), f"{LAYER}.day")
    publish_view(spark, f"{LAYER}.wet", f"SELECT key FROM {LAYER}.day WHERE rain > 1", "it's wet")

    nodes = spark.createDataFrame([
        ("api", "source", "API", "outside", None, []), (f"{LAYER}.day", "table", None, None, "roll.py", ["api"]),
        (f"{LAYER}.wet", "view", None, None, None, [f"{LAYER}.day"]),
        (f"{LAYER}.metrics", "table", None, None, None, []), (f"{LAYER}.edges", "table", None, None, None, []),
    ], LINEAGE_NODES)
    metric = Metric("rainy_days", "Rainy days", "Days with rain", f"{LAYER}.day", "COUNT(*) FILTER (WHERE rain > 1)", "TRUE", "d")
    catalog_run.publish_catalog(spark, [metric], nodes)
    assert spark.table(f"{LAYER}.edges").count() == 2

    missing = catalog_run.coverage_record(spark, LAYER).where("status = 'fail'").select("target", "detail")
    assert (f"{LAYER}.day", "no description") in rows(missing) and (f"{LAYER}.day", "no description of rain") in rows(missing)
    described = {f"{LAYER}.day": ["key", "date", "rain"], f"{LAYER}.metrics": spark.table(f"{LAYER}.metrics").columns,
                 f"{LAYER}.edges": spark.table(f"{LAYER}.edges").columns}
    for table, columns in described.items():
        catalog_run.describe(spark, table, "it's a table", {c: f"the {c}" for c in columns})
    missing = catalog_run.coverage_record(spark, LAYER).where("status = 'fail'").select("target", "detail")
    assert rows(missing) == [(f"{LAYER}.wet", "no description of key")]  # the column of the view

    texts = spark.createDataFrame([("roll.py", "nothing")], "path string, text string")
    assert catalog_run.lineage_record(spark, nodes, texts, [LAYER]).first().status == "pass"
    fewer = nodes.where(F.col("node") != f"{LAYER}.wet")
    assert catalog_run.lineage_record(spark, fewer, texts, [LAYER]).first().detail == (
        f"{LAYER}.wet: exists but not declared")

    index = catalog_run.search_index(spark, nodes, [LAYER])
    found = search.ranked(search.search(index, "rainy", {"rain": ["rainy"]}))
    assert rows(found.select("id"))[0] == ("metric:rainy_days",)
    assert {r.id for r in found.collect()} == {"metric:rainy_days", f"{LAYER}.day"}


def test_evaluation_view(spark):
    publish(spark.sql("SELECT 'a' AS key, DATE'2024-01-01' AS date, 2.0D AS m"), "t_eval.day")
    publish(spark.sql("""
        SELECT 'a' AS key, DATE'2024-01-01' AS target_date, 1.5D AS predicted_m, 'x' AS model_type, true AS is_backtest
        UNION ALL SELECT 'a', DATE'2999-01-01', 1.0D, 'x', false"""), "t_eval.forecast")
    catalog_run.publish_evaluation_view(spark, "t_eval.forecast", "t_eval.day", ["m"], "t_eval.evaluation")
    assert rows(spark.table("t_eval.evaluation").select("predicted_m", "actual_m")) == [(1.5, 2.0)]
