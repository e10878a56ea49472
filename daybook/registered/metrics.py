"""Registered queries: metrics from their definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators.dedupe import first_wins
from daybook.operators.joins import lookup
from daybook.plans.metrics import Metric, described, evaluate, metric_definitions
from daybook.registered.base import EVENTS_DAILY, events_daily, table
from daybook.registered.forecasting import AS_OF, FORECASTS, evaluation
from daybook.registered.text import THREE_WAY, three_way

SETTLED = f"date <= DATE'{AS_OF}'"
KEYS = ["click", "purchase", "view"]

DAILY_METRICS = [
    Metric("high_days", "High days", "Days with a total above 3300.", "daily",
           "COUNT(*) FILTER (WHERE value_sum > 3300)", SETTLED, "days"),
    Metric("avg_value", "Average value", "Mean of daily averages.", "daily", "ROUND(AVG(value_avg), 1)", SETTLED, "units"),
    Metric("total_value", "Total value", "Sum of daily totals.", "daily",
           "ROUND(SUM(CAST(value_sum AS DECIMAL(18, 2))), 1)", SETTLED, "units"),
    Metric("peak_value", "Peak value", "Highest daily maximum.", "daily", "ROUND(MAX(value_max), 1)", SETTLED, "units"),
]
MAE = Metric("mae_value_avg", "Forecast error", "Mean absolute error of the predicted average.", "evaluation",
             "ROUND(AVG(ABS(predicted_value_avg - actual_value_avg)), 2)", "TRUE", "units")
SCORED = "call_correct IS NOT NULL AND model_correct IS NOT NULL"
HIT_RATES = [
    Metric("call_hit_rate", "Call hit rate", "Share of days with a right call, where both are scored.", "compared",
           "ROUND(AVG(CAST(call_correct AS INTEGER)), 2)", SCORED, "share of days"),
    Metric("model_hit_rate", "Model hit rate", "Share of days with a right model, on the same days.", "compared",
           "ROUND(AVG(CAST(model_correct AS INTEGER)), 2)", SCORED, "share of days"),
]


def _one(i: int):
    return lambda s, d: evaluate(events_daily(s, d), [DAILY_METRICS[i]], keys=KEYS)


def _labelled(spark, d):
    """Share of long documents that people marked as good, per source."""
    docs = first_wins(table(spark, d, "documents").select("doc_id", "source", "n_chars"), ["doc_id"], ["source", "n_chars"])
    scored = lookup(table(spark, d, "labels"), docs, ["doc_id"], "inner").select(
        F.col("source").alias("key"), (F.col("quality") == 1).alias("good"), "n_chars", "toxic")
    rate = Metric("good_rate", "Good share", "Share of good documents.", "labels",
                  "ROUND(AVG(CAST(good AS INTEGER)), 2)", "n_chars > 500 AND toxic = 0", "share")
    return evaluate(scored, [rate])


def _definitions(spark, d):
    return described(metric_definitions(spark, DAILY_METRICS), evaluate(events_daily(spark, d), DAILY_METRICS, by=None))


QUERIES = {
    "metric_rainy_days": _one(0),
    "metric_avg": _one(1),
    "metric_total": _one(2),
    "metric_peak": _one(3),
    "metric_tiles": lambda s, d: evaluate(events_daily(s, d), DAILY_METRICS, keys=KEYS),
    "metric_mae": lambda s, d: evaluate(evaluation(s, d), [MAE]),
    "metric_hit_rate": lambda s, d: evaluate(three_way(s, d), HIT_RATES),
    "metric_hit_rate_labels": _labelled,
    "metric_definitions": _definitions,
}


def _sql(m: Metric, keyed: bool = True) -> str:
    expression = m.expression.replace("DATE'", "DATE '")
    where = m.filter.replace("DATE'", "DATE '")
    if not keyed:
        return f"SELECT '{m.name}' AS metric, CAST({expression} AS DOUBLE) AS value FROM {m.table_name} WHERE ({where})"
    return (f"SELECT key, '{m.name}' AS metric, CAST({expression} AS DOUBLE) AS value FROM {m.table_name} "
            f"WHERE ({where}) AND key IN ('click', 'purchase', 'view') GROUP BY key")


def _definition_row(m: Metric) -> str:
    quoted = [getattr(m, f).replace("'", "''") for f in
              ("name", "label", "description", "table_name", "expression", "filter", "unit")]
    return "(" + ", ".join(f"'{q}'" for q in quoted) + ")"


_TILES = [_sql(m) for m in DAILY_METRICS]
ORACLES = {
    "metric_rainy_days": f"WITH {EVENTS_DAILY} {_TILES[0]}",
    "metric_avg": f"WITH {EVENTS_DAILY} {_TILES[1]}",
    "metric_total": f"WITH {EVENTS_DAILY} {_TILES[2]}",
    "metric_peak": f"WITH {EVENTS_DAILY} {_TILES[3]}",
    "metric_tiles": f"WITH {EVENTS_DAILY} " + " UNION ALL ".join(_TILES),
    "metric_mae": f"""
        WITH {FORECASTS} SELECT key, 'mae_value_avg' AS metric,
               ROUND(AVG(ABS(predicted_value_avg - actual_value_avg)), 2) AS value FROM evaluation GROUP BY key""",
    "metric_hit_rate": f"WITH {THREE_WAY} " + " UNION ALL ".join(
        f"SELECT key, '{m.name}' AS metric, {m.expression} AS value FROM compared WHERE {m.filter} GROUP BY key"
        for m in HIT_RATES),
    "metric_hit_rate_labels": """
        SELECT source AS key, 'good_rate' AS metric, ROUND(AVG(CAST(quality = 1 AS INTEGER)), 2) AS value
        FROM labels JOIN documents USING (doc_id) WHERE n_chars > 500 AND toxic = 0 GROUP BY source""",
    "metric_definitions": f"""
        WITH {EVENTS_DAILY},
        defs(name, label, description, table_name, expression, filter, unit) AS (
            VALUES {', '.join(_definition_row(m) for m in DAILY_METRICS)}),
        vals AS ({' UNION ALL '.join(_sql(m, keyed=False) for m in DAILY_METRICS)})
        SELECT defs.*, vals.value FROM defs LEFT JOIN vals ON vals.metric = defs.name""",
}
