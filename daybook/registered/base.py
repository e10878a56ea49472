"""Inputs shared by the registered queries, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.rollup import Measure, daily_rollup

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- events, per event type and day ---------------------------------------------------

EVENT_MEASURES = (
    Measure("value_min", "min", "value", 2),
    Measure("value_max", "max", "value", 2),
    Measure("value_avg", "avg", "value", 2, scale=2),
    Measure("value_sum", "sum", "value", 2, scale=2),
    Measure("k_avg", "avg", "k", 2, scale=0),
)
EVENT_METRICS = [m.name for m in EVENT_MEASURES]
EVENT_NON_NEGATIVE = ["value_max", "value_sum"]


def events_with_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", k)


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_rollup(events_with_k(spark, sf_dir), "event_type", "ts", EVENT_MEASURES)


EVENTS_DAILY = """
daily AS (
    SELECT event_type AS key, CAST(ts AS DATE) AS date,
           ROUND(MIN(value), 2) AS value_min,
           ROUND(MAX(value), 2) AS value_max,
           ROUND(CAST(SUM(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(value), 2) AS value_avg,
           ROUND(CAST(SUM(CAST(value AS DECIMAL(18, 2))) AS DOUBLE), 2) AS value_sum,
           ROUND(CAST(SUM(k) AS DOUBLE) / COUNT(k), 2) AS k_avg
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
    GROUP BY event_type, CAST(ts AS DATE)
)"""

# ---- lineitem, per return flag and ship day: a longer series ---------------------------

LINE_MEASURES = (
    Measure("quantity_min", "min", "l_quantity", 1),
    Measure("quantity_max", "max", "l_quantity", 1),
    Measure("quantity_avg", "avg", "l_quantity", 2, scale=2),
    Measure("quantity_sum", "sum", "l_quantity", 1, scale=2),
    Measure("discount_max", "max", "l_discount", 2),
)
LINE_METRICS = [m.name for m in LINE_MEASURES]
LINE_NON_NEGATIVE = ["quantity_sum", "discount_max"]


def lines_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_rollup(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_shipdate", LINE_MEASURES)


LINES_DAILY = """
daily AS (
    SELECT l_returnflag AS key, CAST(l_shipdate AS DATE) AS date,
           ROUND(MIN(l_quantity), 1) AS quantity_min,
           ROUND(MAX(l_quantity), 1) AS quantity_max,
           ROUND(CAST(SUM(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(l_quantity), 2) AS quantity_avg,
           ROUND(CAST(SUM(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE), 1) AS quantity_sum,
           ROUND(MAX(l_discount), 2) AS discount_max
    FROM lineitem
    GROUP BY l_returnflag, CAST(l_shipdate AS DATE)
)"""

# ---- orders, per priority and order day -------------------------------------------------

ORDER_MEASURES = (
    Measure("price_min", "min", "o_totalprice"),
    Measure("price_max", "max", "o_totalprice"),
    Measure("price_sum", "sum", "o_totalprice", scale=2),
)
