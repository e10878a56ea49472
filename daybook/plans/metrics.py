"""Metrics defined once as expressions, evaluated per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schemas import METRIC_DEFINITIONS


@dataclass(frozen=True)
class Metric:
    """``expression`` and ``filter`` are SQL text from trusted configuration, never user input."""

    name: str
    label: str
    description: str
    table_name: str
    expression: str
    filter: str
    unit: str


def metric_definitions(spark: SparkSession, metrics: Sequence[Metric]) -> DataFrame:
    rows = [tuple(getattr(m, f.name) for f in fields(Metric)) for m in metrics]
    return spark.createDataFrame(rows, METRIC_DEFINITIONS)


def evaluate(
    df: DataFrame, metrics: Sequence[Metric], by: str | None = "key", keys: Sequence[str] | None = None
) -> DataFrame:
    """Rows (key, metric, value). Metrics that share a filter share one scan and one aggregate."""
    scoped = df if keys is None else df.where(F.col(by).isin(*keys))
    out = None
    for condition in dict.fromkeys(m.filter for m in metrics):
        shared = [m for m in metrics if m.filter == condition]
        group = [by] if by else []
        values = scoped.where(F.expr(condition)).groupBy(*group).agg(
            *[F.expr(m.expression).cast("double").alias(m.name) for m in shared]
        )
        rows = values.unpivot(group, [m.name for m in shared], "metric", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


def described(definitions: DataFrame, values: DataFrame) -> DataFrame:
    """Definitions with their current overall value: one row per definition on both sides."""
    current = values.withColumnRenamed("metric", "name")
    return definitions.join(current, "name", "left")
