"""The catalog step on stored tables: descriptions, published definitions, coverage and lineage checks.

Everything here is metadata of the session catalog: one row per table or column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.lineage import declared_edges, lineage_edges, lineage_problems, lineage_records
from daybook.operators.quality import documented_records
from daybook.operators.reads import view_reads
from daybook.plans.catalog import asset_index
from daybook.plans.gates import RunLog
from daybook.plans.metrics import Metric, metric_definitions
from daybook.sources.tables import publish, publish_view

METRIC_TABLE, EDGE_TABLE = "gold.metric_definitions", "gold.lineage_edges"
LAYERS = ("bronze", "silver", "gold", "ops")


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def describe(spark: SparkSession, table: str, description: str, columns: Mapping[str, str]) -> None:
    """Write the descriptions of a stored table into the catalog. Views take theirs when created."""
    spark.sql(f"COMMENT ON TABLE {table} IS {_text(description)}")
    for column, words in columns.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{column}` COMMENT {_text(words)}")


def publish_evaluation_view(spark: SparkSession, forecasts: str, daily: str, metrics: Sequence[str],
                            name: str = "gold.forecast_evaluation") -> None:
    """What :func:`daybook.plans.forecast.forecast_evaluation` gives, as a view: always current, nothing stored."""
    happened = ", ".join(f"`{m}` AS `actual_{m}`" for m in metrics)
    shown = ", ".join(f"`{side}_{m}`" for m in metrics for side in ("predicted", "actual"))
    publish_view(spark, name, f"""
        SELECT key, target_date, is_backtest, model_type, {shown}
        FROM (SELECT key, date AS target_date, {happened} FROM {daily})
        INNER JOIN {forecasts} USING (key, target_date)
        WHERE datediff(current_date(), target_date) > 0""")


def publish_catalog(spark: SparkSession, metrics: Sequence[Metric], nodes: DataFrame) -> None:
    publish(metric_definitions(spark, metrics), METRIC_TABLE)
    publish(lineage_edges(declared_edges(nodes), nodes), EDGE_TABLE)


def warehouse_objects(spark: SparkSession, layers: Sequence[str] = LAYERS) -> DataFrame:
    """(id, kind, layer, description, view_sql) of every table and view in the layers."""
    rows = []
    for layer in layers:
        if not spark.catalog.databaseExists(layer):
            continue
        for t in spark.catalog.listTables(layer):
            if t.isTemporary:
                continue
            name, sql = f"{layer}.{t.name}", None
            if t.tableType == "VIEW":
                shown = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").first()
                sql = shown.data_type if shown else None
            rows.append((name, "View" if t.tableType == "VIEW" else "Table", layer, t.description or "", sql))
    return spark.createDataFrame(rows, "id string, kind string, layer string, description string, view_sql string")


def warehouse_columns(spark: SparkSession, objects: DataFrame) -> DataFrame:
    """(object, position, name, type, description) of the listed objects."""
    rows = [
        (o.id, i, c.name, c.dataType, c.description or "")
        for o in objects.select("id").collect() for i, c in enumerate(spark.catalog.listColumns(o.id))
    ]
    return spark.createDataFrame(rows, "object string, position int, name string, type string, description string")


def search_index(spark: SparkSession, nodes: DataFrame, layers: Sequence[str] = LAYERS) -> DataFrame:
    """The searchable index, read back from what is published, so it cannot disagree with it."""
    objects = warehouse_objects(spark, layers)
    return asset_index(objects.drop("view_sql"), warehouse_columns(spark, objects), spark.table(METRIC_TABLE), nodes,
                       spark.table(EDGE_TABLE))


def coverage_record(spark: SparkSession, layer: str) -> DataFrame:
    """Every table, view and column of the layer must have a description; what lacks one is a record of its own."""
    objects = warehouse_objects(spark, [layer])
    whole = objects.select(F.col("id").alias("object"), F.lit("").alias("column"), "description")
    columns = warehouse_columns(spark, objects).select("object", F.col("name").alias("column"), "description")
    return documented_records(whole.unionByName(columns), "catalog")


def lineage_record(spark: SparkSession, nodes: DataFrame, texts: DataFrame, layers: Sequence[str] = LAYERS) -> DataFrame:
    """The lineage check: a failed record per problem, or one that passed."""
    objects = warehouse_objects(spark, layers).select(F.col("id").alias("name"), "view_sql")
    views = {o.name: o.view_sql for o in objects.where("view_sql IS NOT NULL").collect()}
    return lineage_records(lineage_problems(nodes, objects, texts, view_reads(spark, views)), "catalog")


def run(spark: SparkSession, log: RunLog, metrics: Sequence[Metric], nodes: DataFrame, texts: DataFrame,
        documented_layers: Sequence[str] = ("gold",)) -> None:
    """The catalog step of a run: publish, then check coverage and lineage."""
    publish_catalog(spark, metrics, nodes)
    for layer in documented_layers:
        log.record(coverage_record(spark, layer))
    log.record(lineage_record(spark, nodes, texts))
