"""The searchable index of tables, views, metrics and outside nodes.

Its inputs are the catalog's own rows: one per object, column, metric or edge. They
are declared by hand and fit in one configuration file, so lists per object are bounded
by the width of a table and the size of that file, never by the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Node types that are neither tables nor views, and how they are shown.
OUTSIDE_KINDS = {"source": "Source", "service": "Service", "consumer": "Consumer", "file": "File"}
OUTSIDE_LAYER = "outside the warehouse"

_COLUMNS = "array<struct<name:string,type:string,description:string>>"


def column_rows(tables: Mapping[str, DataFrame], descriptions: Mapping[str, str]) -> DataFrame:
    """(object, position, name, type, description) from the schemas, read without touching data."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (table, i, f.name, f.dataType.simpleString(), descriptions.get(f"{table}.{f.name}", ""))
        for table, df in tables.items() for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "object string, position int, name string, type string, description string")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; a parquet count reads file footers only."""
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("id"), "n_rows") for t, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def asset_index(objects: DataFrame, columns: DataFrame, metrics: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row per asset: id, name, kind, layer, description, details, columns, built_by, neighbours, metrics.

    ``objects`` (id, kind, layer, description), ``columns`` as in :func:`column_rows`,
    ``metrics`` as published, ``nodes`` (node, type, label, description, built_by),
    ``edges`` (upstream, downstream).
    """
    ordered = F.array_sort(F.collect_list(F.struct("position", "name", "type", "description")))
    column_lists = columns.groupBy(F.col("object").alias("id")).agg(ordered.alias("_c")).select(
        "id", F.transform("_c", lambda c: F.struct(c["name"].alias("name"), c["type"].alias("type"),
                                                   c["description"].alias("description"))).alias("columns"))
    up = edges.groupBy(F.col("downstream").alias("id")).agg(F.array_sort(F.collect_set("upstream")).alias("upstream"))
    down = edges.groupBy(F.col("upstream").alias("id")).agg(F.array_sort(F.collect_set("downstream")).alias("downstream"))
    metric_ids = metrics.groupBy(F.col("table_name").alias("id")).agg(
        F.array_sort(F.collect_set(F.concat(F.lit("metric:"), "name"))).alias("metrics"))
    builders = nodes.select(F.col("node").alias("id"), "built_by")

    def empty(c: str) -> Column:
        return F.coalesce(c, F.array().cast("array<string>")).alias(c)

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(
            "id", "name", "kind", "layer", F.coalesce("description", F.lit("")).alias("description"), "details",
            F.coalesce("columns", F.array().cast(_COLUMNS)).alias("columns"), "built_by",
            empty("upstream"), empty("downstream"), empty("metrics"))

    tables = (objects.withColumns({"name": F.col("id"), "details": F.lit("")}).join(column_lists, "id", "left").join(builders, "id", "left")
              .join(up, "id", "left").join(down, "id", "left").join(metric_ids, "id", "left"))
    none = F.lit(None)
    metric_assets = metrics.select(
        F.concat(F.lit("metric:"), "name").alias("id"), F.col("label").alias("name"), F.lit("Metric").alias("kind"),
        F.lit("semantic layer").alias("layer"),
        "description", F.concat_ws(" ", "name", "table_name", "expression", "filter", "unit").alias("details"),
        none.cast(_COLUMNS).alias("columns"), none.cast("string").alias("built_by"),
        F.array("table_name").alias("upstream"), none.cast("array<string>").alias("downstream"),
        none.cast("array<string>").alias("metrics"))
    shown = F.create_map(*[F.lit(x) for kv in OUTSIDE_KINDS.items() for x in kv])
    outside = (
        nodes.where(F.col("type").isin(*OUTSIDE_KINDS))
        .join(objects.select(F.col("id").alias("node")), "node", "left_anti")
        .select(F.col("node").alias("id"), F.coalesce("label", "node").alias("name"), shown[F.col("type")].alias("kind"),
                F.lit(OUTSIDE_LAYER).alias("layer"), "description", F.lit("").alias("details"),
                none.cast(_COLUMNS).alias("columns"), "built_by", none.cast("array<string>").alias("metrics"))
        .join(up, "id", "left").join(down, "id", "left"))
    return shaped(tables).unionByName(shaped(metric_assets)).unionByName(shaped(outside))


