"""Writing tables: full refresh, views, scoped replace, insert-if-absent, typed creation, CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybook.operators.joins import unmatched
from daybook.session import materialise


def scoped_replace(old: DataFrame, new: DataFrame, scope: Sequence[str]) -> DataFrame:
    """The old rows outside every scope value that the new rows touch, plus the new rows.

    The scope values shrink to one row each, and old rows of a hot value are split.
    """
    return unmatched(old, new, scope).select(*new.columns).unionByName(new)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The existing rows plus the incoming rows whose key is not there yet."""
    return existing.unionByName(absent(existing, incoming, keys))


def absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not there yet. They should be unique per key: both sides then meet in the
    partitioning that made them unique. Copies of a new key would all be kept."""
    return incoming.join(existing.select(*keys).distinct(), list(keys), "left_anti").select(*incoming.columns)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create the database and an empty typed parquet table unless they exist."""
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{layout}")


def append(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)


def _settle(spark: SparkSession, name: str) -> None:
    """Finish or undo the switch of :func:`publish` where a crash came between its steps. A table named ``__next``
    exists only once it is whole, as Spark enters a table after its files are written."""
    exists, old, new = spark.catalog.tableExists(name), f"{name}__old", f"{name}__next"
    if not exists and spark.catalog.tableExists(old):
        complete = new if spark.catalog.tableExists(new) else old
        spark.sql(f"ALTER TABLE {complete} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def publish(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh in which readers and a failed run keep the old version until the new one is whole. The query may read the table.

    A table without partitions is written beside the old one and takes its name. Of one with partitions, the partitions are
    swapped by the one commit at the end of the write, and those that the new version lacks are dropped after it.
    """
    spark = df.sparkSession
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    _settle(spark, name)
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").partitionBy(*partition_by).saveAsTable(name)
    elif partition_by and set(spark.table(name).columns) == set(df.columns):
        rows = materialise(df)
        replace_partitions(rows, name)
        gone = spark.table(name).select(*partition_by).distinct().subtract(rows.select(*partition_by).distinct())
        for row in gone.toLocalIterator():  # as many as there are partitions
            which = ", ".join(f"{c} = {_partition_value(row[c])}" for c in partition_by)
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({which})")
    else:
        df.write.mode("overwrite").format("parquet").partitionBy(*partition_by).saveAsTable(f"{name}__next")
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
        spark.sql(f"ALTER TABLE {name}__next RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}__old")


def _partition_value(value: object) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_view(spark: SparkSession, name: str, query: str, description: str = "") -> None:
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    words = description.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{words}' AS {query}")


def replace_partitions(df: DataFrame, name: str) -> None:
    """Scoped replace on a stored table: every partition the new rows touch is swapped, the rest stays.

    The table is partitioned by the scope column, so nothing outside the touched days is read or rewritten.
    """
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
