"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# UTC keeps naive timestamps naive; the adaptive settings split hot join keys and
# merge small shuffle partitions at run time, from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str | int = "*", app: str = "daybook", **extra: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="daybook-warehouse-"),
        **extra,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names in spark.checkpoint.dir; make one up only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="daybook-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def materialise(df: DataFrame) -> DataFrame:
    """Write a small derived table once so that several later plans read it instead of the raw scan.

    A reliable checkpoint survives the loss of executors, which a cached or locally
    checkpointed table would not without recomputing.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
