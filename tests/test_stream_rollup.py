"""The stateful stream against the batch: any order, restarts, repeated batches and late rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from daybook.operators.dedupe import latest_wins
from daybook.operators.rollup import Measure, daily_rollup
from daybook.streaming.rollup import counted_rows, daily_totals, keep_changes, reconcile, version_changes
from tests.conftest import rows

MEASURES = (Measure("lo", "min", "value", 2), Measure("hi", "max", "value", 2), Measure("sum", "sum", "value", 2, scale=2))
KEYS, HOUR, VERSION, TIE = ["event_type"], "hour", "ts", "event_id"


def _versions(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_type", F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("hour"), F.col("ts").cast("timestamp_ntz").alias("ts"),
                         "event_id", "value")


def _batch(df):
    return rows(daily_rollup(latest_wins(df, [*KEYS, HOUR], VERSION, [TIE]), "event_type", "hour", MEASURES), "key", "date")


def _write(df, folder, number):
    df.coalesce(1).write.mode("append").parquet(f"{folder}/part={number}")


def _work_off(spark, schema, folder, table, checkpoint, delay):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/*")
    query = keep_changes(version_changes(stream, KEYS, HOUR, VERSION, TIE, delay), table, checkpoint)
    query.awaitTermination()
    return query


def test_stream_equals_batch_before_and_after_a_restart(spark, sf_dir, tmp_path):
    df = _versions(spark, sf_dir).cache()
    folder, table, checkpoint = str(tmp_path / "in"), "t_stream.changes", str(tmp_path / "check")
    for part in range(3):  # in no order of time
        _write(df.where(F.col("event_id") % 5 == part), folder, part)
    _work_off(spark, df.schema, folder, table, checkpoint, "60 days")
    totals = lambda: rows(daily_totals(spark.table(table), "event_type", "hour", MEASURES), "key", "date")
    assert totals() == _batch(df.where("event_id % 5 < 3"))
    for part in range(3, 5):
        _write(df.where(F.col("event_id") % 5 == part), folder, part)
    _work_off(spark, df.schema, folder, table, checkpoint, "60 days")
    assert totals() == _batch(df) and spark.table(table).where("sign < 0").count() > 0
    assert rows(counted_rows(spark.table(table)), "event_type", "hour") == rows(
        latest_wins(df, [*KEYS, HOUR], VERSION, [TIE]).select(*df.columns), "event_type", "hour")
    spark.sql(f"DROP TABLE {table}")


def test_late_rows_are_dropped_and_reconciled(spark, tmp_path):
    schema = "event_type string, hour timestamp_ntz, ts timestamp_ntz, event_id long, value double"
    day = lambda d, h=0: datetime(2024, 1, d, h)
    folder, table, checkpoint = str(tmp_path / "in"), "t_stream.late", str(tmp_path / "check")

    def land(number, *data):
        df = spark.createDataFrame(list(data), schema)
        _write(df, folder, number)
        _work_off(spark, df.schema, folder, table, checkpoint, "1 day")
        return df

    one = land(0, ("a", day(1), day(1, 1), 1, 1.0), ("a", day(10), day(10, 1), 2, 2.0))
    two = land(1, ("b", day(10), day(10, 2), 3, 3.0), ("a", day(10), day(10, 5), 7, 8.0))
    late = land(2, ("b", day(2), day(2, 5), 4, 4.0), ("b", day(2), day(2, 4), 5, 9.0), ("a", day(1), day(1, 7), 6, 7.0))
    totals = lambda: rows(daily_totals(spark.table(table), "event_type", "hour", MEASURES), "key", "date")
    on_time, whole = one.unionByName(two), one.unionByName(two).unionByName(late)
    assert totals() == _batch(on_time)
    for _ in range(2):  # the second time nothing is newer
        reconcile(spark, table, whole, KEYS, HOUR, VERSION, TIE)
        assert totals() == _batch(whole)
    assert spark.table(table).select("batch").distinct().where("batch < 0").count() == 1
    spark.sql(f"DROP TABLE {table}")
