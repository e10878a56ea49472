"""Landing, payloads and writes into tables."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from daybook.schemas import RAW_DOCUMENTS
from daybook.sources import tables
from daybook.sources.json_payload import unpack_payloads
from daybook.sources.landing import land_new_by_id, land_raw, read_payload_files
from daybook.streaming.landing import land_stream
from tests.conftest import rows


def _payload(**changes):
    hourly = {"time": ["2026-09-18T00:00", "2026-09-18T01:00"], "t": [1.5, 2.5], "p": [0.0, 0.25]} | changes
    return json.dumps({"hourly": {k: v for k, v in hourly.items() if v is not ...}})


def _unpack(spark, raw):
    df = spark.createDataFrame([("a", raw)], "key string, raw string")
    return unpack_payloads(df, "raw", ["t", "p"], ["key"])


def test_payload_to_rows(spark):
    assert rows(_unpack(spark, _payload()), "ts") == [
        ("a", datetime(2026, 9, 18, 0), 1.5, 0.0), ("a", datetime(2026, 9, 18, 1), 2.5, 0.25)]


def test_null_element_stays_null(spark):
    assert rows(_unpack(spark, _payload(t=[None, 2.0])), "ts")[0][2] is None


def test_longer_array_is_cut(spark):
    assert _unpack(spark, _payload(p=[1.0, 2.0, 3.0])).count() == 2


@pytest.mark.parametrize("raw", [
    _payload(t=...), _payload(t=[1.0]), _payload(time=...), '{"hourly": {"time": [', _payload(t=["x", "y"]),
])
def test_broken_payload_stops(spark, raw):
    with pytest.raises(Exception, match="payload misses|MALFORMED|cannotParse"):
        _unpack(spark, raw).collect()


def test_land_files(spark, tmp_path):
    for name in ("oslo", "rome"):
        (tmp_path / f"{name}.json").write_text(_payload())
    files = read_payload_files(spark, str(tmp_path), F.regexp_extract("source_url", r"([^/]+)\.json$", 1))
    landed = land_raw(files, "key", "source_url", "raw_json", F.lit(datetime(2026, 1, 1)))
    assert rows(landed.select("key", "fetched_at", "raw_json"), "key") == [
        ("oslo", datetime(2026, 1, 1), _payload()), ("rome", datetime(2026, 1, 1), _payload())]
    later = read_payload_files(spark, str(tmp_path), F.lit("x"), since="2100-01-01T00:00:00")
    assert later.count() == 0


def test_land_once(spark):
    landed = spark.createDataFrame([("a",)], "id string")
    incoming = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1), ("c", 3)], "id string, v int")
    assert rows(land_new_by_id(landed, incoming, "id", ["v"]), "id") == [("b", 1), ("c", 3)]


def test_scoped_replace_drops_the_day_for_all_keys(spark):
    old = spark.createDataFrame([("a", 1, "o"), ("b", 1, "o"), ("a", 2, "o"), ("b", 3, "o")], "key string, d int, s string")
    new = spark.createDataFrame([("a", 1, "n"), ("a", 3, "n")], "key string, d int, s string")
    expected = [("a", 1, "n"), ("a", 2, "o"), ("a", 3, "n")]
    once = tables.scoped_replace(old, new, ["d"])
    assert rows(once, "key", "d") == expected
    assert rows(tables.scoped_replace(once, new, ["d"]), "key", "d") == expected


def test_insert_if_absent_sees_every_stored_row(spark):
    stored = spark.createDataFrame([("a", 1, False), ("a", 2, True)], "key string, d int, is_backtest boolean")
    points = spark.createDataFrame([("a", 1, True), ("a", 2, True), ("a", 3, True)], "key string, d int, is_backtest boolean")
    done = tables.insert_if_absent(stored, points, ["key", "d"])
    assert rows(done, "d") == [("a", 1, False), ("a", 2, True), ("a", 3, True)]
    assert tables.insert_if_absent(done, points, ["key", "d"]).count() == 3


def test_tables_and_views(spark):
    schema = spark.createDataFrame([], "key string, target_date date, v double").schema
    tables.ensure_table(spark, "t_gold.forecast", schema, partition_by=["target_date"])
    tables.ensure_table(spark, "t_gold.forecast", schema, partition_by=["target_date"])

    def batch(*r):
        return spark.sql(" UNION ALL ".join(f"SELECT '{k}' AS key, {v}D AS v, DATE'{d}' AS target_date" for k, d, v in r))

    tables.replace_partitions(batch(("a", "2024-01-01", 1), ("b", "2024-01-01", 2), ("a", "2024-01-02", 3)), "t_gold.forecast")
    tables.replace_partitions(batch(("a", "2024-01-01", 9)), "t_gold.forecast")
    stored = spark.table("t_gold.forecast").select("key", F.col("target_date").cast("string"), "v")
    assert rows(stored, "target_date") == [("a", "2024-01-01", 9.0), ("a", "2024-01-02", 3.0)]

    tables.publish(spark.range(3).toDF("n"), "t_gold.numbers")
    tables.publish(spark.range(2).toDF("n"), "t_gold.numbers")
    tables.publish_view(spark, "t_gold.small", "SELECT n FROM t_gold.numbers WHERE n < 1")
    assert spark.table("t_gold.numbers").count() == 2 and spark.table("t_gold.small").count() == 1


def test_csv_export(spark, tmp_path):
    out = str(tmp_path / "errors")
    tables.export_csv(spark.createDataFrame([("a", 1.5)], "key string, error double"), out)
    assert spark.read.csv(out, header=True).collect()[0].asDict() == {"key": "a", "error": "1.5"}


def test_stream_lands_each_document_once(spark, tmp_path):
    tables.ensure_table(spark, "t_bronze.docs", RAW_DOCUMENTS)
    source = tmp_path / "in"
    docs = spark.createDataFrame([("a",), ("b",), ("a",)], "doc_id string")
    for c in RAW_DOCUMENTS.fields[1:]:
        docs = docs.withColumn(c.name, F.lit(None).cast(c.dataType))
    for _ in range(2):
        docs.write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(RAW_DOCUMENTS).parquet(str(source))
        land_stream(stream, "t_bronze.docs", "doc_id", ["raw_json"], str(tmp_path / "state")).awaitTermination(60)
    assert rows(spark.table("t_bronze.docs").select("doc_id"), "doc_id") == [("a",), ("b",)]
