"""Column types of the stored tables. Derived tables take their schema from the query that builds them."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D, _I, _B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()
_TS, _DATE = T.TimestampNTZType(), T.DateType()

# A source that is fetched again has a new version, its fetch time. Landings are numbered, so that what came
# after any of them can be read alone; landed_on and landing are the partitions.
RAW_PAYLOADS = _struct(
    ("key", _S), ("fetched_at", _TS), ("source_url", _S), ("raw_json", _S), ("landed_on", _DATE), ("landing", T.LongType()),
)

# How far the landings of a raw table have been merged into the tables behind it.
MERGED = _struct(("target", _S), ("landing", T.LongType()), ("merged_at", _TS))

RAW_DOCUMENTS = _struct(
    ("doc_id", _S), ("office", _S), ("issued_at", _TS), ("fetched_at", _TS), ("source_url", _S), ("raw_json", _S)
)

SECTIONS = _struct(
    ("doc_id", _S), ("issued_at", _TS), ("run_date", _DATE), ("section_index", _I), ("section_name", _S),
    ("content", _S), ("embedding", T.ArrayType(T.FloatType())), ("embedding_model", _S),
)


def extraction_schema(record: T.StructType) -> T.StructType:
    """Where extractions are stored: which document and day, the record that the caller's function returns, its source."""
    return T.StructType([
        *_struct(("doc_id", _S), ("issued_at", _TS), ("target_date", _DATE)).fields, *record.fields,
        *_struct(("evidence_verified", _B), ("extraction_model", _S), ("extracted_at", _TS)).fields])


# The columns of the two log tables.
PIPELINE_RUNS = _struct(
    ("run_id", _S), ("started_at", _TS), ("finished_at", _TS), ("status", _S), ("n_pass", _I), ("n_warn", _I),
    ("n_fail", _I), ("error", _S), ("triggered_by", _S),
)

DQ_RESULTS = _struct(
    ("run_id", _S), ("checked_at", _TS), ("step", _S), ("check_name", _S), ("target", _S), ("status", _S), ("detail", _S)
)

METRIC_DEFINITIONS = _struct(
    ("name", _S), ("label", _S), ("description", _S), ("table_name", _S), ("expression", _S), ("filter", _S), ("unit", _S)
)

LINEAGE_NODES = _struct(
    ("node", _S), ("type", _S), ("label", _S), ("description", _S), ("built_by", _S), ("upstream", T.ArrayType(_S))
)

EXPERIMENT_RUNS = _struct(
    ("run", _S), ("params", T.MapType(_S, _S)), ("metrics", T.MapType(_S, _D)), ("logged_at", _TS)
)


def forecast_schema(metrics: list[str]) -> T.StructType:
    """One row per key and target day, a prediction per metric."""
    return _struct(
        ("key", _S), ("target_date", _DATE), *[(f"predicted_{m}", _D) for m in metrics],
        ("model_type", _S), ("training_rows", T.LongType()), ("is_backtest", _B),
    )


def hourly_payload(measures: list[str]) -> T.StructType:
    """Raw JSON of one fetch: parallel arrays under one struct, aligned with ``time``."""
    arrays = [("time", T.ArrayType(_S)), *[(m, T.ArrayType(_D)) for m in measures]]
    return _struct(("hourly", _struct(*arrays)))
