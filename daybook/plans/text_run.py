"""The text branch on stored tables: pick a document per day, split, enrich, keep what worked.

Incremental by target day: a day whose enrichment failed stays open and the next run
tries it again, whichever document it then picks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.text import is_verbatim, labelled
from daybook.operators.daily_pick import daily_pick, incremental_todo
from daybook.operators.enrich import enrich_once, failures, succeeded
from daybook.operators.quality import Check, evidence_verified, fresh, not_empty, value_range
from daybook.operators.sections import split_sections
from daybook.plans.gates import MAX_EXTRACTION_LAG_HOURS, Gate
from daybook.schemas import SECTIONS, extraction_schema
from daybook.session import materialise
from daybook.sources.tables import append, ensure_table, replace_partitions

SECTION_TABLE, EXTRACTION_TABLE = "silver.sections", "silver.extractions"
#: Results of calls by what they depend on, so that none is paid twice.
PAID_EXTRACTIONS, PAID_VECTORS = "ops.paid_extractions", "ops.paid_vectors"

# The record of a weather text, and the ranges in which its numbers are believable.
WEATHER_RECORD = T.StructType([
    T.StructField("rain_expected", T.StringType()), T.StructField("rain_amount_inches_max", T.DoubleType()),
    T.StructField("high_temp_f", T.DoubleType()), T.StructField("low_temp_f", T.DoubleType()),
    T.StructField("max_wind_gust_mph", T.DoubleType()), T.StructField("hazards", T.ArrayType(T.StringType())),
    T.StructField("forecaster_confidence", T.StringType()), T.StructField("summary", T.StringType()),
    T.StructField("evidence", T.StringType()),
])
WEATHER_RANGES = (
    ("high_temp_f", -40, 125), ("low_temp_f", -40, 125), ("max_wind_gust_mph", 0, 200), ("rain_amount_inches_max", 0, 30),
)

#: Gets the text, the day that it is read for and the time it was issued; returns a record.
Extract = Callable[[str, date, datetime], dict]
#: Gets a list of texts; returns a list of vectors.
Embed = Callable[[list[str]], list[Sequence[float]]]


def documents_gate(now: str, target: str, max_age_hours: float) -> Gate:
    """Of the raw documents, before anything is read from them."""
    return Gate("discussions", target, (not_empty(), fresh("issued_at", now, max_age_hours)))


def extraction_gate(now: str, ranges: Sequence[tuple[str, float, float]] = WEATHER_RANGES) -> Gate:
    checks: list[Check] = [not_empty(), fresh("issued_at", now, MAX_EXTRACTION_LAG_HOURS)]
    return Gate("discussions", EXTRACTION_TABLE, (
        *checks, *[value_range(*r) for r in ranges], evidence_verified("evidence_verified")))


def ensure_tables(spark: SparkSession, record: T.StructType = WEATHER_RECORD) -> None:
    ensure_table(spark, SECTION_TABLE, SECTIONS, partition_by=["run_date"])
    ensure_table(spark, EXTRACTION_TABLE, extraction_schema(record))


def run(
    spark: SparkSession, documents: DataFrame, as_of: str, extract: Extract, embed: Embed, models: tuple[str, str],
    text_field: str = "productText", record: T.StructType = WEATHER_RECORD, tasks: int | None = None,
) -> DataFrame:
    """Process every picked day without a result; returns what failed as warnings for the run log.

    ``documents`` is the raw table. ``extract`` and ``embed`` are the caller's functions, ``models`` their
    names, ``record`` what ``extract`` returns (it must have ``evidence``). Calls cost money, so their
    results are stored before use, and a call with the same arguments is not made again. ``tasks`` bounds the calls at a time; the session's parallelism otherwise.
    """
    ensure_tables(spark, record)
    tasks = tasks or spark.sparkContext.defaultParallelism
    picks = daily_pick(documents.select("doc_id", "issued_at", "raw_json"), "issued_at", "doc_id", as_of)
    todo = incremental_todo(picks, spark.table(EXTRACTION_TABLE))
    todo = todo.withColumn("text", F.get_json_object("raw_json", f"$.{text_field}"))

    day = ["doc_id", "issued_at", "run_date", "target_date"]
    extracted = materialise(enrich_once(
        todo, ["text", "target_date", "issued_at"], [*day, "text"], extract, record, models[0], PAID_EXTRACTIONS, tasks=tasks))
    read = succeeded(extracted)

    parts = split_sections(read, "text", day)
    parts = parts.withColumn("label", labelled(F.col("section_name"), F.col("content")))
    columns = [*day, "section_index", "section_name", "content"]
    embedded = materialise(enrich_once(
        parts, "label", columns, embed, T.ArrayType(T.FloatType()), models[1], PAID_VECTORS, tasks=tasks, whole_batch=True))

    # A document counts as done only when all of its sections worked.
    broken = embedded.where(F.col("error").isNotNull()).select("doc_id").distinct()
    whole = succeeded(embedded).join(broken, "doc_id", "left_anti")
    replace_partitions(
        whole.withColumnsRenamed({"result": "embedding"}).withColumn("embedding_model", F.lit(models[1])), SECTION_TABLE)

    done = read.join(broken, "doc_id", "left_anti").select(
        "doc_id", "issued_at", "target_date", "result.*",
        is_verbatim(F.col("result.evidence"), F.col("text")).alias("evidence_verified"),
        F.lit(models[0]).alias("extraction_model"), F.to_timestamp_ntz(F.current_timestamp()).alias("extracted_at"))
    append(done.select(*spark.table(EXTRACTION_TABLE).columns), EXTRACTION_TABLE)
    return failures(extracted, "doc_id", "discussions", EXTRACTION_TABLE).unionByName(
        failures(embedded, "doc_id", "discussions", SECTION_TABLE))
