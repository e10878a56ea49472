"""Raw JSON payloads of parallel arrays, to and from rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import iso_naive
from daybook.schemas import hourly_payload


def unpack_payloads(df: DataFrame, raw: str, measures: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per array position: the kept columns, ``ts`` and the measures. No shuffle.

    Malformed JSON, a missing array or one shorter than ``time`` stops the query: silent
    repair would shift values to the wrong hour. FAILFAST covers malformed text and wrong
    types, the rest is asserted here. NULL elements flow on to the checks.
    """
    schema = hourly_payload(list(measures))
    parsed = df.select(*keep, F.from_json(raw, schema, {"mode": "FAILFAST"})["hourly"].alias("_h"))
    complete = F.col("_h.time").isNotNull()
    for m in measures:
        complete = complete & (F.size(f"_h.{m}") >= F.size("_h.time"))
    zipped = F.arrays_zip(F.col("_h.time").alias("time"), *[F.col(f"_h.{m}").alias(m) for m in measures])
    fault = F.raise_error(F.lit("payload misses an array or has one shorter than time"))
    checked = parsed.select(*keep, F.when(F.coalesce(complete, F.lit(False)), zipped).otherwise(fault).alias("_z"))
    # The outer form evaluates the arrays once: a plain inline would copy them into a size filter.
    rows = checked.select(*keep, F.inline_outer("_z"))
    return rows.where(F.col("time").isNotNull()).select(*keep, iso_naive(F.col("time")).alias("ts"), *measures)
