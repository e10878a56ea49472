"""As-of join: to each row the last known row of another table, at its time or before."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.blocked import BLOCK, in_block, with_earlier


def as_of(
    left: DataFrame, right: DataFrame, on: Sequence[str], at: str, known_at: str, take: Sequence[str], block: str = "DAY",
) -> DataFrame:
    """``left`` with the columns ``take`` of the last row of ``right`` that has the same keys and ``known_at`` <= ``at``.

    Both sides become one series per key, in which the last known row is carried forward, within blocks of time and from block to
    block; no pairs are made, and a hot key is spread over its blocks. Of rows known at one time the last in the order of the taken
    columns counts. Without one, or with a NULL key or time, the columns are NULL; every row of ``left`` stays.
    """
    row, known = F.struct(*left.columns), F.struct(*take)
    asked = left.select(*on, F.col(at).alias("_time"), F.lit(1).alias("_side"), row.alias("_row"))
    told = right.where(F.col(known_at).isNotNull()).select(*on, F.col(known_at).alias("_time"), F.lit(0).alias("_side"), known.alias("_known"))
    both = told.unionByName(asked, allowMissingColumns=True).withColumn(BLOCK, F.date_trunc(block, "_time").cast("timestamp_ntz"))
    place = F.when(F.col("_side") == 0, F.struct("_time", "_known"))
    carried = with_earlier(
        both, on, {"_before": F.max_by("_known", place)}, lambda c, before: F.last(c, ignorenulls=True).over(before))
    so_far = in_block(on, ["_time", "_side", "_known"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = F.coalesce(F.last("_known", ignorenulls=True).over(so_far), "_before")
    named = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*on, "_time")])
    out = carried.withColumn("_found", F.when(named, found)).where("_side = 1")
    return out.select("_row.*", *[F.col("_found")[c].alias(c) for c in take])
