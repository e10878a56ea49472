"""One document per day, and the days still to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import run_date
from daybook.operators.dedupe import first_wins, latest_wins
from daybook.operators.joins import unmatched


def daily_pick(docs: DataFrame, issued_at: str, doc_id: str, as_of: str, cutoff_hour: int = 5) -> DataFrame:
    """For each run date, the latest document of the 24 hours before its cut-off.

    Shifting the timestamp by the cut-off turns the window into a day bucket, so this
    is a map-side combined aggregate instead of a range join. Only ids and timestamps are
    aggregated; the picks, one narrow row per calendar day, then fetch their documents in a join
    that Spark plans from their measured size. Of rows that share id and time the first in the
    order of the other columns counts. The first date of the series has no full window and is never picked.
    """
    cutoff = F.expr(f"INTERVAL {int(cutoff_hour)} HOURS")
    first_day = docs.select(F.min(F.to_date(issued_at)).cast("timestamp_ntz")).scalar()
    last = F.lit(as_of).cast("timestamp_ntz")
    # Stated on the timestamp itself, so that the upper bound reaches the scan.
    known = docs.where(F.col(issued_at) < last + cutoff)
    in_range = known.where(F.col(issued_at) >= first_day + cutoff)
    bucketed = in_range.select(run_date(F.col(issued_at), cutoff_hour).alias("run_date"), issued_at, doc_id)
    picks = latest_wins(bucketed, ["run_date"], issued_at, [doc_id])
    found = known.join(picks, [issued_at, doc_id]).select("run_date", *docs.columns)
    return first_wins(found, ["run_date"], docs.columns)


def incremental_todo(picks: DataFrame, done: DataFrame) -> DataFrame:
    """Picks whose target day (the day after the run date) has no result yet, whichever document made it."""
    targeted = picks.withColumn("target_date", F.date_add("run_date", 1))
    return targeted.join(done.select("target_date").distinct(), "target_date", "left_anti")


def replace_documents(stored: DataFrame, fresh: DataFrame, doc_id: str, columns: Sequence[str]) -> DataFrame:
    """Stored rows of other documents plus the fresh rows: leftovers of a failed attempt disappear."""
    return unmatched(stored, fresh, [doc_id]).select(*columns).unionByName(fresh.select(*columns))
