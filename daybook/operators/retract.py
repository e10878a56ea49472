"""Daily summaries kept under versions that arrive late: what a newer version supersedes is taken back exactly.

The state holds how often each value counts, per key, day and source column. A landing changes it by signed rows, so a day is
never summed anew from its rows. Sums come from whole units, minima and maxima from the values that still count. Landings may come in any
order, and one that comes twice changes nothing the second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.scoring import rounded
from daybook.operators.dedupe import latest_wins
from daybook.operators.joins import lookup, unmatched
from daybook.operators.rollup import Measure

#: The source under which the state counts rows, whatever their values.
ROWS = ""


def landing_changes(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest rows of a landing with ``sign`` 1, and with -1 the stored rows that they supersede. ``stored`` has one row per key.

    A row that is no newer than the stored one changes nothing. A NULL version or tie is older than any other.
    """
    newest = latest_wins(incoming, keys, version, ties).select(*stored.columns)
    was = stored.select(*keys, F.struct(*stored.columns).alias("_was"))
    met = lookup(newest, was, keys)

    def place(of: str) -> Column:
        return F.struct(*[F.struct(F.col(f"{of}{c}").isNotNull(), F.col(f"{of}{c}")) for c in (version, *ties)])

    newer = met.where(F.col("_was").isNull() | (place("") > place("_was.")))
    signed = F.array(F.struct(F.lit(1).alias("sign"), F.struct(*stored.columns).alias("row")),
                     F.when(F.col("_was").isNotNull(), F.struct(F.lit(-1).alias("sign"), F.col("_was").alias("row"))))
    return newer.select(F.explode(signed).alias("c")).where("c IS NOT NULL").select("c.row.*", "c.sign")


def with_changed_rows(stored: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored rows after the changes: one per key, the newest."""
    new = changes.where("sign = 1").drop("sign").select(*stored.columns)
    return unmatched(stored, new, keys).unionByName(new)


def value_counts(changes: DataFrame, key: str, ts: str, measures: Sequence[Measure]) -> DataFrame:
    """key, date, source, value, n: what the signed rows add to the state. Copies combine before the shuffle."""
    sources = list(dict.fromkeys(m.source for m in measures))
    values = [F.struct(F.lit(s).alias("source"), F.col(s).cast("double").alias("value")) for s in sources]
    rows = F.struct(F.lit(ROWS).alias("source"), F.lit(None).cast("double").alias("value"))
    each = changes.select(F.col(key).alias("key"), F.to_date(F.col(ts)).alias("date"), "sign", F.inline(F.array(rows, *values)))
    counted = each.where((F.col("source") == ROWS) | F.col("value").isNotNull())
    return _added(counted.withColumnRenamed("sign", "n"))


def _added(counts: DataFrame) -> DataFrame:
    added = counts.groupBy("key", "date", "source", "value").agg(F.sum("n").alias("n"))
    return added.where(F.col("n") != 0)


def with_counts(state: DataFrame, more: DataFrame) -> DataFrame:
    """The state after a landing. Only days that ``more`` names differ, so a stored state replaces just those."""
    return _added(state.unionByName(more.select(*state.columns)))


def _summarised(m: Measure) -> Column:
    mine = (F.col("source") == m.source) & (F.col("n") > 0)
    value = F.when(mine, F.col("value"))
    if m.how in ("min", "max"):
        return rounded((F.min if m.how == "min" else F.max)(value), m.digits).alias(m.name)
    units = 10.0 ** (m.scale or 0)
    each = F.rint(value * units).cast("long") * F.col("n") if m.scale is not None else value * F.col("n")
    total = F.sum(each) / units
    return rounded(total if m.how == "sum" else total / F.sum(F.when(mine, F.col("n"))), m.digits).alias(m.name)


def summary(state: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """The daily rollup of the rows that count: one row per key and day."""
    return state.groupBy("key", "date").agg(*[_summarised(m) for m in measures])
