"""Daily rollup of timestamped rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.scoring import rounded


@dataclass(frozen=True)
class Measure:
    """One output column: ``how`` is min, max, avg or sum of ``source``.

    ``scale`` states how many decimals the source has. Sums then run in whole units of
    the last decimal, so that the result does not depend on the order in which tasks add
    up doubles; a value with more decimals, or a total beyond the 64-bit range, stops the query.
    """

    name: str
    how: str
    source: str
    digits: int = 1
    scale: int | None = None

    def column(self) -> Column:
        value = F.col(self.source)
        if self.how in ("sum", "avg") and self.scale is not None:
            units = 10.0**self.scale
            whole = F.rint(value * units)
            off = F.abs(value * units - whole) > 1e-6 * F.greatest(F.lit(1.0), F.abs(whole) * 1e-9)
            said = F.concat(F.lit(f"{self.source} has more than {self.scale} decimals: "), value.cast("string"))
            total = F.sum(F.when(off, F.raise_error(said).cast("long")).otherwise(whole.cast("long"))) / units
            out = total if self.how == "sum" else total / F.count(value)
        else:
            out = {"min": F.min, "max": F.max, "avg": F.avg, "sum": F.sum}[self.how](value)
        return rounded(out, self.digits).alias(self.name)


def daily_rollup(df: DataFrame, key: str, ts: str, measures: Sequence[Measure]) -> DataFrame:
    """One row per key and calendar day. Partial aggregates absorb hot keys before the shuffle."""
    day = F.to_date(F.col(ts)).alias("date")
    return df.groupBy(F.col(key).alias("key"), day).agg(*[m.column() for m in measures])
