"""Joins of a large side that may have hot keys with a side reduced to one row per key.

Adaptive execution splits a hot partition of the large side only where both sides of the
join come straight from an exchange. A side that was just aggregated is partitioned by
its key already and would join without one, so the keys are compared as a struct: that
gives both sides a fresh exchange, and the reduced side is the small one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(large: DataFrame, reduced: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``reduced``, which has one row per key, to every row of ``large``. NULL keys match nothing."""
    known = reduced.dropna(subset=list(on)).withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = F.struct(*on) == F.struct(*[F.col(f"_on_{c}").alias(c) for c in on])
    return large.join(known, same, how).drop(*[f"_on_{c}" for c in on])


def matching(large: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``large`` whose key occurs in ``keys``, where it may occur many times."""
    return lookup(large, keys.select(*on).distinct(), on, "left_semi")


def unmatched(large: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``large`` whose key does not occur in ``keys``."""
    return lookup(large, keys.select(*on).distinct(), on, "left_anti")
