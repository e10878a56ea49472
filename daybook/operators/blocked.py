"""Windows over series of any length: cut into blocks, blocks reduced and scanned, rows finished inside their block.

A series is the rows of one key in a total order. ``block`` is a column that never falls along it and so cuts it into
stretches, the day of a timestamp for example. What a row needs of earlier blocks comes from a table with one
row per key and block. The only window over a whole key runs on that table; all others run per key and
block, so one key with most of the rows keeps every core busy.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK = "_block"


def in_block(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys, BLOCK).orderBy(*order)


def with_earlier(
    df: DataFrame, keys: Sequence[str], reduced: Mapping[str, Column], scanned: Callable[[str, WindowSpec], Column],
) -> DataFrame:
    """``df``, which has the block, with what all earlier blocks of its key come to.

    ``reduced`` are aggregates of one block by name; ``scanned`` combines the column of that name over the blocks before.
    """
    blocks = df.groupBy(*keys, BLOCK).agg(*[c.alias(name) for name, c in reduced.items()])
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    known = blocks.select(
        *[F.col(c).alias(f"_of_{c}") for c in (*keys, BLOCK)], *[scanned(name, before).alias(name) for name in reduced])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*keys, BLOCK)])
    return df.join(known, same, "left").drop(*[f"_of_{c}" for c in (*keys, BLOCK)])


def lagged(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str) -> DataFrame:
    """Adds the value of the row before, in whichever block that is."""
    value = F.struct(F.col(column).alias("v"))  # in a struct, as the value itself may be NULL
    carried = with_earlier(
        df, keys, {"_last": F.max_by(value, F.struct(*order))}, lambda c, before: F.last(c, ignorenulls=True).over(before))
    own = F.lag(value).over(in_block(keys, order))
    return carried.withColumn(name, F.coalesce(own, "_last")["v"]).drop("_last")


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Adds, for each row, the sums over all rows before it; 0 where there is none. NULLs count as 0."""
    valued = df.withColumns({f"_v_{name}": F.coalesce(c, F.lit(0)) for name, c in sums.items()})
    carried = with_earlier(
        valued, keys, {name: F.sum(f"_v_{name}") for name in sums}, lambda c, before: F.sum(c).over(before))
    ahead = in_block(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    own = {name: F.coalesce(F.sum(f"_v_{name}").over(ahead), F.lit(0)) + F.coalesce(name, F.lit(0)) for name in sums}
    return carried.withColumns(own).drop(*[f"_v_{name}" for name in sums])


def with_halo(df: DataFrame, keys: Sequence[str], order: Sequence[str], depth: int) -> DataFrame:
    """The rows and, marked by ``_halo``, copies of the ``depth`` rows before each block, placed in that block.

    Windows that look back at most ``depth`` rows are then whole inside a block. A block may be shorter than that, so a row
    can stand before up to ``depth`` blocks.
    """
    per_key = Window.partitionBy(*keys).orderBy(BLOCK)
    blocks = df.groupBy(*keys, BLOCK).agg(F.count("*").alias("_size")).withColumn(
        "_start", F.coalesce(F.sum("_size").over(per_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    following = F.collect_list(F.struct(F.col(BLOCK).alias("b"), F.col("_start").alias("s"))).over(per_key.rowsBetween(1, depth))
    blocks = blocks.select(*[F.col(c).alias(f"_of_{c}") for c in (*keys, BLOCK)], (F.col("_start") + F.col("_size")).alias("_end"),
                           following.alias("_next"))
    late = Window.partitionBy(*keys, BLOCK).orderBy(*[F.desc(c) for c in order])
    tail = df.withColumn("_back", F.row_number().over(late)).where(F.col("_back") <= depth)
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*keys, BLOCK)])
    copies = tail.join(blocks, same).withColumn("_to", F.explode("_next")).where(
        F.col("_to.s") <= F.col("_end") - F.col("_back") + depth).withColumn(BLOCK, F.col("_to.b"))
    return df.withColumn("_halo", F.lit(False)).unionByName(copies.select(*df.columns, F.lit(True).alias("_halo")))


def rolling_mean(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], depth: int, prefix: str) -> DataFrame:
    """Adds the mean of the ``depth`` rows before; NULL unless all of them have a value."""
    before = in_block(keys, order).rowsBetween(-depth, -1)
    means = {f"{prefix}_{c}": F.when(F.count(c).over(before) == depth, F.avg(c).over(before)) for c in columns}
    return with_halo(df, keys, order, depth).withColumns(means).where(~F.col("_halo")).drop("_halo")
