"""Daily summaries from a stream of versions: keyed state holds the newest row, and what changes is kept as signed rows.

For each key and hour the state has the newest version seen. A newer one comes out as two rows, the old one with sign -1 and the new one with
sign 1, so summaries are exact whatever order rows come in. When the watermark has passed its hour, a state goes, and rows that come
later still are dropped by the stream. :func:`reconcile` takes those in with the batch functions: of any raw rows it adds what is newer than what
counts, so it may be given too many, and twice. A micro-batch that is repeated after a lost executor replaces its own
partition, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from daybook.operators.retract import landing_changes, summary, value_counts
from daybook.operators.rollup import Measure
from daybook.session import materialise
from daybook.sources.tables import ensure_table, replace_partitions

_ROW = "_row"
_STATE = "version long, tie string, row string"
#: Times in the packed row keep their microseconds.
_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _newest(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The state step: the newest of what the state has and what came; signed rows out."""
    if state.hasTimedOut:
        state.remove()
        return
    best = max((int(v), t, r) for b in batches for v, t, r in zip(b["_version"], b["_tie"], b[_ROW]))
    known = state.get if state.exists else None
    if known is None or best[:2] > (known[0], known[1]):
        rows = [best[2]] + ([known[2]] if known else [])
        state.update(best)
        yield pd.DataFrame({_ROW: rows, "sign": [1, -1][: len(rows)]})
    state.setTimeoutTimestamp(int(key[-1]) + 1)  # hours up to the watermark do not come here


def version_changes(
    rows: DataFrame, keys: Sequence[str], hour: str, version: str, tie: str, delay: str = "2 days",
) -> DataFrame:
    """The columns of ``rows`` with ``sign``, as a stream. ``hour`` is what a version stands for, ``delay`` how far hours may be behind.

    Versions are timestamps; of equal ones the larger tie, as text of equal length for numbers, wins.
    """
    at = F.col(hour).cast("timestamp")
    packed = rows.select(
        *keys, at.alias("_at"), F.unix_millis(at).alias("_hour_ms"), F.unix_micros(F.col(version).cast("timestamp")).alias("_version"),
        F.lpad(F.col(tie).cast("string"), 20, "0").alias("_tie"), F.to_json(F.struct(*rows.columns), _JSON).alias(_ROW))
    grouped = packed.withWatermark("_at", delay).groupBy(*keys, "_hour_ms")
    changed = grouped.applyInPandasWithState(_newest, f"{_ROW} string, sign int", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return changed.select(F.from_json(_ROW, rows.schema, _JSON).alias("r"), "sign").select("r.*", "sign")


def keep_changes(changes: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Work off what is available: every micro-batch is one partition of ``table``, written anew if it is repeated."""
    schema = T.StructType([*changes.schema.fields, T.StructField("batch", T.LongType())])
    ensure_table(changes.sparkSession, table, schema, partition_by=["batch"])

    def write(batch: DataFrame, number: int) -> None:
        replace_partitions(batch.withColumn("batch", F.lit(number).cast("long")), table)

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def counted_rows(changes: DataFrame) -> DataFrame:
    """The rows that count: the newest of each key, those brought and not taken back."""
    columns = [c for c in changes.columns if c not in ("sign", "batch")]
    return changes.groupBy(*columns).agg(F.sum("sign").alias("_n")).where("_n > 0").select(*columns)


def reconcile(spark: SparkSession, table: str, rows: DataFrame, keys: Sequence[str], hour: str, version: str, tie: str) -> None:
    """Take in what the stream has dropped: of ``rows`` those that are newer than what counts, as a partition below 0."""
    changes = spark.table(table)
    stored = counted_rows(changes)
    found = materialise(landing_changes(stored, rows.select(*stored.columns), [*keys, hour], version, [tie]))
    if not found.isEmpty():
        number = min(0, changes.agg(F.min("batch")).first()[0] or 0) - 1
        replace_partitions(found.withColumn("batch", F.lit(number).cast("long")).select(*changes.columns), table)


def daily_totals(changes: DataFrame, key: str, hour: str, measures: Sequence[Measure]) -> DataFrame:
    """The daily rollup of the rows that count, from the signed rows."""
    return summary(value_counts(changes, key, hour, measures), measures)
