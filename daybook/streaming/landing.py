"""Landing as a stream: the batch functions, applied to every micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from daybook.sources.landing import land_new_by_id
from daybook.sources.tables import append


def land_stream(
    documents: DataFrame, table: str, id_column: str, order: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Append documents whose id has not landed; works off what is available and stops.

    A micro-batch that is replayed after a lost executor finds its ids landed already,
    so every document lands once. ``checkpoint`` is a folder every executor can reach.
    """
    def land(batch: DataFrame, _: int) -> None:
        landed = batch.sparkSession.table(table)
        append(land_new_by_id(landed, batch, id_column, order).select(*landed.columns), table)

    writer = documents.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
