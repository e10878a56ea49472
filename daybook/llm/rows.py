"""Helpers of the operators in this folder: keys of texts, settings of a run, columns added by Arrow functions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import ensure_checkpoint_dir

#: Runs of ASCII white space, as (?-u)\s of most engines has it, that are not one space already.
_SPACE_TO_MEND = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def one_spaced(text: Column) -> Column:
    """The text with every run of ASCII white space as one space; NULL stays NULL."""
    return F.regexp_replace(text, _SPACE_TO_MEND, " ")


def hash_pair(first: str, second: str, *columns: Column) -> list[Column]:
    """128 bits over the columns in two BIGINT columns. A NULL differs from every value."""
    parts = [p for c in columns for p in (c.isNull(), c)]
    return [F.xxhash64(*parts).alias(first), F.xxhash64(F.lit(2_654_435_761), *parts).alias(second)]


def same_crc_part(doc_id: Column, parts: int = 4) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def held_out(doc_id: Column) -> Column:
    """The rows whose labels no model here may see. A NULL id counts as seen by no one, so it is not held out."""
    return F.coalesce(same_crc_part(doc_id) == 2, F.lit(False))


def id_order(doc_id: Column, *rest: Column) -> Column:
    """Orders rows by id with NULL ids last, then by the rest."""
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), *rest)


def quoted(name: str) -> str:
    """A column's name as a reference, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"


def with_arrow_columns(
    df: DataFrame, fields: Sequence[tuple[str, T.DataType]],
    each: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]], drop: Sequence[str] = (),
) -> DataFrame:
    """``df`` with the columns ``fields`` behind its own, from ``each``, which gives arrays per Arrow batch.

    A column of ``df`` that has the name of a new one is replaced by it; those in ``drop`` are read and not given back. Batches are bounded
    in rows and bytes by the session's Arrow settings.
    """
    new = {name.lower() for name in [*drop, *(name for name, _ in fields)]}  # as Spark tells names apart
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in fields])
    keep_at = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in new]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def noted():
            for b in batches:
                waiting.append(b)
                del b  # no batch is held while the next one comes
                yield waiting[-1]

        for arrays in each(noted()):
            b = waiting.pop(0)
            done = pa.RecordBatch.from_arrays([b.column(i) for i in keep_at] + list(arrays), names=names)
            del b, arrays
            yield done
            del done

    # a dot in a name is read as a field there
    return df.toDF(*[n.replace(".", " ") for n in df.columns]).mapInArrow(run, schema)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the checkpoint folder that all executors share, and read from there.

    Like a checkpoint it cuts the lineage and outlives executors; it is smaller, and later steps read only the
    columns that they need. The files may go once the results that came from them are written.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
