"""Raw landing: append-only payloads, and land-once documents by stable id.

A folder is landed by its listing: paths, times and sizes are compared with what has landed, and only files that
are new, or new in their present version, are opened. So a run costs the listing and the new files, however
many files earlier runs have left in the folder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.dedupe import first_wins
from daybook.sources.tables import absent


#: Paths that one pass over new files names. They come from Spark's own listing of the folder, which is the driver's.
FILES_A_PASS = 10_000
_PATTERN_SIGNS = re.compile(r"([\\\[\]{}*?])")


def list_files(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """One row per file, none of which is read: source_url, path, bytes and the time when it was written.

    ``since`` and ``until`` bound that time, which is how a wider one-off backfill and a daily run share this function.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if since:
        reader = reader.option("modifiedAfter", since)
    if until:
        reader = reader.option("modifiedBefore", until)
    return reader.load(path).select(
        F.col("_metadata.file_path").alias("source_url"), "path", F.col("_metadata.file_size").alias("bytes"),
        F.to_timestamp_ntz("_metadata.file_modification_time").alias("fetched_at"))


def new_versions(landed: DataFrame, listing: DataFrame, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """The listed sources that have not landed in their present version (source_url, fetched_at), written from ``since`` to before ``until``."""
    wanted = listing
    if since is not None:
        wanted = wanted.where(F.col("fetched_at") >= since)
    if until is not None:
        wanted = wanted.where(F.col("fetched_at") < until)
    return absent(landed, wanted, ["source_url", "fetched_at"])


def payload_files(spark: SparkSession, paths: Sequence[str], key: Column) -> DataFrame:
    """The named files, one row each: key, source path, the unparsed text and the time it was fetched, which is when it was written."""
    literal = [_PATTERN_SIGNS.sub(r"\\\1", p) for p in paths]
    return _payloads(spark.read.option("wholetext", "true").text(literal), key)


def new_payloads(spark: SparkSession, new: DataFrame, key: Column, at_once: int = FILES_A_PASS) -> Iterator[DataFrame]:
    """The contents of the files in ``new`` (path), which is stored, in passes of ``at_once`` files."""
    paths = (r.path for r in new.select("path").toLocalIterator())
    while some := list(islice(paths, at_once)):
        yield payload_files(spark, some, key)


def _payloads(files: DataFrame, key: Column) -> DataFrame:
    named = files.select(
        "value", F.col("_metadata.file_path").alias("source_url"), F.col("_metadata.file_modification_time").alias("written"))
    return named.select(key.alias("key"), F.to_timestamp_ntz("written").alias("fetched_at"), "source_url", F.col("value").alias("raw_json"))


def read_payload_files(spark: SparkSession, path: str, key: Column, since: str | None = None,
                       until: str | None = None) -> DataFrame:
    """One row per file: key, source path, the unparsed text and the time it was fetched, which is when it was written.

    ``since`` and ``until`` bound that time, which is how a wider one-off backfill and a
    daily run share this function.
    """
    reader = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
    if since:
        reader = reader.option("modifiedAfter", since)
    if until:
        reader = reader.option("modifiedBefore", until)
    return _payloads(reader.text(path), key)


def land_raw(payloads: DataFrame, key: str, source: str, raw: str, fetched_at: Column) -> DataFrame:
    """Rows in the shape of the raw table, payload untouched."""
    return payloads.select(
        F.col(key).cast("string").alias("key"), fetched_at.cast("timestamp_ntz").alias("fetched_at"),
        F.col(source).alias("source_url"), F.col(raw).alias("raw_json"),
    )


def land_new_by_id(landed: DataFrame, incoming: DataFrame, id_column: str, order: Sequence[str]) -> DataFrame:
    """Incoming rows whose id has not landed, one per id. Copies shrink to one row before the join."""
    unique = first_wins(incoming, [id_column], order)
    return absent(landed, unique, [id_column]).select(*incoming.columns)
