"""Exact duplicates by two passes over a Bloom filter.

Pass one throws every text's digest at a few slots of a bit table and keeps the slots that
were hit at least twice. Pass two looks up each digest: a text of which one slot was hit once
is the only one of its kind, and its row passes straight through. Only the others shuffle.

The filter is a table of bitmaps made with SQL functions. It grows with the number of rows up
to ``MAX_BITS`` (32 MB), the bound of what is broadcast; beyond that more rows count as
possibly repeated, and the result stays the same.

Defined results: a NULL text counts as empty. The row with the smallest id stays, NULL ids come
last. Of rows that agree in id and text, one stays. Columns other than id and text are carried
along by ``drop_copies`` and ignored by ``mark_copies``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import id_order, one_spaced
from daybook.operators.joins import lookup
from daybook.session import materialise

MIN_BITS, MAX_BITS = 1 << 18, 1 << 28
BITS_PER_ROW = 16
SLOTS = 2


def text_digest(text: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the text with its white space made one space."""
    return F.sha2(one_spaced(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def filter_bits(rows: int, per_row: int = BITS_PER_ROW) -> int:
    return min(MAX_BITS, max(MIN_BITS, 1 << math.ceil(math.log2(max(1, rows) * per_row))))


def _slot(digest: Column, number: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(number)), F.lit(bits)) + 1


def repeated_slots(digests: DataFrame, bits: int, digest: str = "sha", slots: int = SLOTS, least: int = 2) -> DataFrame:
    """Pass one: bitmaps of the slots that were hit by at least two rows (or ``least``), one row per 32,768 slots."""
    hits = digests.select(F.explode(F.array(*[_slot(F.col(digest), i, bits) for i in range(slots)])).alias("slot"))
    twice = hits.groupBy("slot").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return twice.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


def with_possible(df: DataFrame, repeated: DataFrame, bits: int, digest: str = "sha", slots: int = SLOTS) -> DataFrame:
    """Pass two: adds ``possible``, false for rows whose digest certainly occurs once."""
    out = df
    for i in range(slots):
        slot = _slot(F.col(digest), i, bits)
        side = F.broadcast(repeated.select(F.col("bucket").alias(f"_bucket{i}"), F.col("bits").alias(f"_bits{i}")))
        at = F.bitmap_bit_position(slot).cast("int")
        byte = F.conv(F.hex(F.substring(F.col(f"_bits{i}"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = F.call_function("shiftright", byte, at % 8).bitwiseAND(1) == 1
        out = out.join(side, F.bitmap_bucket_number(slot) == F.col(f"_bucket{i}"), "left").withColumn(
            f"_hit{i}", F.coalesce(hit, F.lit(False))).drop(f"_bucket{i}", f"_bits{i}")
    both = F.lit(True)
    for i in range(slots):
        both = both & F.col(f"_hit{i}")
    return out.withColumn("possible", both).drop(*[f"_hit{i}" for i in range(slots)])


def mark_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = materialise(df.select(F.col(doc_id).alias("doc_id"), text_digest(F.col(text)).alias("sha")))
    bits = filter_bits(digests.count())
    marked = with_possible(digests, materialise(repeated_slots(digests, bits)), bits)
    straight = marked.where(~F.col("possible")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"))
    rows = marked.where("possible").groupBy("sha", "doc_id").agg(F.count("*").alias("copies"))
    groups = rows.groupBy("sha").agg(F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    first = (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    repeated = lookup(rows, groups, ["sha"]).select(
        "doc_id", "keep_id", "group_size", "sha", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    ).select("doc_id", "keep_id", "group_size", first.alias("kept"), F.col("sha").alias("text_sha256"))
    return straight.unionByName(repeated)


def drop_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; a row that cannot be a copy never shuffles."""
    keyed = df.select(F.struct("*").alias("row"), text_digest(F.col(text)).alias("sha"), F.col(doc_id).alias("id"))
    digests = materialise(keyed.select("sha"))
    bits = filter_bits(digests.count())
    marked = with_possible(keyed, materialise(repeated_slots(digests, bits)), bits)
    straight = marked.where(~F.col("possible")).select("row.*")
    order = id_order(F.col("id"), F.xxhash64("row"))
    winners = marked.where("possible").groupBy("sha").agg(F.min_by("row", order).alias("row")).select("row.*")
    return straight.unionByName(winners)
