"""What the operators on lines and paragraphs share: positions found again in the text, removed units cut out of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import hash_pair, one_spaced


def keyed_rows(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, text and a 128-bit key of both. Rows that agree in id and text are one document here."""
    doc, body = F.col(doc_id), F.coalesce(F.col(text), F.lit(""))
    return df.select(doc.alias("doc_id"), body.alias("text"), *hash_pair("k1", "k2", doc, body))


def normal_unit(unit: Column) -> Column:
    return F.lower(F.trim(one_spaced(unit)))


def removal_mask(starts: Column, width: int) -> Column:
    """A string with a '1' at each position that a unit of ``width`` starting in ``starts`` covers, up to the last one."""
    empty = F.struct(F.lit(0).alias("end"), F.lit("").alias("mask"))

    def grow(done: Column, start: Column) -> Column:
        gap = F.repeat(F.lit("0"), F.greatest(start - done["end"], F.lit(0)))
        ones = F.repeat(F.lit("1"), start + width - F.greatest(start, done["end"]))
        return F.struct((start + width).alias("end"), F.concat(done["mask"], gap, ones).alias("mask"))

    return F.aggregate(F.array_sort(F.array_distinct(starts)), empty, grow, lambda done: done["mask"])


def is_removed(mask: Column, position: Column) -> Column:
    """Whether position (from 0) has a '1' in the mask as bytes; past its end nothing is removed."""
    return F.coalesce(F.substring(mask, position + 1, F.lit(1)) == F.lit(b"1"), F.lit(False))
