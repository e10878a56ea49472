"""Overlapping windows of three lines: a window that occurred before goes, with every line it covers.

Lines are compared with white space trimmed and made one, in lower case. The windows' 128-bit
hashes are grouped over all documents; the first occurrence, by id and position, stays. The
lines of all later ones are merged per document and removed.

Defined results: a NULL text counts as empty, a text of fewer than three lines has no window,
and a window of three blank lines is never removed. NULL ids order last. Rows that agree in id
and text are one document and get the same result. Other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import hash_pair, id_order
from daybook.llm.units import is_removed, keyed_rows, normal_unit, removal_mask
from daybook.operators.joins import lookup

WIDTH = 3


def line_windows(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """k1, k2, doc_id, start, w1, w2: one row per window of ``width`` lines that are not all blank."""
    normal = F.transform(F.split("text", "\n"), normal_unit)
    hashes = F.transform(normal, lambda line: F.struct(*hash_pair("a", "b", line), (line == "").alias("blank")))
    lines = rows.select("k1", "k2", "doc_id", hashes.alias("lines"))
    count = F.size("lines") - width + 1

    def window(start):
        part = [F.col("lines")[start + i] for i in range(width)]
        blank = part[0]["blank"]
        for p in part[1:]:
            blank = blank & p["blank"]
        return F.when(~blank, F.struct(
            start.alias("start"), F.xxhash64(*[p["a"] for p in part]).alias("w1"), F.xxhash64(*[p["b"] for p in part]).alias("w2")))

    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    found = lines.select("k1", "k2", "doc_id", F.explode_outer(F.transform(starts, window)).alias("w"))
    return found.where("w IS NOT NULL").select("k1", "k2", "doc_id", "w.start", "w.w1", "w.w2")


def remove_repeated_windows(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """One row per row of ``df``: doc_id, text, kept_text, n_lines, n_removed."""
    rows = keyed_rows(df, text, doc_id)
    windows = line_windows(rows, width)
    place = id_order(F.col("doc_id"), F.col("k1"), F.col("k2"), F.col("start"))
    first = windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = first.where("first < last").select("w1", "w2", "first")
    later = lookup(windows, repeated, ["w1", "w2"], "inner").where(place > F.col("first"))
    masks = later.groupBy("k1", "k2").agg(F.collect_set("start").alias("starts")).select(
        "k1", "k2", removal_mask(F.col("starts"), width).cast("binary").alias("mask"))
    both = lookup(rows, masks, ["k1", "k2"])
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~is_removed(F.col("mask"), i))
    total = F.size(F.split("text", "\n"))
    removed = F.length(F.regexp_replace(F.col("mask").cast("string"), "0", ""))
    return both.select(
        "doc_id", "text", F.when(F.col("mask").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("kept_text"),
        total.alias("n_lines"), F.coalesce(removed, F.lit(0)).alias("n_removed"))
