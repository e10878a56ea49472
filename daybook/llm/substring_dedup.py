"""Repeated lines or paragraphs: the earliest ranked occurrence of a unit stays, the others go.

Units are normalised (white space trimmed and made one, lower case), hashed to 128 bits and
grouped over all documents. Ranks are an optional column, smaller first, then the id, then the
place in the text. What goes comes back as spans of the original text, so that a mask or a cut
can be made later, along with the text that is left.

Defined results: a NULL text counts as empty; a unit of fewer than ``min_words`` words is never
removed; NULL ranks and ids order last. Rows that agree in id and text are one document and get
the same result. Other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import hash_pair, id_order, with_arrow_columns
from daybook.llm.units import normal_unit
from daybook.operators.joins import lookup

SEPARATORS = {"line": "\n", "paragraph": "\n\n"}
_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])


def units(rows: DataFrame, unit: str, min_words: int) -> DataFrame:
    """k1, k2, doc_id, rank, at, u1, u2: one row per unit of at least ``min_words`` words."""
    found = rows.select("k1", "k2", "doc_id", "rank", F.posexplode_outer(F.split("text", SEPARATORS[unit])).alias("at", "unit"))
    normal = found.withColumn("unit", normal_unit(F.col("unit")))
    words = F.length("unit") - F.length(F.replace("unit", F.lit(" "), F.lit(""))) + 1
    long = normal.where((F.col("unit") != "") & (words >= min_words))
    return long.select("k1", "k2", "doc_id", "rank", "at", *hash_pair("u1", "u2", F.col("unit")))


def _cut(unit: str):
    """Texts with the units at the given places cut out, each with the separator behind it, and the spans cut."""
    sep = SEPARATORS[unit]

    def each(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            kept_texts, spans = [], []
            texts, gone_lists = b.column("text"), b.column("gone")
            for i in range(b.num_rows):
                gone = gone_lists[i].as_py()
                if not gone:
                    kept_texts.append(texts[i].as_py())
                    spans.append([])
                    continue
                gone, at, kept, cut = set(gone), 0, [], []
                for n, part in enumerate(texts[i].as_py().split(sep)):
                    end = at + len(part)
                    if n in gone:
                        if cut and cut[-1]["end"] + len(sep) == at:
                            cut[-1]["end"] = end
                        else:
                            cut.append({"start": at, "end": end})
                    else:
                        kept.append(part)
                    at = end + len(sep)
                kept_texts.append(sep.join(kept))
                spans.append(cut)
            kind = pa.list_(pa.struct([pa.field("start", pa.int32()), pa.field("end", pa.int32())]))
            yield [pa.array(kept_texts, pa.string()), pa.array(spans, kind)]

    return each


def remove_repeated_units(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", unit: str = "line", min_words: int = 5, rank: str | None = None,
) -> DataFrame:
    """One row per row of ``df``: doc_id, text, kept_text, removed (spans in characters of the text), n_removed units."""
    doc, body = F.col(doc_id), F.coalesce(F.col(text), F.lit(""))
    order = F.struct(F.col(rank).isNull().alias("none"), F.col(rank).alias("rank")) if rank else F.lit(0)
    rows = df.select(doc.alias("doc_id"), body.alias("text"), order.alias("rank"), *hash_pair("k1", "k2", doc, body, order))
    found = units(rows, unit, min_words)
    place = F.struct("rank", id_order(F.col("doc_id"), F.col("k1"), F.col("k2"), F.col("at")))
    ends = found.groupBy("u1", "u2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = ends.where("first < last").select("u1", "u2", "first")
    later = lookup(found, repeated, ["u1", "u2"], "inner").where(place > F.col("first"))
    gone = later.groupBy("k1", "k2").agg(F.collect_set("at").alias("gone"))
    both = lookup(rows.select("doc_id", "text", "k1", "k2"), gone, ["k1", "k2"]).select("doc_id", "text", "gone")
    cut = with_arrow_columns(both, [("kept_text", T.StringType()), ("removed", T.ArrayType(_SPAN))], _cut(unit))
    return cut.select("doc_id", "text", "kept_text", "removed", F.greatest(F.size("gone"), F.lit(0)).alias("n_removed"))
