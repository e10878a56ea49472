"""Split semi-structured text into labelled sections, inside the row.

The text stays in its row: lines, marks and sections are arrays, so no line is ever
shuffled and a long document costs its own length, not a group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import collapse, lines, strip

# A header line ".NAME...rest", the lines that close a section, the least length kept.
HEADER = r"^\.([A-Z][A-Z0-9 /,&-]*?)\.\.\.(.*)$"
TERMINATORS = ("&&", "$$")
MIN_SECTION_CHARS = 40


def split_sections(
    df: DataFrame, text: str, keep: Sequence[str], header: str = HEADER,
    terminators: Sequence[str] = TERMINATORS, min_chars: int = MIN_SECTION_CHARS, requires: str | None = None,
) -> DataFrame:
    """Rows (kept columns, section_index, section_name, content) in document order.

    A section runs from its header to the next header or terminator; text outside a
    section and sections shorter than ``min_chars`` are dropped, and the index counts
    what is left from 0. ``requires`` is a literal that every header holds (known for the default header):
    only lines with it, or with a terminator, are trimmed and matched at all.
    """
    literal = ("..." if header == HEADER else "") if requires is None else requires

    def mark(line: Column, position: Column) -> Column:
        bare = strip(line)
        opens = F.contains(line, F.lit(literal)) & bare.rlike(header)
        closes = reduce(Column.__or__, [F.contains(line, F.lit(t)) for t in terminators], F.lit(False)) & bare.isin(*terminators)
        return F.struct(position.alias("pos"), opens.alias("opens"), closes.alias("closes"))

    split = df.select(*keep, lines(F.col(text)).alias("_lines"))
    marked = split.select(
        *keep, "_lines",
        F.filter(F.transform("_lines", mark), lambda m: m["opens"] | m["closes"]).alias("_marks"),
    )

    def section(m: Column, k: Column) -> Column:
        following = F.get("_marks", k + 1)["pos"]
        end = F.coalesce(following, F.size("_lines"))
        first = strip(F.get("_lines", m["pos"]))
        body = F.slice("_lines", m["pos"] + 2, F.greatest(end - m["pos"] - 1, F.lit(0)))
        whole = F.concat_ws(" ", F.regexp_extract(first, header, 2), F.array_join(body, " "))
        made = F.struct(strip(F.regexp_extract(first, header, 1)).alias("section_name"), collapse(whole).alias("content"))
        return F.when(m["opens"], made)  # a mark that closes needs no text

    def kept(s: Column) -> Column:
        return s.isNotNull() & (F.length(s["section_name"]) > 0) & (F.length(s["content"]) >= min_chars)

    sections = marked.select(*keep, F.filter(F.transform("_marks", section), kept).alias("_sections"))
    # The outer form keeps the optimizer from copying the array expression into a filter below.
    return (
        sections.select(*keep, F.posexplode_outer("_sections").alias("section_index", "_s"))
        .where(F.col("section_index").isNotNull())
        .select(*keep, "section_index", "_s.section_name", "_s.content")
    )
