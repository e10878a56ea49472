"""Text expressions: all native Columns, evaluated inside the scan stage."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space (the Unicode property plus the ASCII separators),
# as a pattern and as a set of characters, and what ends a line.
WHITESPACE = r"(?U)[\s\x1C-\x1F]+"
WHITESPACE_CHARACTERS = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x85\u2028\u2029]"
OTHER_LINE_ENDS = "\x0b\f\r\x1c\x1d\x1e\x85\u2028\u2029"

# Words that carry no meaning in a search.
STOPWORDS = (
    "a", "an", "and", "the", "of", "in", "on", "for", "to", "is", "by", "with", "what", "which", "where", "data",
)


# Fixed value: what a word of a search is, in lower-case text.
TOKEN = "[a-z0-9_]+"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE_CHARACTERS))


def collapse(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(c, WHITESPACE, " "))


def lines(c: Column) -> Column:
    """The lines of a text. Substring tests find the texts with nothing but ``\\n`` as line end,
    which is nearly all of them, and those take the plain split."""
    other = reduce(Column.__or__, [F.contains(c, F.lit(x)) for x in OTHER_LINE_ENDS])
    return F.when(other, F.split(c, LINE_BREAK)).otherwise(F.split(c, "\n"))


def normalise(c: Column) -> Column:
    return collapse(F.lower(c))


def stands_in(evidence: Column, normalised_source: Column) -> Column:
    """True where the quote stands in a source that was normalised once for several quotes."""
    quote = normalise(evidence)
    return (F.length(quote) > 0) & F.contains(normalised_source, quote)


def is_verbatim(evidence: Column, source: Column) -> Column:
    """True where the quote stands in the source, ignoring case and spacing; an empty quote never does."""
    return stands_in(evidence, normalise(source))


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    """Every distinct match of the pattern, in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(group)))


def terms(c: Column) -> Column:
    """Lower-case word tokens without stopwords, repeats kept."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit(f"({TOKEN})"), F.lit(1))
    return F.filter(tokens, lambda t: ~t.isin(*STOPWORDS))


def terms_of(text: str) -> list[str]:
    """The same for one string on the driver, such as a query."""
    return list(filter(lambda word: word not in STOPWORDS, re.compile(TOKEN).findall(text.lower())))


def any_of(words: list[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def _starts_word(c: Column, word: str) -> Column:
    """The literal comes first and its left side is checked after, so the search can skip ahead;
    a plain substring test keeps the pattern away from texts without the word."""
    literal = re.escape(word).replace("\\ ", "[ _]")
    at_start = c.rlike(f"{literal}(?<![a-z0-9]{literal})")
    return at_start if " " in word else F.contains(c, F.lit(word)) & at_start


def word_start(c: Column, words: list[str]) -> Column:
    """True where any word stands at the start of a word.

    ``_`` separates words like a space, so a word that holds one is found nowhere.
    """
    hits = [_starts_word(c, w) for w in words if "_" not in w]
    return reduce(Column.__or__, hits) if hits else F.lit(False)


def snippet(c: Column, limit: int = 180) -> Column:
    """The text, or its first ``limit`` characters cut back to the last space."""
    head = F.regexp_replace(F.substring(c, 1, limit), r" [^ ]*\z", "")
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(head, F.lit(" ...")))


def highlight(c: Column, words: list[str]) -> Column:
    """Mark every word that starts with one of the given words, whatever its case."""
    if not words:
        return c
    return F.regexp_replace(c, rf"(?i)(?<![A-Za-z0-9_])((?:{any_of(words)})[A-Za-z0-9]*)", "**$1**")


def clip(c: Column, limit: int = 120) -> Column:
    """Preview form of a long string."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("..."))).otherwise(c)


def labelled(name: Column, content: Column) -> Column:
    """The text handed to an embedding function for one section."""
    return F.concat_ws(": ", name, content)
