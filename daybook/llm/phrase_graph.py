"""Collocations from a weighted de Bruijn graph of four-word edges.

Nodes are three words, an edge is four, its weight how often they stand together. Every word starts one
edge; near the end of a piece the edge has fewer words, so such rows are the corrections for piece ends. How often
fewer words stand together is the flow out of a node: edges added up by their first three words, by their first two, by their first. Runs of nodes with one way in and one way out, both with the node's whole weight, are
compacted into paths; the four-word phrases are read from those.

Before the edges are made, words and pairs of words are counted by 40 bits of their hashes over all texts, then, where all pairs in them
are frequent, phrases of three and four. An edge goes as far as its phrase and all parts of it have ``least``, so no edge starts with a rare
word: no longer phrase can be frequent, and every count from ``least`` on stays exact. The frequent ones are two bitmaps of 8 MB that go to
every task; other phrases that share a slot with them only make edges longer.

Defined results: a NULL text is empty, a NULL group ``und``. Repeated rows all count. An empty table gives no rows. Other columns are not used.
Within a slice of texts words are told apart by 64-bit hashes; everything else compares the words themselves.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.rows import stored
from daybook.llm.tokens import _LOWER, _OF_BYTE, mix, prefix_hashes, slices, span_hashes, text_buffers
from daybook.operators.joins import lookup
from daybook.session import materialise

LEAST = 30
MOST_RANKED = 2_000
#: A longer phrase with this share of a shorter one's occurrences, in percent, stands for it.
ABSORBS = 80
SCORE_UNITS = 2_000_000
#: Bits of a phrase's hash that tell it apart while phrases are counted; the first of them are its slot in the bitmap, the first of
#: those name the part that it is counted in. What is left beside the part makes an item of 32 bits with the count.
KEY_BITS, SLOT_BITS, PART_BITS, COUNT_BITS = 40, 26, 14, 6
COUNT = (1 << COUNT_BITS) - 1
#: Bytes of texts whose edges are counted together before they leave a task, and phrases that are.
SLICE, AT_ONCE = 1 << 20, 1 << 21
WORDS = ("w1", "w2", "w3", "w4")

_BREAK, _GAP = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP[[0x20, 0x09]] = True
_OUTSIDE = _BREAK | _GAP
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """The words of texts i to j, in lower case: hash, start and end, number of the text, and a number per piece that only grows."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray, i: int, j: int):
        self.bytes = part = _LOWER[body[offsets[i]: offsets[j]]]
        at, n = offsets[i: j + 1] - offsets[i], len(part)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = ~_OUTSIDE[part]
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        cut = at[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        first[cut] |= inside[cut + 1]
        last[cut - 1] |= inside[cut]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.hash = span_hashes(prefix_hashes(_OF_BYTE[part]), self.start, self.end)
        self.text = np.searchsorted(at, self.start, side="right") - 1
        self.piece = np.cumsum(_BREAK[part])[self.start] + self.text


def _phrases(p: Pieces, groups: np.ndarray, bitmaps: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each word the hash of the phrase of one, two, three and four words that starts there in its group, and whether the phrase
    stands in one piece and, as far as ``bitmaps`` tell, it and all its parts can be frequent. Each bitmap tells of two sizes."""
    n = len(p.hash)
    ahead = np.concatenate([p.hash, np.zeros(3, dtype=np.uint64)])
    same = np.append(p.piece[:-1] == p.piece[1:], False)
    key, good, out = groups[p.text], np.ones(n, dtype=bool), []
    for k in range(4):
        key = mix(key * _STEP + ahead[k: n + k])
        if k:
            good = good & np.append(good[1:], False) & same
        if k // 2 < len(bitmaps):
            slot = (key >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            good = good & ((bitmaps[k // 2][slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1)
        out.append((key, good))
    return out


def _read(b: pa.RecordBatch, size: int) -> Iterator[tuple[Pieces, np.ndarray, np.ndarray, list[str]]]:
    """Slices of a batch: the pieces, group number and group hash per text, and the names of the groups."""
    body, offsets = text_buffers(b.column("text"))
    coded = b.column("grp").dictionary_encode()
    names, number = coded.dictionary.to_pylist(), np.asarray(coded.indices)
    hashes = mix(np.array([zlib.crc32(g.encode()) + (len(g) << 32) for g in names], dtype=np.uint64))
    for i, j in slices(offsets, size):
        p = Pieces(body, offsets, i, j)
        if len(p.hash):
            yield p, number[i:j], hashes[number[i:j]], names


def _count_phrases(known, least: int):
    """Counts phrases of one and two words or, with a bitmap of those, of three and four, per ``AT_ONCE`` occurrences. A row has the
    phrases of one part of the hashes in 4 bytes each: the rest of the hash and a count up to ``COUNT``, larger ones go on in a further item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        bitmaps = known.value

        def counted():
            key, n = np.unique(np.concatenate(waiting) >> np.uint64(64 - KEY_BITS), return_counts=True)
            waiting.clear()
            n = np.minimum(n, least)  # enough to tell whether the sum is that large
            items = -(-n // COUNT)
            count = np.full(items.sum(), COUNT, dtype=np.uint64)
            count[np.cumsum(items) - 1] = n - COUNT * (items - 1)
            key = np.repeat(key, items)
            part = (key >> np.uint64(KEY_BITS - PART_BITS)).astype(np.int32)
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, dtype=np.int64)
            data = (key << np.uint64(COUNT_BITS) | count).astype("<u4")  # the bits of the part fall off
            offsets = np.append(first, len(part)).astype(np.int32) * 4
            packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            return pa.RecordBatch.from_arrays([pa.array(part[first]), packed], names=["part", "packed"])

        for b in batches:
            for p, _, hashes, _ in _read(b, SLICE):
                waiting += [key[good] for key, good in _phrases(p, hashes, bitmaps)[2 * len(bitmaps):][:2]]
                if sum(map(len, waiting)) >= AT_ONCE:
                    yield counted()
        if waiting:
            yield counted()

    return run


def _frequent(least: int):
    """The slots of the phrases that occur ``least`` times or more, as a bitmap per part. The rows come ordered by part."""
    rest = np.uint64(KEY_BITS - PART_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

        def bitmaps(key: np.ndarray) -> pa.RecordBatch:
            slot = (key >> np.uint64(KEY_BITS - SLOT_BITS)).astype(np.int64)
            part, at = np.unique(slot >> (SLOT_BITS - PART_BITS), return_inverse=True)
            bits = np.zeros((len(part), 1 << (SLOT_BITS - PART_BITS)), dtype=bool)
            bits[at, slot & (bits.shape[1] - 1)] = True
            rows = [r.tobytes() for r in np.packbits(bits, axis=1, bitorder="little")]
            return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(rows, pa.binary())], names=["part", "bits"])

        for b in batches:
            if not b.num_rows:
                continue
            packed, part = b.column("packed").cast(pa.large_binary()), np.asarray(b.column("part")).astype(np.uint64)
            _, offsets, data = packed.buffers()
            at = np.frombuffer(offsets, dtype=np.int64)[packed.offset: packed.offset + len(packed) + 1]
            items = np.frombuffer(data, dtype=np.uint8)[at[0]: at[-1]].view("<u4")
            key = np.concatenate([key, np.repeat(part << rest, np.diff(at) // 4) | (items >> COUNT_BITS)])
            key, of = np.unique(key, return_inverse=True)
            n = np.bincount(of, weights=np.concatenate([n, items & COUNT])).astype(np.int64)
            done = key >> rest < part[-1]
            yield bitmaps(key[done & (n >= least)])
            key, n = key[~done], n[~done]
        yield bitmaps(key[n >= least])

    return run


def frequent_slots(rows: DataFrame, known, least: int = LEAST) -> np.ndarray:
    """A bitmap of the slots of frequent phrases of the two sizes after those in ``known``, a broadcast list of such bitmaps.
    ``rows`` has grp and text."""
    counts = rows.mapInArrow(_count_phrases(known, least), "part int, packed binary")
    found = counts.repartition("part").sortWithinPartitions("part").mapInArrow(_frequent(least), "part int, bits binary").toArrow()
    out, size = np.zeros(1 << (SLOT_BITS - 3), dtype=np.uint8), 1 << (SLOT_BITS - PART_BITS - 3)
    for part, bits in zip(found["part"].to_pylist(), found["bits"].to_pylist()):  # no part twice
        out[part * size: (part + 1) * size] = np.frombuffer(bits, dtype=np.uint8)
    return out


def _strings(p: Pieces, words: np.ndarray) -> pa.Array:
    """The given words as text."""
    start, size = p.start[words], p.end[words] - p.start[words]
    ends = np.concatenate([[0], np.cumsum(size)])
    take = np.repeat(start - ends[:-1], size) + np.arange(ends[-1])
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(p.bytes[take]))


def _count_edges(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = known.value
        for b in batches:
            for p, number, hashes, names in _read(b, SLICE):
                group, key, size = number[p.text], np.zeros(len(p.hash), dtype=np.uint64), np.zeros(len(p.hash), dtype=np.int64)
                for of, good in _phrases(p, hashes, bitmaps):
                    key, size = np.where(good, of, key), size + good
                starts = np.flatnonzero(size)
                _, at, count = np.unique(mix(key[starts] + group[starts].astype(np.uint64)), return_index=True, return_counts=True)
                at, words = starts[at], []
                for k in range(4):
                    has = size[at] > k
                    words.append(_strings(p, at[has] + k).take(pa.array(np.cumsum(has) - 1, mask=~has)))
                phrase = pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string()), null_handling="skip").cast(pa.string())
                seen = np.bincount(group, minlength=len(names))  # all words, under the empty phrase
                some = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([pa.array(names, pa.string()).take(pa.array(group[at])), pa.array(names, pa.string()).take(pa.array(some))]),
                    pa.concat_arrays([phrase, pa.array([""] * len(some), pa.string())]),
                    pa.array(np.concatenate([count, seen[some]]).astype(np.int64))], names=["grp", "phrase", "n"])

    return run


def edges(df: DataFrame, text: str, group: str, least: int = LEAST) -> DataFrame:
    """grp, phrase and n, stored: one row per edge, a phrase of four words or, before the end of a piece or what cannot be frequent, fewer.
    Sums of n from ``least`` on are exact. The empty phrase counts all words."""
    rows = df.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("grp"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    send, bitmaps = df.sparkSession.sparkContext.broadcast, []
    for _ in range(2):
        bitmaps = [*bitmaps, frequent_slots(rows, send(bitmaps), least)]
    found = rows.mapInArrow(_count_edges(send(bitmaps)), "grp string, phrase string, n long")
    return stored(found.groupBy("grp", "phrase").agg(F.sum("n").alias("n")))


def unary_paths(heavy: DataFrame, nodes: DataFrame) -> DataFrame:
    """grp, words and n: the edges of ``heavy``, those joined by nodes with one way in and one way out as one path.

    ``nodes`` (grp, w1 to w3, n) has the whole weight of each node. Each edge finds the head of its path by doubling its reach, so
    rounds grow with the logarithm of the longest path. Edges of a circle without a way in stay single.
    """
    heavy = heavy.withColumn("e", F.xxhash64("grp", *WORDS))
    into = heavy.select("grp", F.col("w2").alias("a"), F.col("w3").alias("b"), F.col("w4").alias("c"), "n", F.col("e").alias("head"))
    out = heavy.select("grp", F.col("w1").alias("a"), F.col("w2").alias("b"), F.col("w3").alias("c"), "n", "e")
    whole = nodes.select("grp", F.col("w1").alias("a"), F.col("w2").alias("b"), F.col("w3").alias("c"), "n")
    joint = ["grp", "a", "b", "c", "n"]  # an edge with a node's whole weight is its only one, so each key has one row a side
    links = into.join(out, joint).join(whole, joint).select("e", "head")
    state = materialise(heavy.select("e").join(links, "e", "left").select(
        "e", F.coalesce("head", "e").alias("head"), F.col("head").isNotNull().cast("int").alias("steps")))
    for _ in range(2 + math.ceil(math.log2(1 + state.count()))):
        ahead = state.select(F.col("e").alias("head"), F.col("head").alias("next"), F.col("steps").alias("more"))
        state = materialise(lookup(state, ahead, ["head"], "inner").select(
            "e", F.col("next").alias("head"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved")))
        if state.where("moved").isEmpty():
            break
    ends = state.select("e", F.when(~F.col("moved"), F.col("head")).otherwise(F.col("e")).alias("head"),
                        F.when(~F.col("moved"), F.col("steps")).otherwise(0).alias("steps"))
    placed = heavy.join(ends, "e")
    items = F.array_sort(F.collect_list(F.struct("steps", *WORDS)))
    return placed.groupBy("head", "grp", "n").agg(items.alias("items")).select(
        "grp", F.concat(F.array(*[F.col("items")[0][w] for w in WORDS[:3]]), F.transform("items", lambda i: i["w4"])).alias("words"), "n")


def phrase_counts(found: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """The phrases of one to four words that occur ``least`` times or more (grp, k, phrase, n), and the compacted paths."""
    size = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1

    def flow(k: int) -> DataFrame:
        """Edges added up by their first k words."""
        begin = found.where((F.col("phrase") != "") & (size >= k)).groupBy("grp", F.substring_index("phrase", " ", k).alias("phrase"))
        return begin.agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("grp", F.lit(k).alias("k"), "phrase", "n")

    def split(phrases: DataFrame, k: int) -> DataFrame:
        words = F.split("phrase", " ")
        return phrases.select("grp", *[words[i].alias(WORDS[i]) for i in range(k)], "n")

    three = stored(flow(3))
    paths = stored(unary_paths(split(found.where((size == 4) & (F.col("n") >= least)), 4), split(three, 3)))
    start = F.explode(F.sequence(F.lit(1), F.size("words") - 3)).alias("at")
    fours = paths.select("grp", "words", "n", start).select("grp", F.lit(4).alias("k"), F.array_join(F.slice("words", F.col("at"), F.lit(4)), " ").alias("phrase"), "n")
    return stored(flow(1).unionByName(flow(2)).unionByName(three).unionByName(fours)), paths


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def scored_phrases(counts: DataFrame) -> DataFrame:
    """grp, phrase, a, l, r, score of the phrases of two words and more that no longer one stands for."""
    known = counts.select("grp", "phrase", "n")
    several = counts.where("k > 1").select("grp", "k", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cut = several.select("grp", "phrase", "a", "words", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cut = cut.select("grp", "phrase", "a", "cut", _part(F.col("words"), F.lit(1), F.col("cut")).alias("left"),
                     _part(F.col("words"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    cut = lookup(cut, known.select("grp", F.col("phrase").alias("left"), F.col("n").alias("l")), ["grp", "left"], "inner")
    cut = lookup(cut, known.select("grp", F.col("phrase").alias("right"), F.col("n").alias("r")), ["grp", "right"], "inner")
    exact = "CAST(CAST({} AS DECIMAL(20, 0)) * CAST({} AS DECIMAL(12, 0)) AS DECIMAL(38, 0))"
    score = F.expr(f"{exact.format('a', SCORE_UNITS)} DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    lowest = cut.withColumn("score", score).groupBy("grp", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))

    longer = several.where("k > 2").select("grp", "words", "k", F.col("a").alias("most"), F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inside = longer.select("grp", "most", "words", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    inside = inside.groupBy("grp", _part(F.col("words"), F.col("at"), F.col("size")).alias("phrase")).agg(F.max("most").alias("most"))
    told = lookup(lowest, inside, ["grp", "phrase"])
    stands = F.expr(f"{exact.format('most', 100)} >= {exact.format('a', ABSORBS)}")
    return told.where(F.col("most").isNull() | ~stands).select("grp", "phrase", "a", "m.l", "m.r", "m.score")


def collocations(df: DataFrame, text: str = "text", group: str = "lang", least: int = LEAST, most: int = MOST_RANKED) -> DataFrame:
    """The first ``most`` phrases of each group: grp, rank, phrase, a, l, r, n, score."""
    found = edges(df, text, group, least)
    words = found.where("phrase = ''").select("grp", "n")
    order = Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored_phrases(phrase_counts(found, least)[0]).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
    return lookup(best, words, ["grp"]).select("grp", "rank", "phrase", "a", "l", "r", "n", "score")
