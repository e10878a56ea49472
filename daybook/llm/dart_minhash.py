"""Near duplicates by DartMinHash signatures, banded into a join.

A text is a weighted set of shingles of five words. Darts of a Poisson process, made by hashing, fall
on each element's region of weight and rank; every dart belongs to one of K coordinates, and
a coordinate keeps its earliest dart. Two sets agree in a coordinate with the probability of their weighted
Jaccard similarity. Only about K ln K + 2 K darts are thrown per set, however large it is.

Texts that agree in all coordinates of a band meet in a bucket. Buckets with texts in common are one block, and within it the
links are checked on the shingles themselves: the sets of a block are joined by tries, which compare many at once and leave out
what is of one class already; a block too large for one task is dealt into parts. So no pairs are made of a bucket, and
the number of rounds does not grow with it. Connected links are a class. A pair of similarity 0.8 meets in some
band with a probability of 0.998, one of 0.85 with 0.9999 (20 bands of 6); texts that meet by way of others are checked too.

Words are those of the decontamination operator. Defined results: a text of fewer than five words is one
shingle; a text without words is near only to texts equal to it; a NULL text counts as empty. Rows
with equal texts are one class. The row with the smallest id stays (NULL ids last; of rows that
agree in id and text one). Other columns are carried along by ``drop_near_copies`` and ignored by ``near_classes``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.components import components
from daybook.llm.exact_dedup import filter_bits, repeated_slots, with_possible
from daybook.llm.rows import hash_pair, id_order, quoted, stored, with_arrow_columns
from daybook.llm.tokens import Words, mix, shingles, slices, text_buffers
from daybook.llm.trie_join import spanning_links
from daybook.operators.joins import lookup
from daybook.session import materialise

SIMILARITY = 0.8
BANDS, ROWS = 20, 6
COORDINATES = BANDS * ROWS
#: Texts whose darts are thrown together.
AT_ONCE = 512


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1] from 64 hashed bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def _throw(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, rank and hash of the darts up to rank ``reach[owner]`` that fall below the elements' weights.

    Weights are cut into bands [2^v - 1, 2^(v+1) - 1). In each band of each element, darts arrive with
    exponential gaps made from hashes, so two sets see the same darts wherever their regions overlap.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    band = 0
    while len(owner):
        low, width = 2.0**band - 1, 2.0**band
        has = weight > low
        owner, element, weight = owner[has], element[has], weight[has]
        o, w, rank = owner, weight, np.zeros(len(owner))
        state = mix(element + np.uint64(band * 0x51_7C_C1))
        while len(o):
            state = mix(state + np.uint64(0x632BE59BD9B4E019))
            rank = rank - np.log(_unit(state)) / width
            near = rank < reach[o]
            o, w, rank, state = o[near], w[near], rank[near], state[near]
            hit = low + width * _unit(mix(state ^ np.uint64(0xA5A5A5A5))) <= w
            found.append((o[hit], rank[hit], state[hit]))
        band += 1
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.uint64)
    return tuple(np.concatenate(part) for part in zip(*found))


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int = COORDINATES) -> np.ndarray:
    """n x k dart hashes. ``owner`` (0 to n - 1) is ascending; a set without weight has zeros."""
    out = np.zeros((n, k), dtype=np.uint64)
    total = np.bincount(owner, weights=weight, minlength=n)
    waiting = total > 0
    darts = k * np.log(k) + 2 * k
    while waiting.any():
        mine = waiting[owner]
        who, rank, dart = _throw(owner[mine], element[mine], weight[mine].astype(float), darts / np.maximum(total, 1e-300))
        place = (mix(dart + np.uint64(99)) % np.uint64(k)).astype(np.int64) + who * k
        late_first = np.argsort(-rank, kind="stable")
        seen, early = np.zeros(n * k, dtype=bool), np.zeros(n * k, dtype=np.uint64)
        seen[place] = True
        early[place[late_first]] = dart[late_first]  # the last one written, the earliest dart, stays
        full = waiting & seen.reshape(n, k).all(axis=1)
        out[full] = early.reshape(n, k)[full]
        waiting &= ~full
        darts *= 2  # the few sets with an empty coordinate get more darts; the earlier ones stay the same
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    keys = np.zeros((len(signature), bands), dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
    for i in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + signature[:, i * bands: (i + 1) * bands])
    return keys


_FIELDS = [("bands", T.ArrayType(T.LongType())), ("shingles", T.ArrayType(T.IntegerType()))]


def with_signatures(df: DataFrame, text: str, weights: str = "distinct", drop: Sequence[str] = ()) -> DataFrame:
    """``df`` with its band keys (none without words) and its shingles as 32-bit hashes, and without the columns ``drop``.

    ``weights``: ``distinct`` gives every shingle weight 1, ``count`` the number of its occurrences.
    """
    def lists(parts, ends, kind, of):
        values = np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(values.view(of)))

    def signed(b: pa.RecordBatch) -> list[pa.Array]:
        body, offsets = text_buffers(b.column(text))
        keys, key_ends, sets, set_ends = [], [np.zeros(1, dtype=np.int64)], [], [np.zeros(1, dtype=np.int64)]
        for i, j in slices(offsets):
            for k in range(i, j, AT_ONCE):
                words = Words(body, offsets, k, min(j, k + AT_ONCE))
                owner, element, count = shingles(words)
                weight = count if weights == "count" else np.ones(len(count))
                size = np.bincount(owner, minlength=words.n_texts)
                found = band_keys(signatures(owner, element, weight, words.n_texts))
                keys.append(found[size > 0].ravel())
                key_ends.append(key_ends[-1][-1] + np.cumsum((size > 0) * BANDS))
                sets.append((element >> np.uint64(32)).astype(np.uint32))
                set_ends.append(set_ends[-1][-1] + np.cumsum(size))
        return [lists(keys, key_ends, np.uint64, np.int64), lists(sets, set_ends, np.uint32, np.int32)]

    return with_arrow_columns(df, _FIELDS, lambda batches: map(signed, batches), drop)


def _filtered(rows: DataFrame, of: DataFrame, column: str, least: int, per_row: int) -> DataFrame:
    """The rows whose value probably occurs at least ``least`` times in ``of``, by a Bloom filter of bounded size; no other
    value is missed, so a join behind it is as before but moves less."""
    bits = filter_bits(of.count(), per_row)
    slots = materialise(repeated_slots(of, bits, column, 1, least))
    return with_possible(rows, slots, bits, column, 1).where("possible").drop("possible")


def near_components(signed: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """node and root of the classes of keys; ``signed`` has key, n (distinct shingles), bands and shingles, repeated keys allowed."""
    every = signed.select("key", F.explode("bands").alias("band"))
    met = stored(_filtered(every, every.select("band"), "band", 2, per_row=8).distinct())
    centre = met.groupBy("band").agg(F.min("key").alias("b"), F.max("key").alias("c")).where("b < c").select("band", "b")
    blocks = stored(components(lookup(met, centre, ["band"], "inner").where("key <> b").select(F.col("key").alias("a"), "b").distinct()))
    block = blocks.unionByName(blocks.select(F.col("root").alias("node"), "root").distinct()).select(
        F.col("node").alias("key"), F.col("root").alias("block"))
    some = _filtered(signed.select("key", "n", "shingles"), block.select("key"), "key", 1, per_row=64)
    once = some.groupBy("key").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    sets = stored(lookup(once, block, ["key"], "inner").select("block", "key", "n", F.array_distinct("shingles").alias("shingles")))
    return components(spanning_links(sets, percent=round(100 * similarity)))


def _keyed(df: DataFrame, text: str, doc_id: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.struct(*hash_pair("k1", "k2", body)).alias("key"))


def _roots(df: DataFrame, text: str, doc_id: str, similarity: float, weights: str) -> DataFrame:
    """doc_id, key and root: the key that stands for the document's class."""
    signed = with_signatures(_keyed(df, text, doc_id), "text", weights, drop=["text"])
    signed = stored(signed.withColumn("n", F.size(F.array_distinct("shingles"))))
    found = near_components(signed.select("key", "n", "bands", "shingles"), similarity)
    return lookup(signed.select("doc_id", "key"), found.select(F.col("node").alias("key"), "root"), ["key"]).select(
        "doc_id", "key", F.coalesce("root", "key").alias("root"))


def near_classes(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY, weights: str = "distinct",
) -> DataFrame:
    """One row per row of ``df``: doc_id, class_id (the smallest id of its class), class_size, kept."""
    rows = _roots(df, text, doc_id, similarity, weights).groupBy("root", "key", "doc_id").agg(F.count("*").alias("copies"))
    order = id_order(F.col("doc_id"), F.col("key"))
    first = rows.groupBy("root").agg(F.min(order).alias("first"), F.sum("copies").alias("class_size"))
    each = lookup(rows, first, ["root"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select("doc_id", F.col("first.id").alias("class_id"), "class_size",
                       ((order == F.col("first")) & (F.col("copy") == 1)).alias("kept"))


def drop_near_copies(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY, weights: str = "distinct",
) -> DataFrame:
    """The rows of ``df`` that stay, one per class, with all their columns."""
    rows = _roots(df, text, doc_id, similarity, weights).groupBy("root", "key", "doc_id").agg(F.count("*").alias("copies"))
    order = id_order(F.col("doc_id"), F.col("key"), F.col("copies"))
    first = rows.groupBy("root").agg(F.min(order).alias("first"))
    winners = stored(first.select(F.struct(
        F.col("first.no_id").alias("n"), F.coalesce("first.id", F.lit(0)).alias("i"), F.col("first.key").alias("k")).alias("who"),
        F.col("first.copies").alias("copies")))
    body = F.coalesce(F.col(text), F.lit(""))
    who = F.struct(F.col(doc_id).isNull().alias("n"), F.coalesce(F.col(doc_id), F.lit(0)).alias("i"),
                   F.struct(*hash_pair("k1", "k2", body)).alias("k"))
    at = next(n for n in ("who" + "_" * i for i in range(len(df.columns) + 1)) if n not in df.columns)
    large, winners = df.withColumn(at, who), winners.withColumnRenamed("who", at)
    single = lookup(large, winners.where("copies = 1").select(at), [at], "left_semi").drop(at)
    # rows that agree in id and text: one of them
    several = lookup(large, winners.where("copies > 1").select(at), [at], "left_semi")
    row = F.struct(*[quoted(c) for c in df.columns])
    return single.unionByName(several.groupBy(at).agg(F.min_by(row, F.xxhash64(row)).alias("row")).select("row.*"))
