"""Long repeated substrings, found with run-compressed Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else too. One index over a corpus does not fit a
task, so the corpus is dealt out by content first: every window of ``length`` bytes has an anchor (see
``anchors``), equal windows have equal anchors, and so the surroundings of equal anchors form a small, highly repetitive collection that
is indexed on its own. Surroundings that are equal as a whole are known to repeat from their hashes, and go in once.

The index of a collection is its Burrows-Wheeler transform, made one column at a time to the left of the anchor.
A column is kept as runs of equal bytes; moving one byte to the left moves whole runs, and inside a run the neighbours and
their common lengths stay as they are. Only at run ends is a length looked up again (the samples). So the longest match of
every suffix with any other one (its matching statistics) streams along, and where it reaches
``length`` the window repeats.

Anchors with more than ``HOT`` different surroundings are split by the windows' own 128-bit hashes instead, as no
collection may grow without bound.

Defined results: a NULL text is empty, one below ``length`` bytes keeps all. Repeated rows are copies like any other:
each loses what the other also has. Columns other than id and text are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.anchors import GRAM, anchors
from daybook.llm.exact_dedup import filter_bits, repeated_slots, with_possible
from daybook.llm.rows import hash_pair, stored
from daybook.llm.tokens import _OF_BYTE, mix, prefix_hashes, slices, span_hashes, text_buffers
from daybook.operators.joins import lookup
from daybook.session import materialise

LENGTH = 200
#: Different surroundings of one anchor that one index takes.
HOT = 20_000
#: Surroundings that are indexed together.
AT_ONCE = 8_000
_SLICE = 1 << 18
#: Rows of an Arrow batch that goes back to Spark.
_BACK = 1_024


# ---- the index of one collection ----------------------------------------------------------


class _Least:
    """Minimum of any range, from minima of ranges of 2^k."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 * (step := 1 << (len(self.levels) - 1)) <= len(values):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-step], below[step:]))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Over start to end - 1; start < end."""
        level = np.frexp((end - start).astype(float))[1] - 1
        out = np.zeros(len(start), dtype=self.levels[0].dtype)
        for k in np.unique(level):
            mine = level == k
            out[mine] = np.minimum(self.levels[k][start[mine]], self.levels[k][end[mine] - (1 << k)])
        return out


def repeated_starts(group: np.ndarray, left: np.ndarray, left_size: np.ndarray, right: np.ndarray, right_size: np.ndarray, length: int):
    """Per string the nearest and farthest start before the anchor from which ``length`` bytes occur in another one of its group.

    ``left`` has the bytes before the anchor, nearest first; ``right`` those from it on. Without such a start: length and -1.
    """
    m = len(group)
    near, far = np.full(m, length), np.full(m, -1)
    if m < 2:
        return near, far
    words = np.ascontiguousarray(np.pad(right, ((0, 0), (0, -right.shape[1] % 8)))).view(">u8")
    order = np.lexsort([right_size, *words.T[::-1], group])
    a, b = order[:-1], order[1:]
    differs = right[a] != right[b]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), right.shape[1])
    common = np.where(group[a] == group[b], np.minimum(common, np.minimum(right_size[a], right_size[b])), -1).astype(np.int16)
    least = _Least(common)
    rank = np.empty(m, dtype=np.int64)
    rank[order] = np.arange(m)
    match = common.copy()  # common length, from the anchor on, of neighbours with the same group and left side; else -1
    for step in range(left.shape[1] + 1):
        hit = np.flatnonzero(match >= length - step)
        if len(hit):
            for who in (order[hit], order[hit + 1]):
                near[who] = np.minimum(near[who], step)
                far[who] = step
        if step == left.shape[1]:
            break
        # one byte to the left: this column of the transform, as runs
        goes_on = left_size[order] > step
        if not goes_on.all():
            order, match = _thin(order, match, goes_on, least, rank)
        if len(order) < 2:
            break
        byte = left[order, step]
        same = match >= 0
        starts = np.flatnonzero(np.concatenate([[True], ~same | (byte[1:] != byte[:-1])]))
        if not (same[starts[1:] - 1]).any():
            continue  # all runs are whole classes: neighbours stay
        klass = np.cumsum(np.concatenate([[0], ~same]))[starts]
        sizes = np.diff(np.append(starts, len(order)))
        moved = np.argsort(klass * 256 + byte[starts], kind="stable")
        begin = np.concatenate([[0], np.cumsum(sizes[moved])])
        source = np.repeat(starts[moved] - begin[:-1], sizes[moved]) + np.arange(len(order))
        key = (klass * 256 + byte[starts])[moved]
        order, old = order[source], np.append(match, np.int16(-1))[source][:-1]
        # the ends of runs are the only places with new neighbours
        ends = begin[1:-1] - 1
        together = key[1:] == key[:-1]
        old[ends] = -1
        e = ends[together]
        old[e] = least(rank[order[e]], rank[order[e + 1]])
        match = old
    return near, far


def _thin(order, match, keep, least, rank):
    """Leave out the strings whose left side ends here; those that then meet get their common length."""
    at = np.flatnonzero(keep)
    breaks = np.concatenate([[0], np.cumsum(match < 0)])  # classes, by position
    order = order[at]
    new = np.full(max(0, len(at) - 1), -1, dtype=np.int16)
    together = np.flatnonzero(breaks[at[1:]] == breaks[at[:-1]])
    new[together] = least(rank[order[together]], rank[order[together + 1]])
    return order, new


# ---- the parts of the job that run on Arrow batches ------------------------------------------


_OCCURRENCES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
    T.StructField("a", T.ArrayType(T.LongType())), T.StructField("c", T.ArrayType(T.LongType())),
    T.StructField("pos", T.ArrayType(T.IntegerType())), T.StructField("far", T.ArrayType(T.ShortType())),
    T.StructField("near", T.ArrayType(T.ShortType())),
])


def _find_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body, offsets = text_buffers(b.column("text"))
            for i, j in slices(offsets, _SLICE):
                text, *values = anchors(body, offsets[i: j + 1], length)
                order = np.argsort(text, kind="stable")
                ends = pa.array(np.searchsorted(text[order], np.arange(j - i + 1)).astype(np.int32))
                place, a, c, far, near = (v[order] for v in values)
                lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (
                    a.view(np.int64), c.view(np.int64), place.astype(np.int32), far.astype(np.int16), near.astype(np.int16))]
                keys = [b.column(n).slice(i, j - i) for n in ("doc_id", "k1", "k2")]
                yield pa.RecordBatch.from_arrays(keys + lists, names=_OCCURRENCES.names)

    return run


_PACKED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()),
    T.StructField("z", T.BinaryType()),
])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, _BACK):
            yield b.slice(i, _BACK)


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, as they are to be shuffled."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for b in _parts(batches):
        body, offsets = text_buffers(b.column("text"))
        z = [squeeze(body[i:j].data) for i, j in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "k1", "k2")] + [pa.array(z, pa.binary())], names=_PACKED.names)


_CONTEXTS = T.StructType([
    T.StructField("a", T.LongType()), T.StructField("c", T.LongType()), T.StructField("far", T.ShortType()),
    T.StructField("near", T.ShortType()), T.StructField("bytes", T.BinaryType()),
])
_ROWS = 4_000


def _cut_contexts(length: int):
    """The bytes around the anchors that are wanted from a text; of equal texts one row, its holder, gives them."""
    def batch(columns: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_CONTEXTS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        columns: list[list] = [[], [], [], [], []]
        last = None
        for b in batches:
            keys = zip(b.column("k1").to_pylist(), b.column("k2").to_pylist())
            for key, doc, holder, z, wanted in zip(keys, b.column("doc_id"), b.column("holder"), b.column("z"), b.column("wanted")):
                if doc != holder or key == last:  # rows that agree in id and text come one after the other
                    continue
                last = key
                text = unpack(z.as_py())
                v = wanted.values
                a, c, far, near, pos = (v.field(n).to_pylist() for n in ("a", "c", "far", "near", "pos"))
                for column, values in zip(columns, (a, c, far, near)):
                    column += values
                columns[4] += [text[p - f: p - n + length] for p, f, n in zip(pos, far, near)]
                if len(columns[0]) >= _ROWS:
                    yield batch(columns)
                    columns = [[], [], [], [], []]
        if columns[0]:
            yield batch(columns)

    return run


_MARKS = T.StructType([
    T.StructField("a", T.LongType()), T.StructField("c", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
])


def _index(length: int):
    """Rows sorted by anchor to marks; whole anchors are indexed together, about AT_ONCE rows at a time."""
    def marks(rows: pa.Table) -> pa.RecordBatch:
        a, c = (rows.column(n).to_numpy() for n in ("a", "c"))
        order = np.lexsort((c, a))
        once = order[np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (c[order][1:] != c[order][:-1])])]
        if len(once) < len(a):  # rows that agree in id and text
            rows = rows.take(pa.array(once))
            a, c = a[once], c[once]
        far, near = (rows.column(n).to_numpy().astype(np.int64) for n in ("far", "near"))
        body, at = text_buffers(rows.column("bytes").combine_chunks())
        left, right = _sides(body, at, far, length)
        low, high = repeated_starts(a, left, far, right, length - near, length)
        found = high >= 0
        return pa.RecordBatch.from_arrays([
            pa.array(a[found]), pa.array(c[found]), pa.array((-high[found]).astype(np.int32)), pa.array((length - low[found]).astype(np.int32)),
        ], names=_MARKS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for b in batches:
            held.append(b)
            count += b.num_rows
            if count >= AT_ONCE:
                rows = pa.Table.from_batches(held)
                a = rows.column("a").to_numpy()
                cut = int(np.searchsorted(a, a[-1]))  # the last anchor may go on
                if cut:
                    yield marks(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
                count = len(a) - cut
        if count:
            yield marks(pa.Table.from_batches(held))

    return run


def _sides(body: np.ndarray, at: np.ndarray, far: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes before each anchor, nearest first, and those from it on; beyond the ends zeros."""
    n, width = len(far), length - GRAM
    padded = np.concatenate([np.zeros(width, dtype=np.uint8), body, np.zeros(length, dtype=np.uint8)])
    anchor = at[:-1] + far + width
    step = np.arange(width)
    left = padded[anchor[:, None] - 1 - step] if n else np.zeros((0, width), dtype=np.uint8)
    left[step >= far[:, None]] = 0
    ahead = np.arange(length)
    right = padded[anchor[:, None] + ahead] if n else np.zeros((0, length), dtype=np.uint8)
    right[ahead >= (at[1:] + width - anchor)[:, None]] = 0
    return left, right


_WINDOWS = T.StructType([
    T.StructField("a", T.LongType()), T.StructField("c", T.LongType()), T.StructField("w1", T.LongType()), T.StructField("w2", T.LongType()),
    T.StructField("before", T.IntegerType()),
])


def _window_hashes(length: int):
    """Every window of the surroundings of hot anchors by its own hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            body, at = text_buffers(b.column("bytes"))
            far, near = (b.column(n).to_numpy().astype(np.int64) for n in ("far", "near"))
            for i in range(0, b.num_rows, 2_000):
                j = min(b.num_rows, i + 2_000)
                part, base = body[at[i]: at[j]], at[i]
                size = far[i:j] - near[i:j] + 1
                row = np.repeat(np.arange(i, j), size)
                shift = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                start = at[row] - base + shift
                w = [span_hashes(prefix_hashes(t[part]), start, start + length).view(np.int64) for t in (_OF_BYTE, _OTHER)]
                yield pa.RecordBatch.from_arrays([
                    b.column("a").take(pa.array(row)), b.column("c").take(pa.array(row)), pa.array(w[0]), pa.array(w[1]),
                    pa.array((far[row] - shift).astype(np.int32))], names=_WINDOWS.names)

    return run


_OTHER = mix(np.arange(256, dtype=np.uint64) + np.uint64(1_234_567))

_KEPT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("kept", T.BinaryType()), T.StructField("removed", T.ArrayType(
        T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])
_SPANS = pa.list_(pa.struct([pa.field("start", pa.int64()), pa.field("end", pa.int64())]))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for b in _parts(batches):
        sizes, gone, kept, spans = [], [], [], []
        lists = b.column("spans")
        for i, z in enumerate(b.column("z")):
            text = unpack(z.as_py())
            own, parts, at, cut = lists[i].values, [], 0, []
            if own is not None and len(own):
                starts, ends = merged(*(own.field(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("start", "end")))
                for s, e in zip(starts.tolist(), ends.tolist()):
                    parts.append(text[at:s])
                    cut.append({"start": s, "end": e})
                    at = e
            rest = b"".join(parts) + text[at:] if parts else text
            sizes.append(len(text))
            gone.append(len(text) - len(rest))
            kept.append(rest)
            spans.append(cut)
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()),
            pa.array(spans, _SPANS)], names=_KEPT.names)


# ---- the job -----------------------------------------------------------------------------------


def _marks(cold: DataFrame, hot: DataFrame, length: int) -> DataFrame:
    """a, c, start, end: what repeats around an anchor in surroundings of more than one kind."""
    dealt = cold.repartition("a").sortWithinPartitions("a").mapInArrow(_index(length), _MARKS)
    windows = hot.mapInArrow(_window_hashes(length), _WINDOWS).distinct()
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2")
    split = lookup(windows, twice, ["w1", "w2"], "left_semi").groupBy("a", "c").agg(
        (-F.max("before")).cast("int").alias("start"), (F.lit(length) - F.min("before")).cast("int").alias("end"))
    return dealt.unionByName(split)


def remove_long_repeats(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH,
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_bytes, n_removed, kept (the bytes that are left), removed (spans of bytes)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), *hash_pair("k1", "k2", body))
    found = stored(rows.select("doc_id", "k1", "k2", "text").mapInArrow(_find_anchors(length), _OCCURRENCES))

    anchor = found.select(F.explode("a").alias("a"))
    bits = filter_bits(found.agg(F.sum(F.size("a"))).first()[0] or 0, per_row=8)
    slots = materialise(repeated_slots(anchor, bits, "a", 1))
    places = found.select("doc_id", "k1", "k2", F.explode(F.arrays_zip("a", "c", "pos", "far", "near")).alias("p")).select("doc_id", "k1", "k2", "p.*")
    # occurrences of anchors that probably repeat; the few others do no harm
    maybe = with_possible(places, slots, bits, "a", 1).where("possible").drop("possible")

    whole = maybe.groupBy("a", "c", "far", "near").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "pos", "doc_id")).alias("at"))
    whole = stored(whole)
    kinds = whole.groupBy("a").agg(F.count("*").alias("kinds")).where("kinds > 1")
    mixed = lookup(whole, kinds, ["a"], "inner")
    packed = rows.mapInArrow(_squeeze, _PACKED)

    def contexts(chosen: DataFrame) -> DataFrame:
        wanted = chosen.groupBy(F.col("at.k1").alias("k1"), F.col("at.k2").alias("k2"), F.col("at.doc_id").alias("holder")).agg(
            F.collect_list(F.struct("a", "c", "far", "near", F.col("at.pos").alias("pos"))).alias("wanted"))
        once = lookup(packed, wanted, ["k1", "k2"], "inner")
        return once.select("doc_id", "k1", "k2", "z", "holder", "wanted").mapInArrow(_cut_contexts(length), _CONTEXTS)

    marks = _marks(contexts(mixed.where(F.col("kinds") <= HOT)), contexts(mixed.where(F.col("kinds") > HOT)), length)
    full = whole.where("n > 1").select("a", "c", (-F.col("far")).cast("int").alias("start"), (F.lit(length) - F.col("near")).cast("int").alias("end"))
    marks = full.unionByName(lookup(marks, full.select("a", "c"), ["a", "c"], "left_anti"))

    spans = lookup(maybe.select("a", "c", "k1", "k2", "pos"), marks, ["a", "c"], "inner").groupBy("k1", "k2").agg(
        # a set, as all copies of a text have the same spans
        F.collect_set(F.struct((F.col("pos") + F.col("start")).alias("start"), (F.col("pos") + F.col("end")).alias("end"))).alias("spans"))
    return lookup(packed, spans, ["k1", "k2"]).select("doc_id", "k1", "k2", "z", "spans").mapInArrow(_remove, _KEPT)
