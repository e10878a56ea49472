"""Passages of benchmark items in documents, found by streaming words through a suffix automaton.

Words are maximal runs of digits, letters and non-ASCII characters, A-Z lowered. A window is
``WIDTH`` consecutive words of an item, or a whole shorter item. Every document word inside an
occurrence of a window is hit. Documents never shuffle: the items go along with the tasks, in
blocks of bounded size; of a document only runs of words that occur in the items, as long as the
shortest window, go through the automaton.

Defined results: a NULL or empty text has no words and is clean; a NULL item text gives no window;
NULL item ids are left out of the list of items but their windows hit. Repeated rows are each judged.
Columns of the documents are kept; one with a result's name is replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import with_arrow_columns
from daybook.llm.suffix_automaton import WindowAutomaton
from daybook.llm.tokens import Words, slices, text_buffers

WIDTH = 13
#: Words of the items in one automaton, and automata's items sent along with one pass: 64 MB of hashes at most.
#: A larger set takes further passes over the documents, which add to what the earlier ones found.
BLOCK_WORDS, PASS_BLOCKS = 200_000, 40
#: Contaminated: at least one hit word in twenty.
SHARE = 20

_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
RESULTS = [
    ("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()), ("items_sha256", T.StringType()),
    ("contaminated", T.BooleanType()), ("hit_words", T.ArrayType(_SPAN)), ("item_ids", T.ArrayType(T.StringType())),
]
_SPANS = pa.list_(pa.struct([pa.field("start", pa.int32()), pa.field("end", pa.int32())]))


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    if not texts:
        return []
    body, offsets = text_buffers(pa.array(texts, pa.string()))
    w = Words(body, offsets, 0, len(texts))
    return [w.hash[a:b] for a, b in zip(w.first_word[:-1], w.first_word[1:])]


class Detector:
    """The automaton of a block of items, with the vocabulary that maps word hashes to symbols."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], width: int = WIDTH):
        used = [h for _, h in items if len(h)]
        self.vocabulary = np.unique(np.concatenate(used)) if used else np.zeros(0, dtype=np.uint64)
        self.windows = WindowAutomaton(
            [(i, np.searchsorted(self.vocabulary, h).tolist()) for i, h in items if len(h)], width)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """The symbol of each word, -1 for words that no item has."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def hits(self, words: Words) -> tuple[np.ndarray, dict[int, set]]:
        """Change of cover at each word (its running sum is positive where a word is hit), and items by text."""
        cover, items = np.zeros(len(words.hash) + 1, dtype=np.int64), {}
        known = self.symbols(words.hash)
        inside = np.concatenate([[False], known >= 0, [False]])
        begins = inside[1:] & ~inside[:-1]
        ends = inside[:-1] & ~inside[1:]
        cuts = words.first_word[1:-1]  # a run ends with its text
        cuts = cuts[(cuts > 0) & (cuts < len(known))]
        both = cuts[inside[cuts] & inside[cuts + 1]]
        begins[both] = ends[both] = True
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends)
        long = stop - start >= self.windows.shortest
        for a, b in zip(start[long].tolist(), stop[long].tolist()):
            for end, length, found in self.windows.stream(known[a:b].tolist()):
                cover[a + end - length] += 1
                cover[a + end] -= 1
                items.setdefault(int(words.text[a]), set()).update(found)
        return cover, items


def _earlier(batch: pa.RecordBatch, i: int, j: int, words: Words, cover: np.ndarray, items: dict[int, set]) -> None:
    """Add what an earlier pass over other items found for texts i to j."""
    for text, (spans, ids) in enumerate(zip(batch.column("hit_words")[i:j].to_pylist(), batch.column("item_ids")[i:j].to_pylist())):
        if spans:
            at = words.first_word[text]
            for s in spans:
                cover[at + s["start"]] += 1
                cover[at + s["end"]] -= 1
            items.setdefault(text, set()).update(ids)


def _judge(batch: pa.RecordBatch, text: str, detectors: Callable[[], Iterable[Detector]], merge: bool) -> list[pa.Array]:
    body, offsets = text_buffers(batch.column(text))
    n_words, n_hit, shas, ids_of, spans = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [], [], []
    # one slice after the other: its words take 16 times its bytes
    for i, j in slices(offsets):
        words = Words(body, offsets, i, j)
        cover, items = np.zeros(len(words.hash) + 1, dtype=np.int64), {}
        if merge:
            _earlier(batch, i, j, words, cover, items)
        for d in detectors():
            c, own = d.hits(words)
            cover += c
            for t, ids in own.items():
                items.setdefault(t, set()).update(ids)
        hit = np.cumsum(cover)[:-1] > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        n_words.append(words.counts)
        n_hit.append(total[words.first_word[1:]] - total[words.first_word[:-1]])
        for t in range(words.n_texts):
            ids_of.append(sorted(x for x in items.get(t, ()) if x is not None))
            shas.append(hashlib.sha256(",".join(ids_of[-1]).encode()).hexdigest())
            turn = np.diff(np.concatenate([[0], hit[words.first_word[t]: words.first_word[t + 1]], [0]]).astype(np.int8)) \
                if t in items else np.zeros(0)
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(turn > 0), np.flatnonzero(turn < 0))])
    n_words, n_hit = np.concatenate(n_words), np.concatenate(n_hit)
    bad = (n_hit > 0) & (SHARE * n_hit >= n_words)
    return [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in ids_of], pa.int64()),
            pa.array(shas, pa.string()), pa.array(bad, pa.bool_()), pa.array(spans, _SPANS), pa.array(ids_of, pa.list_(pa.string()))]


def item_blocks(benchmark: DataFrame, item_id: str, text: str, size: int) -> Iterator[list[tuple[str | None, np.ndarray]]]:
    """The items as (id as text, word hashes), in blocks of about ``size`` words; read partition by partition."""
    block, held = [], 0
    for row in benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        block.append((row.i, word_hashes([row.t])[0]))
        held += len(block[-1][1])
        if held >= size:
            yield block
            block, held = [], 0
    yield block


def find_contamination(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH,
) -> DataFrame:
    """``df`` with the columns RESULTS; ``hit_words`` has the spans of hit words, counted in words of the text."""
    out, merge = df, False
    blocks = item_blocks(benchmark, item_id, item_text, BLOCK_WORDS)
    while held := list(islice(blocks, PASS_BLOCKS)):
        shared = df.sparkSession.sparkContext.broadcast(held)

        def each(batches: Iterator[pa.RecordBatch], shared=shared, merge=merge):
            only = [Detector(b, width) for b in shared.value] if len(shared.value) == 1 else None
            yield from map(lambda b: _judge(b, text, lambda: only or (Detector(x, width) for x in shared.value), merge), batches)

        out, merge = with_arrow_columns(out, RESULTS, each), True
    return out
