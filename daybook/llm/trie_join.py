"""Texts linked by the Jaccard similarity of their sets of five-word shingles: an exact join by prefix trees.

All sets are put in one order of shingles: by how often a shingle occurs, in powers of two, then by hash. Frequencies are
counted over all texts; the ``MOST_FREQUENT`` most frequent ones at most go to every task. Any order gives the
same links, a good one gives few candidates.

Candidates. Two linked sets share a shingle among the first L of each: a set sends the first fifth of its shingles and a tenth
more, so two linked sets share more than a twenty-fifth of theirs; of what it sent only the L that the fewest other sets sent count.
Sets that share one of those are of one block. Most texts share none and are in no block.

Tries. The sets of a block, in the order of frequency within it, are the paths of a compact trie. Every set walks through it: the overlap up to a
node counts for all sets below it, and a subtree is left out where the overlap and what remains of both sets cannot reach
the similarity, where no size fits, or where all its sets are already of one component with the walking one. So the links found span every component of links,
and not each link within a component is listed.

A block of more than ``MOST_SETS`` sets or ``MOST_SHINGLES`` shingles is dealt into parts of that size. Each part is joined first; then one set of each
component of each part; then all sets outside the largest component walk through all parts. Nothing is left out; where a
large block has no links, that takes as many walks as it has pairs of parts.

Defined results: words are runs of anything but ASCII white space, with A-Z in lower case. Fewer than five words are one shingle. A text that is NULL or
without words has no set and links with nothing. Texts with equal sets are linked. NULL ids are no smallest id unless there is no other. Repeated rows each give
a row. An empty table gives no rows. Other columns are not used. Shingles are compared as 64-bit hashes, whole sets by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.components import components
from daybook.llm.exact_dedup import filter_bits, repeated_slots, with_possible
from daybook.llm.rows import stored
from daybook.llm.tokens import NOT_SPACE, Words, mix, shingles, slices, text_buffers
from daybook.operators.joins import lookup

#: Similarity in percent.
SIMILARITY = 80
MOST_FREQUENT = 1 << 20
#: Shingles rarer than this need no place of their own in the order.
RARE = 4
SHINGLES_AT_ONCE = 1 << 21
MOST_SETS, MOST_SHINGLES = 4_096, 1 << 21


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of texts, text number and shingle, ordered by both, per slice of a column."""
    body, offsets = text_buffers(column)
    for i, j in slices(offsets):
        owner, shingle, _ = shingles(Words(body, offsets, i, j, NOT_SPACE))
        yield j - i, owner, shingle


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that occur in two texts or more of those read together, with how many."""
    waiting: list[np.ndarray] = []

    def counted():
        shingle, n = np.unique(np.concatenate(waiting), return_counts=True)
        waiting.clear()
        several = n > 1
        return pa.RecordBatch.from_arrays([pa.array(shingle[several].view(np.int64)), pa.array(n[several])], names=["shingle", "n"])

    for b in batches:
        for _, _, shingle in _sets(b.column("text")):
            waiting.append(shingle)
            if sum(map(len, waiting)) >= SHINGLES_AT_ONCE:
                yield counted()
    if waiting:
        yield counted()


def frequent_shingles(texts: DataFrame, most: int = MOST_FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and frequency class (power of two) of the most frequent shingles; ``most`` of them at most."""
    counts = texts.mapInArrow(_count_shingles, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    level = F.floor(F.log2("n")).cast("int")
    classed = stored(counts.where(F.col("n") >= RARE).select("shingle", level.alias("level")))
    sizes = {r.level: r.n for r in classed.groupBy("level").agg(F.count("*").alias("n")).collect()}  # at most 63
    lowest, total = 64, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        lowest = at
    table = classed.where(F.col("level") >= lowest).toArrow()
    shingle = table["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(shingle)
    return shingle[order], table["level"].to_numpy()[order].astype(np.uint8)


def least_overlap(n):
    """Shingles that a set of n has in common with any set that it is linked to, at least."""
    return -(-SIMILARITY * n // 100)


def sent(n):
    """How many of its first shingles a set of n sends: enough that two linked sets share one, and a tenth more."""
    return n - least_overlap(n) + 1 + n // 10


_SIGNED = [("n", T.LongType()), ("k1", T.LongType()), ("k2", T.LongType()), ("first", T.ArrayType(T.LongType()))]


def _sign(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, level = frequent.value
        for b in batches:
            sizes, keys, firsts = [], ([], []), []
            for texts, owner, shingle in _sets(b.column("text")):
                n = np.bincount(owner, minlength=texts)
                start = np.concatenate([[0], np.cumsum(n)])
                for key, salt in zip(keys, (1, 2)):
                    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix(shingle ^ mix(np.array([salt], dtype=np.uint64))))])
                    key.append(mix(total[start[1:]] - total[start[:-1]]))
                place = np.zeros(len(shingle), dtype=np.uint8)
                if len(known):
                    at = np.minimum(np.searchsorted(known, shingle), len(known) - 1)
                    place = np.where(known[at] == shingle, level[at], place)
                order = np.lexsort((shingle, place, owner))
                early = np.arange(len(shingle)) - start[owner] < np.where(n > 0, sent(n), 0)[owner]
                sizes.append(n)
                firsts.append(shingle[order][early])
            n = np.concatenate(sizes) if sizes else np.zeros(0, dtype=np.int64)
            ends = np.concatenate([[0], np.cumsum(np.where(n > 0, sent(n), 0))])
            values = np.concatenate(firsts) if firsts else np.zeros(0, dtype=np.uint64)
            k1, k2 = (np.concatenate(k).view(np.int64) if k else np.zeros(0, dtype=np.int64) for k in keys)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("t"), pa.array(n), pa.array(k1), pa.array(k2),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int64)))],
                names=["doc_id", "t", *[name for name, _ in _SIGNED]])

    return run


def signed(df: DataFrame, most: int = MOST_FREQUENT) -> DataFrame:
    """doc_id, t (hash of the text), n shingles, k1 and k2 (hashes of the set), the first shingles; stored."""
    frequent = df.sparkSession.sparkContext.broadcast(frequent_shingles(df.select("text"), most))
    kinds = [df.schema["doc_id"], df.schema["t"], *[T.StructField(n, t) for n, t in _SIGNED]]
    return stored(df.mapInArrow(_sign(frequent), T.StructType(kinds)))


def blocks(sets: DataFrame) -> DataFrame:
    """node (k1 of a set) and root of the sets that share one of the shingles that count. ``sets`` has k1, n, first, once per set."""
    rows = sets.select("k1", "n", F.explode("first").alias("shingle"))
    # what Spark counts here are narrow rows, spilled where many; a set's own list below is a part of one text
    others = rows.selectExpr("*", "count(*) OVER (PARTITION BY shingle) AS among").where("among > 1")
    needed = f"(({SIMILARITY} * n + 99) DIV 100)"
    of_set = others.groupBy("k1", "n").agg(F.array_sort(F.collect_list(F.struct("among", "shingle"))).alias("shared"))
    count = F.greatest(F.lit(0), F.expr(f"size(shared) - {needed} DIV 10").cast("int"))  # those no other set sent come first
    dealt = of_set.select("k1", F.explode(F.slice("shared", F.lit(1), count)).alias("s")).select("k1", "s.shingle")
    dealt = stored(dealt)
    centre = dealt.groupBy("shingle").agg(F.min("k1").alias("b"), F.max("k1").alias("c")).where("b < c").select("shingle", "b")
    links = lookup(dealt, centre, ["shingle"], "inner").where("k1 <> b").select(F.col("k1").alias("a"), "b").distinct()
    found = stored(components(links))  # a root is no node of its own there
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, values = [np.zeros(1, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
        for texts, owner, shingle in _sets(b.column("text")):
            counts.append(np.bincount(owner, minlength=texts))
            values.append(shingle)
        ends = np.cumsum(np.concatenate(counts)).astype(np.int32)
        sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values).view(np.int64)))
        yield pa.RecordBatch.from_arrays([b.column("t"), sets], names=["t", "shingles"])


def members(texts: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """block, key, n and the shingles of every set in a block; stored. Only the texts that stand for these sets shuffle, and others
    that a Bloom filter of bounded size lets pass."""
    chosen = stored(lookup(sets, found.select(F.col("node").alias("k1"), F.col("root").alias("block")), ["k1"], "inner").select(
        "t", "n", "block", F.struct("k1", "k2").alias("key")))
    bits = filter_bits(chosen.count())
    slots = stored(repeated_slots(chosen, bits, "t", least=1))
    passed = with_possible(texts.select("t", "text"), slots, bits, "t").where("possible").select("t", "text")
    once = lookup(passed, chosen.select("t"), ["t"], "left_semi").groupBy("t").agg(F.min("text").alias("text"))
    return stored(once.mapInArrow(_shingled, "t long, shingles array<long>").join(chosen, "t").select("block", "key", "n", "shingles"))


class Trie:
    """A compact trie of ascending sequences of numbers. Node i covers sequences low[i] to high[i] in their order; its own part are the
    places start[i] to stop[i] of the first of them."""

    def __init__(self, sequences: list[np.ndarray]):
        self.order = sorted(range(len(sequences)), key=lambda i: sequences[i].astype(">u4").tobytes())
        self.sequences = s = [sequences[i] for i in self.order]
        same = np.zeros(len(s), dtype=np.int64)
        for i in range(1, len(s)):
            m = min(len(s[i - 1]), len(s[i]))
            differ = s[i - 1][:m] != s[i][:m]
            same[i] = differ.argmax() if differ.any() else m
        self.size = np.array([len(x) for x in s])
        self.nodes: list[tuple[int, int, int, int, int, int]] = []
        self.children: list[list[int]] = []
        todo = [(0, len(s), 0, -1)] if s else []
        while todo:
            low, high, start, above = todo.pop()
            stop = len(s[low]) if high - low == 1 else int(same[low + 1: high].min())
            sizes = self.size[low:high]
            if above >= 0:
                self.children[above].append(len(self.nodes))
            here = len(self.nodes)
            self.nodes.append((low, high, start, stop, int(sizes.min()), int(sizes.max())))
            self.children.append([])
            if high - low > 1:
                at = low + (len(s[low]) == stop)
                cuts = [at, *(np.flatnonzero(same[at + 1: high] == stop) + at + 1).tolist(), high]
                todo += [(a, b, stop, here) for a, b in zip(cuts, cuts[1:])]


def trie_links(
    sets: list[np.ndarray], component: np.ndarray, indexed: list[int], walking: list[int] | None = None, percent: int = SIMILARITY,
) -> list[tuple[int, int]]:
    """Links between the sets numbered ``indexed`` and ``walking`` (or among the indexed) that join components; ``component`` is
    brought up to date. The links with those given span each component of all links there are."""
    if not indexed:
        return []
    ends = np.cumsum([len(x) for x in sets])
    known, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(known), dtype=np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(known))  # often first, so that paths are shared
    coded = [np.sort(x) for x in np.split(rank[code], ends[:-1])]
    trie = Trie([coded[i] for i in indexed])
    number = [indexed[i] for i in trie.order]
    below = component[number]  # of the leaves, in their order
    marked, links = np.zeros(len(known), dtype=bool), []
    walks = list(zip(number, range(len(number)))) if walking is None else [(i, len(number)) for i in walking]
    for who, limit in walks:
        mine, size = coded[who], len(coded[who])
        fits_low, fits_high = -(-percent * size // 100), size * 100 // percent
        marked[mine] = True
        todo = [(0, 0)]
        while todo:
            node, overlap = todo.pop()
            low, high, start, stop, shortest, longest = trie.nodes[node]
            if low >= limit or longest < fits_low or shortest > fits_high:
                continue
            if (below[low: min(high, limit)] == component[who]).all():
                continue
            path = trie.sequences[low]
            overlap += int(np.count_nonzero(marked[path[start:stop]]))
            left = size - int(np.searchsorted(mine, path[stop - 1], side="right")) if stop else size
            best = overlap + min(min(longest, fits_high) - stop, left)
            if best * (100 + percent) < percent * (size + max(shortest, fits_low)):
                continue
            if len(path) == stop and below[low] != component[who] and 100 * overlap >= percent * (size + stop - overlap):
                links.append((number[low], who))
                old, new = component[who], below[low]
                component[component == old] = new
                below[below == old] = new
            todo += [(child, overlap) for child in trie.children[node]]
        marked[mine] = False
    return links


_LINK = "a struct<k1:long,k2:long>, b struct<k1:long,k2:long>"


def _join_task(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        keys, role = rows["key"].to_pylist(), np.asarray(rows["role"])
        component = np.unique(np.asarray(rows["component"]), return_inverse=True)[1]
        shingle = rows["shingles"].combine_chunks()
        body, ends = shingle.values.to_numpy(), shingle.offsets.to_numpy()
        sets = [body[i:j] for i, j in zip(ends, ends[1:])]
        walking = np.flatnonzero(role == 1).tolist()
        found = trie_links(sets, component, np.flatnonzero(role == 0).tolist(), walking or None, percent)
        if not walking:  # each set to the smallest key of its component: what follows has short ways
            joined = {i for link in found for i in link}
            least: dict[int, int] = {}
            for i in sorted(joined, key=lambda i: (keys[i]["k1"], keys[i]["k2"])):
                least.setdefault(int(component[i]), i)
            found = [(i, least[int(component[i])]) for i in joined if least[int(component[i])] != i]
        kind = pa.struct([("k1", pa.int64()), ("k2", pa.int64())])
        return pa.table([pa.array([keys[i] for i, _ in found], kind), pa.array([keys[j] for _, j in found], kind)], names=["a", "b"])

    return run


def _joined(rows: DataFrame, percent: int, *task: str) -> DataFrame:
    """Links found in each task of rows (key, shingles, component, role); stored."""
    return stored(rows.select(*task, "key", "shingles", "component", "role").groupBy(*task).applyInArrow(_join_task(percent), _LINK))


def spanning_links(
    sets: DataFrame, most_sets: int = MOST_SETS, most_shingles: int = MOST_SHINGLES, percent: int = SIMILARITY,
) -> DataFrame:
    """a, b: verified links that span the components of all links. ``sets`` has block, key (k1, k2), n and shingles (distinct)."""
    parts = F.ceil(F.greatest(F.count("*") / most_sets, F.sum("n") / most_shingles)).cast("int")
    sizes = sets.groupBy("block").agg(parts.alias("parts"))
    alone = F.xxhash64("key")
    dealt = lookup(sets, sizes, ["block"], "inner").withColumns({
        "part": F.pmod(F.xxhash64("key", F.lit(3)), "parts").cast("int"), "component": alone, "role": F.lit(0)})
    links = _joined(dealt, percent, "block", "part")
    large = dealt.where("parts > 1")
    if large.isEmpty():
        return links

    def with_components(known: DataFrame) -> DataFrame:
        """The sets of the large blocks with what the links so far say of their component."""
        return lookup(large, components(known).select(F.col("node").alias("key"), "root"), ["key"]).withColumn(
            "component", F.xxhash64(F.coalesce("root", "key"))).drop("root")

    narrow = stored(with_components(links).select("block", "part", "parts", "key", "n", "component"))
    speaker = narrow.groupBy("block", "part", "component").agg(F.min("key").alias("key")).select("key")
    speaking = lookup(with_components(links), speaker, ["key"], "left_semi")
    groups = speaking.groupBy("block").agg(parts.alias("groups"))
    again = lookup(speaking, groups, ["block"], "inner").withColumn("part", F.pmod(F.xxhash64("key", F.lit(5)), "groups"))
    links = stored(links.unionByName(_joined(again, percent, "block", "part")))

    now = stored(with_components(links).select("block", "part", "parts", "key", "n", "component"))
    largest = now.groupBy("block", "component").agg(F.count("*").alias("size")).groupBy("block").agg(F.max_by("component", F.struct("size", "component")).alias("main"))
    outside = lookup(now, largest, ["block"], "inner").where("component <> main").select("block", "key", "n")
    walks = stored(outside.groupBy("block").agg(parts.alias("walks")))
    if walks.isEmpty():
        return links
    rows = lookup(with_components(links), walks, ["block"], "inner")
    indexed = rows.withColumn("walk", F.explode(F.sequence(F.lit(0), F.col("walks") - 1)))
    walking = lookup(rows, outside.select("key"), ["key"], "left_semi").withColumns({
        "walk": F.pmod(F.xxhash64("key", F.lit(7)), "walks").cast("int"), "role": F.lit(1)}).drop("part").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    last = indexed.unionByName(walking, allowMissingColumns=True)
    return links.unionByName(_joined(last, percent, "block", "part", "walk"))


def jaccard_components(df: DataFrame, text: str = "text", doc_id: str = "doc_id", most_frequent: int = MOST_FREQUENT,
                       most_sets: int = MOST_SETS, most_shingles: int = MOST_SHINGLES) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id (the smallest id of the texts it is linked to, at any remove)."""
    body = F.coalesce(F.col(text), F.lit(""))
    texts = df.select(F.col(doc_id).alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("t"))
    rows = signed(texts, most_frequent)
    sets = stored(rows.where("n > 0").groupBy("k1", "k2").agg(F.first("n").alias("n"), F.min("t").alias("t"), F.first("first").alias("first")))
    found = blocks(sets)
    links = spanning_links(members(texts, sets.select("t", "n", "k1", "k2"), found), most_sets, most_shingles)
    roots = components(links).select(F.col("node").alias("key"), "root")
    keyed = lookup(rows.where("n > 0").select("doc_id", "n", F.struct("k1", "k2").alias("key")), roots, ["key"]).select(
        "doc_id", "n", F.coalesce("root", "key").alias("root"))
    least = keyed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    linked = lookup(keyed, least, ["root"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return linked.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
