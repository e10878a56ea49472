"""The trie of what conversations have in common from their start, with totals per node.

Conversations are sequences of turns. Equal sequences count once; the others are dealt to shards by ranges of
their order. The boundaries of the ranges, the splitters, are paths of the trie; only their proper prefixes, the
skeleton, can have conversations in more than one shard. The skeleton goes to every task. A shard, read in order,
finishes each node outside the skeleton as it leaves it, and gives a part of the totals of the skeleton
nodes it passes. The parts are added up by key, and what skeleton nodes owe each other is added along their chains.

Bounds: there are ``PATHS_A_SHARD`` sequences to a shard, on average, and ``MAX_SHARDS`` shards at most; a splitter has at most
``SPLITTER_TURNS`` turns, and splitters are chosen from ``SAMPLES_A_SHARD`` sequences a shard. These only deal out the work.
The ids that end in one node are joined in blocks of ``IDS_A_BLOCK`` and hashed as a stream. A conversation travels as one
row of 24 bytes a turn, without its texts.

Defined results: rows with a NULL conv_id are left out. Turns order by number, NULL first, then by role and text; all of them count,
repeated rows too. A NULL role or text is empty. An empty table has no node. Other columns are not used. Turns are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import hash_pair, stored
from daybook.operators.joins import lookup

PATHS_A_SHARD = 50_000
MAX_SHARDS = 20_000
SPLITTER_TURNS = 64
SAMPLES_A_SHARD = 16
IDS_A_BLOCK = 4_096
_ROOT = b""


def turn_sequences(turns: DataFrame) -> DataFrame:
    """conv_id and its turns in order as an array of digest and UTF-8 length."""
    said = turns.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = said.withColumn("at", F.row_number().over(
        Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")))
    item = F.struct("at", *hash_pair("a", "b", F.col("role"), F.col("text")), F.octet_length("text").cast("long").alias("n"))
    return placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("items")).select(
        "conv_id", F.transform("items", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["n"].alias("n"))).alias("path"))


def with_shared_heads(sequences: DataFrame, base: Column, length: Column) -> DataFrame:
    """Sequences whose first ``length`` turns are those of conversation ``base``: all it has if fewer, none if there is no such one."""
    heads = sequences.select(F.col("conv_id").alias("base"), F.col("path").alias("head"))
    both = lookup(sequences.select("conv_id", "path", base.alias("base"), length.cast("int").alias("h")), heads, ["base"])
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("path", 1, 0))
    own = F.slice("path", F.col("h") + 1, F.size("path"))
    return both.select("conv_id", F.concat(head, own).alias("path"))


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per key, in rows ordered by key and block: number of ids, smallest id, SHA-256 of the ids joined by commas."""
    key, n, least, sha, done = None, 0, 0, None, []

    def batch():
        columns = list(zip(*done)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["k1", "k2", "n", "least", "sha"])

    for b in batches:
        for k1, k2, ids, many, first in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids", "many", "first"))):
            if (k1, k2) != key:
                if key is not None:
                    done.append((*key, n, least, sha.hexdigest()))
                key, n, least, sha = (k1, k2), 0, first, hashlib.sha256()
            sha.update((("," if n else "") + ids).encode())
            n += many
        yield batch()
        done.clear()
    if key is not None:
        done.append((*key, n, least, sha.hexdigest()))
        yield batch()


def distinct_paths(sequences: DataFrame) -> DataFrame:
    """One row per distinct sequence: path, n, least and sha of the ids that have it."""
    keyed = sequences.select("conv_id", "path", F.xxhash64("path", F.size("path")).alias("k1"), F.xxhash64(F.lit(7), "path").alias("k2"))
    paths = keyed.groupBy("k1", "k2").agg(F.min("path").alias("path"))
    blocks = keyed.groupBy("k1", "k2", F.floor(F.col("conv_id") / IDS_A_BLOCK).alias("block")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
        F.count("*").alias("many"), F.min("conv_id").alias("first"))
    ends = blocks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "block").mapInArrow(
        _hashed_ids, "k1 long, k2 long, n long, least long, sha string")
    return paths.join(ends, ["k1", "k2"]).select("path", "n", "least", "sha", F.col("k1").alias("pick"))


def splitters(paths: DataFrame, shards: int) -> list[tuple]:
    """At most ``shards`` - 1 boundaries, each of at most SPLITTER_TURNS turns, in order."""
    some = paths.orderBy("pick").select(F.slice("path", 1, SPLITTER_TURNS).alias("path")).limit(SAMPLES_A_SHARD * shards)
    known = sorted(tuple((t.a, t.b, t.n) for t in r.path) for r in some.toLocalIterator())
    step = len(known) / shards
    return sorted({known[int(i * step)] for i in range(1, shards)} - {()}) if known else []


class _Node:
    __slots__ = ("turn", "key", "n", "least", "children", "leaves", "saved", "sha", "skeleton", "waiting")

    def __init__(self, turn: tuple | None, key: bytes, skeleton: bool):
        self.turn, self.key, self.skeleton = turn, key, skeleton
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.sha, self.waiting = None, None, []


_NODE = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("parent_key", T.BinaryType()), T.StructField("depth", T.LongType()),
    T.StructField("bytes", T.LongType()), T.StructField("conv_id", T.LongType()), T.StructField("parent_conv_id", T.LongType()),
    T.StructField("n_convs", T.LongType()), T.StructField("n_children", T.LongType()), T.StructField("n_leaves", T.LongType()),
    T.StructField("saved", T.LongType()), T.StructField("sha", T.StringType()), T.StructField("chain", T.ArrayType(T.BinaryType())),
])
_ARROW = pa.schema([
    ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), ("bytes", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved", pa.int64()), ("sha", pa.string()), ("chain", pa.list_(pa.binary()))])


class _Walk:
    """Goes through one shard's sequences in order. Rows of nodes that are done come out of ``out``: those of the skeleton
    with their chain of ancestors and only this shard's part, the others complete."""

    def __init__(self, skeleton: frozenset):
        self.skeleton, self.out = skeleton, []
        self.open = [_Node(None, _ROOT, True)]

    def add(self, path: list[tuple], n: int, least: int, sha: str) -> None:
        common = 0
        while common < min(len(path), len(self.open) - 1) and self.open[common + 1].turn == path[common]:
            common += 1
        self.close(common + 1)
        for turn in path[common:]:
            top = self.open[-1]
            key = hashlib.blake2b(top.key + b"%d,%d,%d;" % turn, digest_size=16).digest()
            self.open.append(_Node(turn, key, top.skeleton and key in self.skeleton))
        last = self.open[-1]
        last.n, last.sha = last.n + n, sha
        last.least = least if last.least is None else min(least, last.least)

    def close(self, keep: int) -> None:
        """Leaves all open nodes but the first ``keep``."""
        while len(self.open) > keep:
            node, depth = self.open.pop(), len(self.open)
            above = self.open[-1] if self.open else None
            size = node.turn[2] if node.turn else 0
            for row in node.waiting:
                self.out.append((*row[:5], node.least, *row[6:]))
            if not node.skeleton:
                node.saved += (node.n - 1) * size
                node.leaves += not node.children
            row = (node.key, above.key if above else None, depth, size, node.least, None, node.n, node.children, node.leaves, node.saved, node.sha,
                   [o.key for o in self.open] + [node.key] if node.skeleton else None)
            if above is not None:
                above.n, above.leaves, above.saved = above.n + node.n, above.leaves + node.leaves, above.saved + node.saved
                above.least = node.least if above.least is None else min(above.least, node.least)
                above.children += not node.skeleton
            (self.out if node.skeleton or above.skeleton else above.waiting).append(row)


def _skeleton(bounds: list[tuple]) -> frozenset:
    """Keys of the proper prefixes of the splitters."""
    keys = {_ROOT}
    for path in bounds:
        key = _ROOT
        for turn in path[:-1]:
            key = hashlib.blake2b(key + b"%d,%d,%d;" % turn, digest_size=16).digest()
            keys.add(key)
    return frozenset(keys)


def _paths(column: pa.Array) -> Iterator[list[tuple]]:
    ends, turns = column.offsets.to_pylist(), column.values
    a, b, n = (turns.field(i).to_pylist() for i in range(3))
    whole = list(zip(a, b, n))
    for i, j in zip(ends, ends[1:]):
        yield whole[i:j]


def _shard_nodes(skeleton):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, shard = None, None

        def taken() -> pa.RecordBatch:
            rows, walk.out = walk.out, []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

        for b in batches:
            rest = (b.column(c).to_pylist() for c in ("n", "least", "sha", "shard"))
            for path, n, least, sha, s in zip(_paths(b.column("path")), *rest):
                if s != shard:
                    if walk is not None:
                        walk.close(0)
                        yield taken()
                    walk, shard = _Walk(skeleton.value), s
                walk.add(path, n, least, sha)
                if len(walk.out) >= 10_000:
                    yield taken()
        if walk is not None:
            walk.close(0)
            yield taken()

    return run


def _dealt(bounds):
    """Adds the shard: the number of splitters that are not after the path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard = [bisect_right(bounds.value, tuple(p[:SPLITTER_TURNS])) for p in _paths(b.column("path"))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard, pa.int64())], names=[*b.schema.names, "shard"])

    return run


def prefix_nodes(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (conv_id, path): conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = sequences.sparkSession
    paths = stored(distinct_paths(sequences))
    shards = min(MAX_SHARDS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-paths.count() // PATHS_A_SHARD)))
    bounds = splitters(paths, shards)
    dealt = paths.drop("pick").mapInArrow(_dealt(spark.sparkContext.broadcast(bounds)), T.StructType(
        [f for f in paths.schema.fields if f.name != "pick"] + [T.StructField("shard", T.LongType())]))
    ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path")
    nodes = stored(ordered.mapInArrow(_shard_nodes(spark.sparkContext.broadcast(_skeleton(bounds))), _NODE))

    # the skeleton: at most MAX_SHARDS * SPLITTER_TURNS nodes, each with one row per shard that passed it
    total = nodes.where("chain IS NOT NULL").groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.first("bytes").alias("bytes"),
        F.first("chain").alias("chain"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("sha").alias("sha"))
    total = stored(total)
    below = total.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    total = total.join(below, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    owed = total.select(
        F.explode("chain").alias("key"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("own_saved"),
        (F.col("n_children") == 0).cast("long").alias("own_leaf")).groupBy("key").agg(
        F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaf"))
    whole = total.join(owed, "key").select(
        "key", "parent_key", "depth", "conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("own_leaf")).alias("n_leaves"),
        (F.col("saved") + F.col("own_saved")).alias("saved"), "sha")
    parents = total.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above"))
    result = [F.col("conv_id"), F.col("depth"), F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), F.col("n_convs"), F.col("n_children"),
              F.col("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit(b""), 256)).alias("ends_sha256")]
    inner = nodes.where("chain IS NULL AND parent_conv_id IS NOT NULL").withColumn("above", F.lit(None).cast("long")).select(*result)
    edge = lookup(nodes.where("chain IS NULL AND parent_conv_id IS NULL"), parents, ["parent_key"]).select(*result)
    top = whole.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*result)
    return inner.unionByName(edge).unionByName(top)
