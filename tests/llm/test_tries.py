"""The operators on tries and the phrase graph against plain versions: awkward rows, hot groups, small parts, empty tables."""

from __future__ import annotations

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import phrase_graph, prefix_trie, trie_join
from tests.llm import brute, cases


def counted(df):
    return Counter(tuple(r) for r in df.collect())


# ---- the join


def family(copies: int, changed: int, words: int = 60, seed: int = 5) -> list[str]:
    """Copies of one text, each with some words of its own."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for c in range(copies):
        text = list(base)
        for i in rng.sample(range(words), changed):
            text[i] = f"own{c}x{i}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("limits", [{}, {"most_frequent": 4, "most_sets": 5}, {"most_frequent": 0, "most_shingles": 300}])
def test_join_on_awkward_rows(spark, limits):
    rows = cases.documents()
    rows += [(200 + i, t) for i, t in enumerate(family(40, 1) + family(30, 2, 70, 6) + family(12, 1, 6, 7))]
    rows += [(None, rows[5][1]), (300, "One two THREE four five"), (301, "one  two\tthree four\nfive"), (302, "one two three four")]
    got = trie_join.jaccard_components(cases.frame(spark, rows), **limits)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert counted(got) == Counter(brute.jaccard_components(rows))


def test_join_of_unlinked_family(spark):
    """Copies of a text that is not there: they share much and few or none link, however the parts are cut."""
    rows = list(enumerate(family(60, 3, 80, 9)))
    want = Counter(brute.jaccard_components(rows))
    for limits in {}, {"most_sets": 7}:
        assert counted(trie_join.jaccard_components(cases.frame(spark, rows), **limits)) == want


def test_join_finds_star(spark):
    """Every copy is near the original and not near the other copies: one component."""
    original = " ".join(f"w{i}" for i in range(100))
    rows = [(0, original)]
    for c in range(1, 120):
        words = original.split(" ")
        for i in (3 * c % 95, (7 * c + 31) % 95):
            words[i] = f"own{c}"
        rows.append((c, " ".join(words)))
    want = brute.jaccard_components(rows)
    got = trie_join.jaccard_components(cases.frame(spark, rows), most_sets=16)
    assert counted(got) == Counter(want) and len({r[2] for r in want}) < 20


def test_join_of_one_hot_text(spark):
    rows = [(i, "the same text in a third of all rows") for i in range(3_000)] + [(10_000 + i, f"text number {i} is of its own kind") for i in range(200)]
    got = trie_join.jaccard_components(cases.frame(spark, rows)).groupBy("component_id").count()
    assert {r.component_id: r["count"] for r in got.collect()} == {0: 3_000} | {10_000 + i: 1 for i in range(200)}


def test_trie_links_span_components():
    rng = np.random.default_rng(4)
    for _ in range(30):
        sets = list({tuple(sorted(rng.choice(14, rng.integers(1, 12), replace=False).tolist())) for _ in range(25)})
        arrays = [np.array(s, dtype=np.int64) for s in sets]
        linked = lambda a, b: 100 * len(set(a) & set(b)) >= 80 * len(set(a) | set(b))
        component = np.arange(len(sets))
        for i, j in trie_join.trie_links(arrays, component, list(range(len(sets)))):
            assert linked(sets[i], sets[j])
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                assert component[i] == component[j] or not linked(a, b)


# ---- phrases


@pytest.mark.parametrize("least", [2, 5, 30])
def test_collocations_on_awkward_rows(spark, least):
    rng = random.Random(8)
    texts = [t for _, t in cases.documents()] + ["Il était une fois, Il ÉTAIT une fois\x0bil était"] * 40
    rows = [(rng.choice(["en", "de", None]), t) for t in texts]
    df = spark.createDataFrame([(g, t, 1.5, "w", 3) for g, t in rows], "lang string, text string, score double, w1 string, n int")
    got = phrase_graph.collocations(df, least=least)
    assert counted(got) == Counter(brute.collocations(rows, least))


def test_collocations_keep_the_best(spark):
    rows = [("en", "a b c d e. a b. c d e f; a b c")] * 6
    got = phrase_graph.collocations(spark.createDataFrame(rows, "lang string, text string"), least=3, most=2)
    assert counted(got) == Counter(brute.collocations(rows, 3, 2))


def test_paths_are_compacted(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [("en", f"{i} {passage} {i}") for i in range(10)] + [("en", "x y " * 30)] * 3
    found = phrase_graph.edges(spark.createDataFrame(rows, "lang string, text string"), "text", "lang", 5)
    paths = phrase_graph.phrase_counts(found, 5)[1].collect()
    assert max(len(r.words) for r in paths) == 40
    assert (passage.split(" "), 10) in [(r.words, r.n) for r in paths]


def test_edges_go_no_further_than_frequent_phrases(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdef") for _ in range(50)) + ". u v w x" for _ in range(20)]
    f = Counter(" ".join(w[i: i + k]) for t in texts for w in (piece.split() for piece in t.split(".")) for k in range(1, 5) for i in range(len(w) - k + 1))
    df = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    found = {r.phrase: r.n for r in phrase_graph.edges(df, "text", "lang", 10).collect()}
    assert found.pop("") == sum(n for phrase, n in f.items() if " " not in phrase)
    assert {p.count(" ") for p in found} >= {1, 3} and min(f[p] for p in found) >= 10


@pytest.mark.parametrize("at_once", [1, 500, 1 << 21])
def test_frequent_slots_over_many_counts(monkeypatch, at_once):
    monkeypatch.setattr(phrase_graph, "AT_ONCE", at_once)
    monkeypatch.setattr(phrase_graph, "SLICE", 300)
    texts = [f"hot hot {'hot ' * (i % 3)}, v{i % 7} w{i % 5}; once{i}" for i in range(400)]
    batch = pa.RecordBatch.from_pydict({"grp": ["en"] * 200 + ["de"] * 200, "text": texts})
    parts = [(part, packed) for b in phrase_graph._count_phrases(SimpleNamespace(value=[]), 90)([batch.slice(0, 250), batch.slice(250)])
             for part, packed in zip(b["part"].to_pylist(), b["packed"].to_pylist())]
    parts.sort(key=lambda r: r[0])
    schema = pa.schema([("part", pa.int32()), ("packed", pa.binary())])
    ordered = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in parts[i: i + 3]], schema) for i in range(0, len(parts), 3)]
    rows = [r for b in phrase_graph._frequent(90)([*ordered, ordered[0].slice(0, 0)]) for r in b.to_pylist()]
    assert len({r["part"] for r in rows}) == len(rows)
    # hot and hot hot in either group; nothing else is in it 90 times
    assert sum(int.from_bytes(r["bits"], "little").bit_count() for r in rows) == 4


# ---- the trie of conversations


def conversations(seed: int = 2) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in [*range(60), 1_000_003]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["yes", "no", "né", "", None])))
    rows += [(7, None, "user", "first"), (7, None, None, None), (8, 0, "user", "tie"), (8, 0, "user", "tie"), (None, 1, "user", "lost")]
    rows += [(70, t, "user", f"turn {t}") for t in range(400)]  # a very long one
    return rows + [(c, t, "user", f"same {t}") for c in range(100, 400) for t in range(3)]


@pytest.mark.parametrize("shards", ["1", "4", "61"])
def test_prefix_nodes(spark, shards):
    rows = conversations()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.createDataFrame([(*r, "k", 1.0) for r in rows], "conv_id bigint, turn bigint, role string, text string, key string, n double")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        five, heads = F.col("conv_id") - F.col("conv_id") % 5, F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
        got = counted(prefix_trie.prefix_nodes(prefix_trie.with_shared_heads(prefix_trie.turn_sequences(df), five, heads)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == Counter(brute.prefix_nodes(rows))


def test_empty_tables(spark):
    docs = cases.empty(spark)
    assert trie_join.jaccard_components(docs).count() == 0
    assert phrase_graph.collocations(docs).count() == 0
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert prefix_trie.prefix_nodes(prefix_trie.turn_sequences(turns)).count() == 0


# ---- names and bounds that all operators share


def test_names_are_compared_as_spark_does(spark, sf_dir):
    """Columns that differ from results by case go through every stage of the pipeline."""
    import corpus_pipeline

    rows = cases.documents()
    docs = spark.createDataFrame([(d, t, "en", "src", 1.0, "x", 2, "y") for d, t in rows],
                                 "doc_id bigint, text string, lang string, source string, Score double, Letter string, other int, Contaminated string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert out.where("other = 2 AND Letter = 'x'").count() == out.count() > 0, name


def test_copies_do_not_exceed_the_sample(spark):
    from daybook.llm import language_id, toxicity

    copies = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang"))
    others = spark.range(3_000).select("id", F.concat(F.lit("text "), "id").alias("text"), F.lit("de").alias("lang"))
    df = copies.union(others)
    assert language_id.labelled_sample(df, "text", "lang", F.lit(True), rows=200).count() < 400
    labels = spark.range(3_000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    assert toxicity.train(df, labels) is not None
