"""Exact copies, repeated lines, windows of lines, near duplicates and long repeats against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import components, dart_minhash, exact_dedup, line_windows, run_length_index, substring_dedup
from tests.llm import brute, cases


def key(row):
    return tuple((x is None, str(x)) for x in row)


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=key)


# ---- exact copies ----------------------------------------------------------------------------------


def test_exact_copies(spark):
    rows = cases.documents()
    out = exact_dedup.mark_copies(cases.frame(spark, rows))
    assert tuples(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == ordered(brute.copies(rows))
    left = exact_dedup.drop_copies(cases.frame(spark, rows))
    assert left.columns == cases.frame(spark).columns
    assert tuples(left, "doc_id") == ordered((r[0],) for r in brute.copies(rows) if r[3])
    assert exact_dedup.mark_copies(cases.empty(spark)).count() == 0 == exact_dedup.drop_copies(cases.empty(spark)).count()


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MIN_BITS", 64)
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 64)
    rows = cases.documents()
    out = exact_dedup.mark_copies(cases.frame(spark, rows))
    assert tuples(out, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == ordered(brute.copies(rows))


def test_the_filter_lets_single_texts_pass(spark):
    digests = spark.range(5_000).select(F.sha2((F.col("id") % 4_900).cast("string").cast("binary"), 256).alias("sha"))
    bits = exact_dedup.filter_bits(5_000)
    marked = exact_dedup.with_possible(digests, exact_dedup.repeated_slots(digests, bits), bits)
    sizes = marked.groupBy("sha").agg(F.count("*").alias("n"), F.bool_and("possible").alias("possible"))
    assert sizes.where("n > 1 AND NOT possible").count() == 0  # none is missed
    assert sizes.where("n = 1 AND possible").count() < 50  # few pass for nothing
    text = exact_dedup.mark_copies(cases.frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


# ---- lines ------------------------------------------------------------------------------------------


def test_repeated_lines(spark):
    rows = cases.documents()
    want = brute.removed_lines(rows)
    for row in substring_dedup.remove_repeated_units(cases.frame(spark, rows)).collect():
        gone, kept = want[row.doc_id, row.text]
        assert (row.n_removed, row.kept_text) == (len(gone), kept)
        cut = "".join(row.text[s.start: s.end] for s in row.removed)
        assert cut.replace("\n", "") == "".join(row.text.split("\n")[i] for i in gone)
    assert substring_dedup.remove_repeated_units(cases.empty(spark)).count() == 0


def test_the_earliest_rank_keeps_its_line(spark):
    line = "five words in one line"
    df = spark.createDataFrame([(1, line, 2.0), (2, line, 1.0), (3, line, None)], "doc_id bigint, text string, quality double")
    out = substring_dedup.remove_repeated_units(df, rank="quality")
    assert tuples(out, "doc_id", "kept_text") == [(1, ""), (2, line), (3, "")]
    paragraphs = spark.createDataFrame([(1, "a b c d e\nf\n\nx"), (2, "x\n\nA b  c d e\nf")], "doc_id bigint, text string")
    out = substring_dedup.remove_repeated_units(paragraphs, unit="paragraph")
    assert tuples(out, "doc_id", "kept_text") == [(1, "a b c d e\nf\n\nx"), (2, "x")]


def test_line_windows(spark):
    rows = cases.documents() + [(300 + i, "\n".join("abcdefgh"[i: i + 5])) for i in range(4)]
    want = brute.removed_lines(rows, windows=3)
    out = line_windows.remove_repeated_windows(cases.frame(spark, rows))
    for row in out.collect():
        gone, kept = want[row.doc_id, row.text]
        assert (row.n_lines, row.n_removed, row.kept_text) == (row.text.count("\n") + 1, len(gone), kept)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert line_windows.remove_repeated_windows(cases.empty(spark)).count() == 0


# ---- near duplicates ----------------------------------------------------------------------------------


def test_near_classes(spark):
    rng = random.Random(1)
    rows = cases.documents()
    for n in range(12):  # classes of texts with one to several words changed
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(20, 200))]
        for copy in range(6):
            other = list(base)
            for _ in range(rng.randint(0, 3)):
                other[rng.randrange(len(other))] = f"z{rng.randrange(9)}"
            rows.append((1000 + 10 * n + copy, " ".join(other)))
    out = dart_minhash.near_classes(cases.frame(spark, rows))
    assert tuples(out, "doc_id", "class_id", "class_size", "kept") == ordered(brute.near_classes(rows))
    left = dart_minhash.drop_near_copies(cases.frame(spark, rows))
    assert left.columns == cases.frame(spark).columns
    assert tuples(left, "doc_id") == ordered((r[0],) for r in brute.near_classes(rows) if r[3])
    assert dart_minhash.near_classes(cases.empty(spark)).count() == 0 == dart_minhash.drop_near_copies(cases.empty(spark)).count()


def test_many_copies_of_one_original_that_are_near_to_it_only(spark):
    """Each copy is at about 0.86 to the original and at 0.75 to the others, so only the original links them."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(base))]
    for copy in range(1, 301):
        other = list(base)
        for at in rng.sample(range(5, 395, 10), 6):
            other[at] = f"c{copy}x{at}"
        rows.append((copy, " ".join(other)))
    want = brute.near_classes(rows)
    assert {r[2] for r in want} == {301}
    out = dart_minhash.near_classes(cases.frame(spark, rows))
    assert tuples(out, "doc_id", "class_id", "class_size", "kept") == ordered(want)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    for _ in range(5):
        element = np.tile(rng.integers(1, 2**63, 300).astype(np.uint64), 2)
        a = rng.integers(0, 6, 300) * rng.random(300)
        b = np.where(rng.random(300) < 0.8, a, rng.integers(0, 9, 300))
        weight, owner = np.concatenate([a, b]), np.repeat([0, 1], 300)
        used = weight > 0
        sign = dart_minhash.signatures(owner[used], element[used], weight[used], 2, k=1024)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((sign[0] == sign[1]).mean() - want) < 5 * (want * (1 - want) / 1024) ** 0.5
    assert not dart_minhash.signatures(np.zeros(0, int), np.zeros(0, np.uint64), np.zeros(0), 3).any()


def test_texts_do_not_come_back_with_their_signatures(spark):
    docs = cases.frame(spark).select("doc_id", "text")
    signed = dart_minhash.with_signatures(docs, "text", drop=["text"])
    assert signed.columns == ["doc_id", "bands", "shingles"]
    assert tuples(signed) == tuples(dart_minhash.with_signatures(docs, "text").drop("text"))


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    out = components.components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert tuples(out, "node", "root") == ordered([(i, 0) for i in range(1, 41)] + [(i, 100) for i in range(101, 160)])
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---- long repeats ---------------------------------------------------------------------------------------


def _pieces(seed: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)

    def text(n: int) -> str:
        return " ".join("".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(n))

    base, docs = [text(rng.randint(20, 300)) for _ in range(8)], []
    for i in range(50):
        parts = []
        for _ in range(rng.randint(0, 3)):
            b = rng.choice(base)
            s = rng.randrange(len(b))
            part = b[s: s + rng.choice([100, 199, 200, 201, 260, 3000])]
            if rng.random() < 0.3 and part:
                k = rng.randrange(len(part))
                part = part[:k] + "#" + part[k + 1:]
            parts += [part, "".join(rng.choice("defgh ") for _ in range(rng.randint(0, 90)))]
        docs.append((i, "".join(parts)))
    return docs


@pytest.mark.parametrize("hot", [20_000, 2])
def test_long_repeats(spark, monkeypatch, hot):
    monkeypatch.setattr(run_length_index, "HOT", hot)
    rows = cases.documents() + [(500 + d, t) for d, t in _pieces(hot)] + [
        (700, "a" * 199), (701, "b" * 200), (702, "c" * 201), (703, "é" * 400), (704, "xy" * 90 + "z" + "xy" * 90), (705, "b" * 200)]
    out = run_length_index.remove_long_repeats(cases.frame(spark, rows))
    digest = out.select("doc_id", "n_bytes", "n_removed", F.size("removed").alias("n"), F.sha2("kept", 256).alias("sha"))
    assert tuples(digest, *digest.columns) == ordered(brute.long_repeats(rows))
    assert run_length_index.remove_long_repeats(cases.empty(spark)).count() == 0


def test_the_spans_of_copies_are_gathered_once(spark, monkeypatch):
    def counted(batches):
        for b in batches:
            n = [len(x or ()) for x in b.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(n, pa.int64()), pa.array(n, pa.int64()), b.column("z"), pa.nulls(b.num_rows, spans)], names=names)

    names, spans = run_length_index._KEPT.names, run_length_index._SPANS
    monkeypatch.setattr(run_length_index, "_remove", counted)
    text = "".join(random.Random(6).choice("abcdefgh ") for _ in range(400))
    out = run_length_index.remove_long_repeats(cases.frame(spark, [(i, text) for i in range(300)] + [(None, text)] * 5))
    sizes = [r.n_removed for r in out.collect()]
    assert len(sizes) == 305 and 0 < max(sizes) <= len(text) - 199  # one text has no more starts than that


def test_the_index_gives_the_longest_reach():
    """Starts before the anchor from which LENGTH bytes occur in another string of the group, by brute force."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        length, width, m = 24, 16, 30
        left = rng.integers(97, 99, (m, width)).astype(np.uint8)
        right = rng.integers(97, 99, (m, length)).astype(np.uint8)
        left[m // 2:] = left[: m - m // 2]
        right[m // 3:] = right[: m - m // 3]
        group, size = rng.integers(0, 3, m), rng.integers(0, width + 1, m)
        left[np.arange(width) >= size[:, None]] = 0
        near, far = run_length_index.repeated_starts(group, left, size, right, np.full(m, length), length)
        for i in range(m):
            starts = [s for s in range(size[i] + 1) if any(
                j != i and group[j] == group[i] and size[j] >= s and (left[i, :s] == left[j, :s]).all()
                and (right[i, : length - s] == right[j, : length - s]).all() for j in range(m))]
            assert (near[i], far[i]) == ((min(starts), max(starts)) if starts else (length, -1))
