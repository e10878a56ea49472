"""The pipeline stage by stage against plain versions, and the registered queries of this folder."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from daybook.llm import language_id
from tests.llm import brute, cases
from tests.llm.test_dedup import ordered, tuples
from tests.llm.test_scoring import check_packing
from tests.oracle import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
OWN = sorted(k for k in QUERIES if k.startswith("op") and k[2:3].isdigit())


def test_every_operator_has_a_query():
    assert {int(k[2:].split("_")[0]) for k in OWN} == set(range(1, 14)) and "pipeline" in QUERIES
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "packing"]


@pytest.mark.parametrize("name", [k for k in OWN if k in ORACLES])
def test_matches_sql(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir).toArrow()
    assert compare(result, connect(sf_dir).sql(ORACLES[name]).to_arrow_table()) == ""


def _docs(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def test_decontamination_query(spark, sf_dir):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    out = QUERIES["op7_decontamination"](spark, sf_dir)
    assert tuples(out, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == ordered(
        brute.contamination(_docs(spark, sf_dir), items))


def test_near_dedup_query(spark, sf_dir):
    out = QUERIES["op6_near_dedup"](spark, sf_dir)
    assert tuples(out, "doc_id", "class_id", "class_size", "kept") == ordered(brute.near_classes(_docs(spark, sf_dir)))


def test_long_repeats_query(spark, sf_dir):
    out = QUERIES["op9_long_repeats"](spark, sf_dir)
    assert tuples(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == ordered(brute.long_repeats(_docs(spark, sf_dir)))


def test_packing_query(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    assert check_packing(QUERIES["op10_packing"](spark, sf_dir).collect(), docs) == 0


@pytest.mark.parametrize("name,columns", [
    ("op3_toxicity", ["doc_id", "held_out", "score", "predicted"]), ("op8_language", ["doc_id", "held_out", "lang_pred", "score"])])
def test_scores(spark, sf_dir, name, columns):
    out = QUERIES[name](spark, sf_dir)
    assert out.columns[:4] == columns
    rows = out.collect()
    assert {r.doc_id for r in rows} == {d for d, _ in _docs(spark, sf_dir)} and len(rows) == len({r.doc_id for r in rows})
    assert all(r.held_out == brute.held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)


def _write(spark, tmp_path, rows):
    cases.frame(spark, rows).drop("key", "who", "sha").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, cases.PASSAGE)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_pipeline(spark, tmp_path):
    rows = cases.documents()
    folder = _write(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = [(d, t) for d, t in rows if t and language_id._LETTER.search(t)]
    stages = dict(corpus_pipeline.STAGES)
    found = stages["language_id"](spark, docs, folder)
    assert found.columns == docs.columns and tuples(found, "doc_id", "text") == ordered(left)

    keep = lambda rows_, kept: ordered({(d, t) for (d, t) in rows_ if (d, brute.sha(brute.one_spaced(t))) in kept})
    exact = stages["exact_dedup"](spark, found, folder)
    assert exact.columns == docs.columns
    assert ordered((d, brute.sha(brute.one_spaced(t))) for d, t in tuples(exact, "doc_id", "text")) == ordered(
        (d, s) for d, _, _, kept, s in brute.copies(left) if kept)
    left = tuples(exact, "doc_id", "text")
    assert len(keep(left, {(d, s) for d, _, _, kept, s in brute.copies(left) if kept})) == len(left)

    near = stages["near_dedup"](spark, exact, folder)
    assert near.columns == docs.columns
    assert tuples(near, "doc_id") == ordered((d,) for d, _, _, kept in brute.near_classes(left) if kept)
    left = tuples(near, "doc_id", "text")
    clean = stages["decontamination"](spark, near, folder)
    judged = brute.contamination(left, [(1, cases.PASSAGE)])
    assert clean.columns == docs.columns
    assert tuples(clean, "doc_id", "text") == ordered(x for x, j in zip(left, judged) if not j[5])
    left = tuples(clean, "doc_id", "text")
    assert check_packing(stages["packing"](spark, clean, folder).collect(), left) == 0
    assert check_packing(corpus_pipeline.run(spark, folder).collect(), left) == 0


def test_pipeline_of_nothing(spark, tmp_path):
    assert corpus_pipeline.run(spark, _write(spark, tmp_path, [])).count() == 0


def test_the_pipeline_query_on_the_given_tables(spark, sf_dir):
    kept = {r.doc_id for r in QUERIES["pipeline"](spark, sf_dir).select("doc_id").collect()}
    rows = _docs(spark, sf_dir)
    copies = {d for d, _, _, k, _ in brute.copies(rows) if not k}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {j[0] for j in brute.contamination(rows, items) if j[5]}
    near = {d for d, _, _, k in brute.near_classes([x for x in rows if x[0] not in copies]) if not k}
    assert kept == {d for d, _ in rows} - copies - near - bad or kept == {d for d, _ in rows} - copies - near - bad - {
        d for d, t in rows if not language_id._LETTER.search(t or "")}


def test_without_labels_texts_with_a_letter_stay(spark):
    rows = [(1, "some words", None, "s", 10, "x"), (2, "123 %%%", None, "s", 7, "x"), (3, "слово", None, "s", 5, "x"), (4, None, None, "s", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, letter string")
    out = corpus_pipeline.language(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]
