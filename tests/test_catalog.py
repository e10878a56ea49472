"""Checks, run log, lineage, metrics and search."""

from __future__ import annotations

from datetime import datetime

import pytest

from daybook.operators import lineage, quality as q, search
from daybook.plans import catalog, gates
from daybook.plans.metrics import Metric, evaluate, metric_definitions
from daybook.schemas import LINEAGE_NODES
from tests.conftest import rows


def _status(spark, values, check, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return q.run_suite(df, "s", "t", [check]).first()


@pytest.mark.parametrize("values,check,status", [
    ([], q.not_empty(), "fail"), ([1.0], q.not_empty(), "pass"),
    ([1.0, None], q.no_nulls(["v"]), "fail"), ([1.0], q.no_nulls(["v"]), "pass"),
    ([None, -90.0, 60.0], q.plausible_temperature("v"), "pass"), ([60.1], q.plausible_temperature("v"), "fail"),
    ([None, 0.0], q.non_negative("v"), "pass"), ([-0.1], q.non_negative("v"), "fail"),
    ([None, 0.0, 30.0], q.value_range("v", 0, 30), "pass"), ([30.5], q.value_range("v", 0, 30), "fail"),
])
def test_checks(spark, values, check, status):
    assert _status(spark, values, check).status == status


def test_unverified_evidence_only_warns(spark):
    assert _status(spark, [True, None], q.evidence_verified("v"), "boolean").status == "pass"
    assert _status(spark, [True, False], q.evidence_verified("v"), "boolean").status == "warn"


@pytest.mark.parametrize("newest,status", [
    (None, "fail"), (datetime(2024, 1, 1, 20), "pass"), (datetime(2024, 1, 1, 18), "warn"), (datetime(2024, 1, 1, 13), "fail"),
])
def test_freshness(spark, newest, status):
    check = q.fresh("v", "2024-01-02 00:00:00", 10)
    assert _status(spark, [newest] if newest else [], check, "timestamp_ntz").status == status


def test_first_bad_column_is_reported(spark):
    df = spark.createDataFrame([(1, None, None)], "a int, b int, c int")
    assert q.run_suite(df, "s", "t", [q.no_nulls(["a", "b", "c"])]).first().detail == "1 rows: b is NULL"


def test_group_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("z",)], "k string")
    counts = q.group_counts(df, "k", ["a", "b", "c"], 1)
    assert rows(counts, "group") == [("a", 2, "pass"), ("b", 1, "pass"), ("c", 0, "fail")]
    assert q.group_count_record(counts, "s", "t", 1).first().detail == "fewer than 1 rows for c"


def test_documented(spark):
    meta = spark.createDataFrame([("t", "a", "x"), ("t", "b", ""), ("u", "a", "y"), ("u", "b", None)],
                                 "object string, column string, description string")
    assert rows(q.undocumented(meta), "object") == [("t", "b"), ("u", "b")]
    records = q.documented_records(meta, "s").select("target", "status", "detail")
    assert {r.detail for r in records.where("status = 'fail'").collect()} == {"no description of b"}


def test_run_log_records_success_warning_and_failure(spark):
    data = spark.createDataFrame([(1.0, True), (2.0, False)], "v double, ok boolean")

    def run(second, *checks):
        log = gates.RunLog(spark, datetime(2024, 1, 1, 0, 0, second), runs="t_ops.runs", results="t_ops.results")
        with log:
            log.record(gates.run_gates({"d": data}, [gates.Gate("silver", "d", checks)]))

    run(1, q.not_empty())
    run(2, q.not_empty(), q.evidence_verified("ok"))
    with pytest.raises(q.DataQualityError, match="v outside"):
        run(3, q.not_empty(), q.value_range("v", 0, 1))
    with pytest.raises(ZeroDivisionError):
        with gates.RunLog(spark, datetime(2024, 1, 1, 0, 0, 4), runs="t_ops.runs", results="t_ops.results"):
            1 / 0
    log = spark.table("t_ops.runs").select("run_id", "status", "n_pass", "n_warn", "n_fail")
    assert rows(log, "run_id") == [
        ("20240101T000001", "success", 1, 0, 0), ("20240101T000002", "warning", 1, 1, 0),
        ("20240101T000003", "failed", 1, 0, 1), ("20240101T000004", "failed", 0, 0, 0)]
    assert spark.table("t_ops.results").count() == 5


NODES = [
    ("api", "source", "API", "outside", None, []), ("bronze.raw", "table", None, None, "land.py", ["api"]),
    ("gold.day", "table", None, None, "roll.py", ["bronze.raw", "ghost"]), ("gold.v", "view", None, None, None, ["gold.day"]),
    ("gold.gone", "table", None, None, None, []),
]


def _nodes(spark):
    return spark.createDataFrame(NODES, LINEAGE_NODES)


def test_lineage(spark):
    nodes = _nodes(spark)
    edges = lineage.declared_edges(nodes)
    typed = lineage.lineage_edges(edges, nodes).select("upstream", "upstream_type", "downstream")
    assert rows(typed, "upstream")[0] == ("api", "source", "bronze.raw")
    assert rows(lineage.unknown_upstream(edges, nodes)) == [("ghost", "gold.day")]
    around = lineage.neighbours(edges).where("node = 'gold.day'")
    assert rows(around.select("direction", "neighbour"), "direction", "neighbour") == [
        ("downstream", "gold.v"), ("upstream", "bronze.raw"), ("upstream", "ghost")]


def test_lineage_problems(spark):
    objects = spark.createDataFrame([
        ("bronze.raw", None), ("gold.day", None), ("gold.extra", None),
        ("gold.v", "SELECT * FROM gold.day JOIN gold.extra USING (k)"),
    ], "name string, view_sql string")
    texts = spark.createDataFrame([
        ("roll.py", "reads bronze.raw and gold.extra, writes gold.day; bronze.fetched_at is a column"),
        ("other.py", "reads gold.extra"),
    ], "path string, text string")
    assert [r[0] for r in rows(lineage.lineage_problems(_nodes(spark), objects, texts), "problem")] == [
        "gold.day lists unknown upstream ghost", "gold.extra: exists but not declared", "gold.gone: declared but missing",
        "roll.py references undeclared gold.extra", "view gold.v reads undeclared gold.extra"]


def test_metrics_share_a_pass_and_respect_filters(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 5.0), ("b", 2, 1.0)], "key string, d int, v double")
    metrics = [Metric("n", "N", "", "t", "COUNT(*) FILTER (WHERE v > 1)", "TRUE", ""),
               Metric("avg", "Avg", "", "t", "ROUND(AVG(v), 1)", "d > 1", "")]
    assert rows(evaluate(df, metrics), "key", "metric") == [("a", "avg", 5.0), ("a", "n", 2.0), ("b", "avg", 1.0), ("b", "n", 0.0)]
    assert rows(evaluate(df, metrics, keys=["b"]), "metric") == [("b", "avg", 1.0), ("b", "n", 0.0)]
    assert metric_definitions(spark, metrics).count() == 2


GLOSSARY = {"rain": ["precipitation", "wet"], "raw": ["bronze"], "damp": ["wet", "moist"]}
COLS = "array<struct<name:string,description:string>>"
ASSETS = [
    ("gold.day", "gold.day", "Table", "gold", "Daily rain totals", [("precipitation_mm", "amount"), ("training_rows", "count")]),
    ("bronze.raw", "bronze.raw", "Table", "bronze", "Payloads", [("raw_json", "as received, wet or dry")]),
    ("silver.wet", "silver.wet", "View", "silver", "", [(f"wet_{i}", "") for i in range(6)]),
    ("ops.runs", "ops.runs", "Table", "ops", "Runs", []),
    ("zz", "A source", "Source", "outside", "", []),
]


def _search(spark, query):
    assets = spark.createDataFrame(ASSETS, f"id string, name string, kind string, layer string, description string, columns {COLS}")
    return search.search(assets, query, GLOSSARY)


def test_search_weights_synonyms_and_bonus(spark):
    found = search.ranked(_search(spark, "rain"))
    assert rows(found.select("id", "relevance", "matched_columns")) == [
        ("silver.wet", 8.0, [f"wet_{i}" for i in range(6)]),   # synonym in the name 6.0, bonus limited to 2
        ("gold.day", 4.5, ["precipitation_mm"]),               # word in the description 4.0, one column
        ("bronze.raw", 1.4, ["raw_json"]),                     # synonym in a column description 0.9
    ]


def test_search_needs_every_word_and_word_starts(spark):
    assert [r.id for r in _search(spark, "the rain raw").collect()] == ["bronze.raw"]
    assert _search(spark, "rain nothing").count() == 0
    assert [r.id for r in _search(spark, "rows").collect()] == ["gold.day"]
    assert _search(spark, "ain").count() == 0


def test_empty_query_lists_by_layer(spark):
    assert [r.id for r in search.ranked(_search(spark, "the of")).collect()] == [
        "gold.day", "silver.wet", "bronze.raw", "ops.runs", "zz"]


def test_top_facets_and_words(spark):
    everything = _search(spark, "")
    assert rows(search.top_results(everything, 3).select("n_more")) == [(2,)] * 3
    assert rows(search.facets(everything).where("facet = 'kind'").select("value", "n"), "value") == [
        ("Source", 1), ("Table", 3), ("View", 1)]
    assert search.facet_filter(everything, kinds=["Table"], layers=["gold", "ops"]).count() == 2
    assert search.words_to_mark("wet", GLOSSARY) == ["precipitation", "moist", "damp", "rain", "wet"]
    assert search.Related(GLOSSARY).of("wet") == ["rain", "precipitation", "damp", "moist"]


def test_expand_terms(spark):
    df = spark.createDataFrame([(1, "The rain of raw")], "id int, t string")
    assert rows(search.expand_terms(df, "t", ["id"], GLOSSARY).drop("id"), "term", "word") == [
        ("rain", "precipitation", 0.6), ("rain", "rain", 1.0), ("rain", "wet", 0.6), ("raw", "bronze", 0.6), ("raw", "raw", 1.0)]


def test_asset_index(spark):
    objects = spark.createDataFrame([("gold.day", "Table", "gold", None), ("gold.v", "View", "gold", "a view")],
                                    "id string, kind string, layer string, description string")
    columns = catalog.column_rows({"gold.day": spark.createDataFrame([], "key string, v double")}, {"gold.day.v": "value"})
    metrics = metric_definitions(spark, [Metric("n", "Number", "How many", "gold.day", "COUNT(*)", "TRUE", "rows")])
    nodes = _nodes(spark)
    index = catalog.asset_index(objects, columns, metrics, nodes, lineage.declared_edges(nodes))
    by_id = {r.id: r for r in index.collect()}
    assert set(by_id) == {"gold.day", "gold.v", "metric:n", "api"}
    day = by_id["gold.day"]
    assert [c.name for c in day.columns] == ["key", "v"] and day.columns[1].description == "value"
    assert (day.upstream, day.downstream, day.metrics, day.built_by) == (["bronze.raw", "ghost"], ["gold.v"], ["metric:n"], "roll.py")
    assert by_id["api"].name == "API" and by_id["api"].layer == catalog.OUTSIDE_LAYER
    assert [r.id for r in search.ranked(search.search(index, "number", {})).collect()] == ["metric:n"]
    assert [r.id for r in search.search(index, "rows", {}).collect()] == ["metric:n"]
