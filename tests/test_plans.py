"""What the plans must and must not contain."""

from __future__ import annotations

import re
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from daybook.operators.dedupe import latest_wins
from daybook.operators.joins import lookup, matching, unmatched
from daybook.plans.forecast import stored_runs, walk_forward

QUERIES = {k: q for k, q in entry.queries().items() if not k.startswith("op") and k != "pipeline"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairs_no_python_rows_and_no_global_window(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert ("MapInPandas" in text) == (name == "enrich_batch")
    assert not re.search(r"Window .*\], \[\], \[", text)


def test_no_query_cuts_its_lineage():
    """Plans are whole: nothing is computed while they are built."""
    for name, module in list(sys.modules.items()):
        if name.startswith("daybook.registered"):
            assert not hasattr(module, "materialise"), name


def test_live_and_backtest_need_one_exchange(spark):
    daily = spark.createDataFrame([], "key string, date date, a double, b double")
    assert plan(stored_runs(daily, ["2024-01-20"], "2024-01-28", ["a", "b"])).count("Exchange") == 1


def test_backtest_needs_one_exchange(spark):
    daily = spark.createDataFrame([], "key string, date date, a double, b double")
    assert plan(walk_forward(daily, ["a", "b"])).count("Exchange") == 1


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["settled_history"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double,props:string>" in text
    assert "LessThan(ts,2024-01-28T05:00)" in plan(QUERIES["daily_pick"](spark, sf_dir))


def test_text_is_split_in_one_place(spark, sf_dir):
    # one expression with two branches: the plain split and the one for rare line ends
    assert plan(QUERIES["split_sections"](spark, sf_dir)).count("split(") == 2


def test_ranks_are_cut_before_the_exchange(spark, sf_dir):
    text = plan(QUERIES["cosine_topk"](spark, sf_dir))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_a_hot_key_reaches_the_exchange_once_per_task(spark):
    """A third of the rows share a key: the exchange carries one row of it per map task."""
    rows = spark.range(0, 60_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("version"))
    out = latest_wins(rows, ["k"], "version").where("k = 0").collect()
    assert [tuple(r) for r in out] == [(0, 59_997)]
    text = plan(latest_wins(rows, ["k"], "version"))
    assert "partial_max_by" in text and text.index("Exchange") < text.index("partial_max_by")


@pytest.fixture
def small_skew_limits(spark):
    """Limits at which the test's partitions count as large."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("join,kept", [(lookup, 300_000), (matching, 200_000), (unmatched, 100_000)])
def test_hot_rows_are_split(spark, small_skew_limits, join, kept):
    i = F.col("id")
    large = spark.range(0, 300_000, 1, 8).select(F.when(i % 3 == 0, 2).otherwise(i).alias("k"), F.xxhash64("id").alias("v"))
    small = spark.range(0, 300_000, 2, 8).select(i.alias("k"))
    side = small.withColumn("known", F.lit(True)) if join is lookup else small
    out = join(large, side, ["k"]).agg(F.count("*").alias("n"), F.sum(F.hash("k", "v")))
    assert out.collect()[0].n == kept
    assert "skew=true" in plan(out)


def test_null_keys_match_nothing(spark):
    large = spark.createDataFrame([(None,), (1,), (2,)], "k int")
    keys = spark.createDataFrame([(None,), (1,)], "k int")
    assert [r.k for r in matching(large, keys, ["k"]).collect()] == [1]
    assert {r.k for r in unmatched(large, keys, ["k"]).collect()} == {None, 2}
