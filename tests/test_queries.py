"""Every registered query against its SQL, and the shape of the registry."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

# those of the folder for training data are tested in tests/llm
QUERIES = {k: q for k, q in entry.queries().items() if not k.startswith("op") and k != "pipeline"}
ORACLES = {k: sql for k, sql in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir).toArrow()
    assert compare(result, duck.sql(ORACLES[name]).to_arrow_table()) == ""


def test_rows_only(spark, sf_dir):
    assert QUERIES["asset_index"](spark, sf_dir).count() == 20


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["key", "date"]
