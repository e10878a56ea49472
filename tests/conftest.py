from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from daybook.session import local_session

    session = local_session(8, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF


def rows(df, *order):
    """Plain tuples, sorted where asked."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
