"""Run registered queries against their SQL in DuckDB and report differences."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from daybook.registered.base import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def as_rows(t: pa.Table) -> tuple[list[str], list[tuple]]:
    names = sorted(t.column_names)
    columns = [t.column(n).to_pylist() for n in names]
    return names, sorted(zip(*columns), key=repr)


def types_of(t: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in t.schema}


def compare(spark_result: pa.Table, oracle: pa.Table) -> str:
    """Empty when equal, else a short description of the first difference."""
    names, mine = as_rows(spark_result)
    other_names, other = as_rows(oracle)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(mine) != len(other):
        return f"rows {len(mine)} != {len(other)}"
    a, b = types_of(spark_result), types_of(oracle)
    if a != b:
        return "types " + ", ".join(f"{n}: {a[n]} != {b[n]}" for n in names if a[n] != b[n])
    left, right = Counter(map(repr, mine)), Counter(map(repr, other))
    extra, missing = list((left - right).elements()), list((right - left).elements())
    return f"{len(extra)} of {len(mine)} rows, e.g. {extra[0]} against {missing[0]}" if extra else ""


def main(sf_dir: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from daybook.session import local_session

    spark = local_session(8)
    con = connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir).toArrow()
            took = time.time() - start
            if name in oracles:
                verdict = compare(result, con.sql(oracles[name]).to_arrow_table()) or "ok"
            else:
                verdict = "rows only"
            empty = " EMPTY" if result.num_rows == 0 else ""
            print(f"{name:28s} {took:6.2f}s {result.num_rows:7d} rows  {verdict[:600]}{empty}", flush=True)
            bad += verdict not in ("ok", "rows only")
        except Exception as e:  # report and go on with the next query
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:700]}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
