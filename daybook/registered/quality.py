"""Registered queries: check suites, group counts, freshness, coverage, run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions.dates import run_id
from daybook.operators import quality as q
from daybook.plans import gates, reports
from daybook.registered.base import events_with_k, table

NOW = "2024-01-31 06:00:00"
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]
MIN_ORDERS = 3000

SUITE = (
    gates.Gate("raw", "orders", (
        q.not_empty(), q.no_nulls(["o_orderkey", "o_custkey", "o_orderdate"]), q.value_range("o_totalprice", 0, 400000))),
    gates.Gate("raw", "customer", (q.not_empty(), q.no_nulls(["c_custkey"]), q.non_negative("c_acctbal"))),
    gates.Gate("clean", "events", (
        q.not_empty(), q.no_nulls(["event_id", "ts", "value"]), q.plausible_temperature("value"),
        q.non_negative("value"), q.value_range("k", 0, 99))),
)


def _suite(spark, d):
    tables = {"orders": table(spark, d, "orders"), "customer": table(spark, d, "customer"),
              "events": events_with_k(spark, d)}
    return gates.run_gates(tables, SUITE)


FRESHNESS = (
    gates.Gate("clean", "events", tuple(q.fresh("ts", NOW, hours) for hours in (30, 10, 5))),
    gates.Gate("raw", "orders", (q.fresh("o_orderdate", NOW, 72),)),
)


def _freshness(spark, d):
    return gates.run_gates({t: table(spark, d, t) for t in ("events", "orders")}, FRESHNESS)


def _metadata(spark, d):
    """Pages as documented objects: the host, the page and the text of its first link, which may be missing."""
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    described = F.regexp_extract("html", '<a href="/[a-z]+">([a-z]+)</a>', 1)
    return table(spark, d, "pages").select(host.alias("object"), F.col("url").alias("column"), described.alias("description"))


def _group_record(spark, d):
    counts = q.group_counts(table(spark, d, "orders"), "o_orderpriority", PRIORITIES, MIN_ORDERS)
    return q.group_count_record(counts, "raw", "orders", MIN_ORDERS)


# A replayed log: every day of events is one run, checked on its own rows.
ENOUGH = q.Check("enough_rows", {"n": "count(*)"}, lambda at: (
    F.when(at("n") < 330, "warn").otherwise("pass"), F.concat(at("n").cast("string"), F.lit(" rows"))))
DAY_CHECKS = (q.not_empty(), q.value_range("value", 0, 350), q.non_negative("k"), q.no_nulls(["user_id"]), ENOUGH)


def _results(spark, d):
    days = events_with_k(spark, d).withColumn("day", F.to_date("ts"))
    checked = q.run_suite(days, "clean", "events", DAY_CHECKS, by=["day"])
    return checked.withColumn("run_id", run_id(F.col("day").cast("timestamp_ntz"))).drop("day")


def _runs(spark, d):
    days = events_with_k(spark, d).groupBy(F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"))
    started = days.select(run_id(F.col("day").cast("timestamp_ntz")).alias("run_id"), "started_at", "finished_at")
    error = F.when(F.col("n_fail") > 0, F.concat(F.col("n_fail").cast("string"), F.lit(" checks failed")))
    return started.join(q.status_counts(_results(spark, d)), "run_id").withColumn("error", error)


QUERIES = {
    "dq_suite": _suite,
    "dq_group_counts": lambda s, d: q.group_counts(table(s, d, "orders"), "o_orderpriority", PRIORITIES, MIN_ORDERS),
    "dq_group_record": _group_record,
    "dq_freshness": _freshness,
    "dq_documented": lambda s, d: q.documented(_metadata(s, d)),
    "dq_documented_records": lambda s, d: q.documented_records(_metadata(s, d), "catalog"),
    "dq_undocumented": lambda s, d: q.undocumented(_metadata(s, d)),
    "run_status": lambda s, d: q.status_counts(_results(s, d)),
    "run_history": lambda s, d: reports.run_history(_runs(s, d)),
    "run_checks": lambda s, d: reports.run_checks(_results(s, d), _runs(s, d)),
}


# ---- the same as SQL ----------------------------------------------------------------------


def _record(source: str, step: str, target: str, name: str, bad: str, what: str, fine: str) -> str:
    return f"""
    SELECT '{step}' AS step, '{name}' AS check_name, '{target}' AS target,
           CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS status,
           CASE WHEN n > 0 THEN n || ' rows: {what}' ELSE '{fine}' END AS detail
    FROM (SELECT COUNT(*) FILTER (WHERE {bad}) AS n FROM {source})"""


def _rows(source: str, step: str, target: str) -> str:
    return f"""
    SELECT '{step}' AS step, 'not_empty' AS check_name, '{target}' AS target,
           CASE WHEN n = 0 THEN 'fail' ELSE 'pass' END AS status,
           CASE WHEN n = 0 THEN 'empty' ELSE n || ' rows' END AS detail FROM (SELECT COUNT(*) AS n FROM {source})"""


def _nulls(source: str, step: str, target: str, columns: list[str]) -> str:
    bad = " OR ".join(f"{c} IS NULL" for c in columns)
    return _record(source, step, target, "no_nulls", bad, "NULL", f"no NULL in {', '.join(columns)}")


def _fresh(step: str, target: str, column: str, hours: int) -> str:
    return f"""
    SELECT '{step}' AS step, 'fresh' AS check_name, '{target}' AS target,
           CASE WHEN age > {hours} THEN 'fail' WHEN age > {hours} / 2 THEN 'warn' ELSE 'pass' END AS status,
           printf('%.1f h old, limit {hours} h', age) AS detail
    FROM (SELECT date_sub('second', CAST(MAX({column}) AS TIMESTAMP), TIMESTAMP '{NOW}') / 3600 AS age FROM {target})"""


_E = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"
_SUITE_SQL = [
    _rows("orders", "raw", "orders"), _nulls("orders", "raw", "orders", ["o_orderkey", "o_custkey", "o_orderdate"]),
    _record("orders", "raw", "orders", "value_range", "o_totalprice < 0 OR o_totalprice > 400000",
            "o_totalprice outside [0, 400000]", "o_totalprice within [0, 400000]"),
    _rows("customer", "raw", "customer"), _nulls("customer", "raw", "customer", ["c_custkey"]),
    _record("customer", "raw", "customer", "non_negative", "c_acctbal < 0", "c_acctbal is negative", "c_acctbal never negative"),
    _rows(_E, "clean", "events"), _nulls(_E, "clean", "events", ["event_id", "ts", "value"]),
    _record(_E, "clean", "events", "plausible_temperature", "value < -90 OR value > 60",
            "value outside [-90, 60]", "value within [-90, 60]"),
    _record(_E, "clean", "events", "non_negative", "value < 0", "value is negative", "value never negative"),
    _record(_E, "clean", "events", "value_range", "k < 0 OR k > 99", "k outside [0, 99]", "k within [0, 99]"),
]

_EXPECTED = ", ".join(f"('{p}')" for p in PRIORITIES)
_GROUPS = f"""
counts AS (
    SELECT g AS "group", COUNT(o_orderkey) AS n, CASE WHEN COUNT(o_orderkey) < {MIN_ORDERS} THEN 'fail' ELSE 'pass' END AS status
    FROM (VALUES {_EXPECTED}) e(g) LEFT JOIN orders ON o_orderpriority = g GROUP BY g)"""

_DAYS = """
days AS (
    SELECT strftime(CAST(ts AS DATE), '%Y%m%dT000000') AS run_id, MIN(ts) AS started_at, MAX(ts) AS finished_at,
           COUNT(*) AS n, COUNT(*) FILTER (WHERE value < 0 OR value > 350) AS out_of_range
    FROM events GROUP BY CAST(ts AS DATE)),
results AS (
    SELECT run_id, 'not_empty' AS check_name, 'pass' AS status, n || ' rows' AS detail FROM days
    UNION ALL SELECT run_id, 'value_range', CASE WHEN out_of_range > 0 THEN 'fail' ELSE 'pass' END,
           CASE WHEN out_of_range > 0 THEN out_of_range || ' rows: value outside [0, 350]' ELSE 'value within [0, 350]' END FROM days
    UNION ALL SELECT run_id, 'non_negative', 'pass', 'k never negative' FROM days
    UNION ALL SELECT run_id, 'no_nulls', 'pass', 'no NULL in user_id' FROM days
    UNION ALL SELECT run_id, 'enough_rows', CASE WHEN n < 330 THEN 'warn' ELSE 'pass' END, n || ' rows' FROM days),
counted AS (
    SELECT run_id, CAST(COUNT(*) FILTER (WHERE status = 'pass') AS INTEGER) AS n_pass,
           CAST(COUNT(*) FILTER (WHERE status = 'warn') AS INTEGER) AS n_warn,
           CAST(COUNT(*) FILTER (WHERE status = 'fail') AS INTEGER) AS n_fail,
           CASE WHEN COUNT(*) FILTER (WHERE status = 'fail') > 0 THEN 'failed'
                WHEN COUNT(*) FILTER (WHERE status = 'warn') > 0 THEN 'warning' ELSE 'success' END AS status
    FROM results GROUP BY run_id)"""
_LIGHT = """CASE status WHEN 'success' THEN 'green' WHEN 'pass' THEN 'green' WHEN 'warning' THEN 'yellow'
    WHEN 'warn' THEN 'yellow' WHEN 'failed' THEN 'red' WHEN 'fail' THEN 'red' ELSE 'white' END AS light"""
_METADATA = """
metadata AS (
    SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS object, url AS "column",
           regexp_extract(html, '<a href="/[a-z]+">([a-z]+)</a>', 1) AS description FROM pages)"""

ORACLES = {
    "dq_suite": " UNION ALL ".join(_SUITE_SQL),
    "dq_group_counts": f"WITH {_GROUPS} SELECT * FROM counts",
    "dq_group_record": f"""
        WITH {_GROUPS}, short AS (SELECT string_agg("group", ', ' ORDER BY "group") AS names FROM counts WHERE status = 'fail')
        SELECT 'raw' AS step, 'group_counts' AS check_name, 'orders' AS target,
               CASE WHEN names IS NULL THEN 'pass' ELSE 'fail' END AS status,
               CASE WHEN names IS NULL THEN 'at least {MIN_ORDERS} rows for every group'
                    ELSE 'fewer than {MIN_ORDERS} rows for ' || names END AS detail FROM short""",
    "dq_freshness": " UNION ALL ".join(
        [_fresh("clean", "events", "ts", h) for h in (30, 10, 5)] + [_fresh("raw", "orders", "o_orderdate", 72)]),
    "dq_documented": f"""
        WITH {_METADATA} SELECT object, COUNT(*) AS n_entries, COUNT(*) FILTER (WHERE description = '') AS n_undocumented,
               CASE WHEN COUNT(*) FILTER (WHERE description = '') > 0 THEN 'fail' ELSE 'pass' END AS status
        FROM metadata GROUP BY object""",
    "dq_undocumented": f"""WITH {_METADATA} SELECT object, "column" FROM metadata WHERE description = ''""",
    "dq_documented_records": f"""
        WITH {_METADATA} SELECT 'catalog' AS step, 'documented' AS check_name, object AS target, 'fail' AS status,
               'no description of ' || "column" AS detail FROM metadata WHERE description = ''
        UNION ALL SELECT 'catalog', 'documented', object, 'pass', 'all documented' FROM metadata
        GROUP BY object HAVING bool_and(description <> '')""",
    "run_status": f"WITH {_DAYS} SELECT * FROM counted",
    "run_history": f"""
        WITH {_DAYS} SELECT run_id, started_at, finished_at, status, {_LIGHT}, n_pass, n_warn, n_fail,
               date_sub('second', started_at, finished_at) AS duration_s,
               CASE WHEN n_fail > 0 THEN n_fail || ' checks failed' END AS error
        FROM days JOIN counted USING (run_id) ORDER BY started_at DESC LIMIT 14""",
    "run_checks": f"""
        WITH {_DAYS} SELECT {_LIGHT}, 'clean' AS step, check_name, 'events' AS target, detail
        FROM results WHERE run_id = (SELECT arg_max(run_id, started_at) FROM days)""",
}
