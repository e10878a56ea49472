"""Registered queries: rollups, versions, calendar features, writes into tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions.dates import run_id, utc_naive
from daybook.functions.text import clip
from daybook.operators.dedupe import latest_wins
from daybook.operators.features import add_season, lag_features, one_hot, roll7_features
from daybook.operators.rollup import daily_rollup
from daybook.plans import reports
from daybook.plans.forecast import settled_history
from daybook.registered.base import (
    EVENT_METRICS, EVENTS_DAILY, LINES_DAILY, ORDER_MEASURES, events_daily, events_with_k, lines_daily, table,
)
from daybook.sources.json_payload import unpack_payloads
from daybook.sources.landing import land_new_by_id, land_raw
from daybook.sources.tables import insert_if_absent, scoped_replace

AS_OF = "2024-01-25"
KEYS = ["click", "purchase", "view"]
METRIC_LIST = ", ".join(EVENT_METRICS)


def _latest_wins(spark, d):
    rows = table(spark, d, "events").select(
        "user_id", F.date_trunc("HOUR", "ts").cast("timestamp_ntz").alias("hour"),
        F.col("ts").alias("version"), "event_id", "event_type", "value",
    )
    return latest_wins(rows, ["user_id", "hour"], "version", ["event_id"])


def _json_arrays_to_rows(spark, d):
    """A payload of two points per event, made inside its row, and unpacked again."""
    def both(first, second):
        return F.array(first, second)

    def minute(ts):
        return F.date_format(ts, "yyyy-MM-dd'T'HH:mm")

    event, k = F.col("event_id").cast("double"), F.col("k").cast("double")
    hourly = F.struct(
        both(minute("ts"), minute(F.timestamp_add("HOUR", F.lit(1), "ts"))).alias("time"),
        both(event, event).alias("event_id"), both(F.col("value"), F.col("value") / 2).alias("value"), both(k, k + 1).alias("k"))
    payloads = events_with_k(spark, d).select(F.col("event_type").alias("key"), F.to_json(F.struct(hourly.alias("hourly"))).alias("raw_json"))
    unpacked = unpack_payloads(payloads, "raw_json", ["event_id", "value", "k"], keep=["key"])
    return unpacked.select("key", "ts", F.col("event_id").cast("long").alias("event_id"), "value", "k")


def _land_raw(spark, d):
    """Every event's JSON properties as a payload of its type."""
    payloads = table(spark, d, "events").select(
        "event_type", F.concat(F.lit("events/"), F.col("event_id").cast("string")).alias("source"), "props", "ts")
    landed = land_raw(payloads, "event_type", "source", "props", F.timestamp_add("DAY", F.lit(1), F.col("ts")))
    return landed.groupBy("key").agg(
        F.count("*").alias("rows_landed"), F.max("fetched_at").alias("last_fetched_at"),
        F.max("source_url").alias("last_source"), F.count_if(F.length("raw_json") > 0).alias("with_payload"),
    )


def _land_new_by_id(spark, d):
    landed = table(spark, d, "labels").select("doc_id")
    incoming = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    return land_new_by_id(landed, incoming, "doc_id", order=["source", "lang", "n_chars"])


def _slices(spark, d):
    daily = events_daily(spark, d).select("key", "date", "value_sum")
    old = daily.where(F.col("date") <= F.lit("2024-01-20").cast("date")).withColumn("batch", F.lit("old"))
    new = (
        daily.where(F.col("date").between(F.lit("2024-01-18").cast("date"), F.lit(AS_OF).cast("date")))
        .where(F.col("key").isin("click", "view"))
        .withColumn("batch", F.lit("new"))
    )
    return old, new


SLICES = f"""
WITH {EVENTS_DAILY},
old AS (SELECT key, date, value_sum, 'old' AS batch FROM daily WHERE date <= DATE '2024-01-20'),
new AS (SELECT key, date, value_sum, 'new' AS batch FROM daily
        WHERE date BETWEEN DATE '2024-01-18' AND DATE '2024-01-25' AND key IN ('click', 'view'))
"""


def _one_hot(spark, d):
    return one_hot(events_daily(spark, d).select("key", "date"), "key",
                   ["click", "error", "purchase", "signup", "view"], "key")


def _season(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return add_season(days).select("date", *[F.round(c, 9).alias(c) for c in ("doy_sin", "doy_cos")])


def _iso_offset(spark, d):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))
    return table(spark, d, "events").select("event_id", utc_naive(text).alias("issued_at"))


def _date_labels(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.date_format("ts", "EEEE").alias("weekday"),
        F.date_format("ts", "dd MMM yyyy").alias("day_label"), run_id(F.col("ts")).alias("run_id"),
    )


QUERIES = {
    "daily_rollup": lambda s, d: events_daily(s, d).orderBy("key", "date"),
    "daily_rollup_lineitem": lambda s, d: lines_daily(s, d),
    "daily_rollup_orders": lambda s, d: daily_rollup(
        table(s, d, "orders"), "o_orderpriority", "o_orderdate", ORDER_MEASURES),
    "latest_wins": _latest_wins,
    "json_arrays_to_rows": _json_arrays_to_rows,
    "json_field": lambda s, d: events_with_k(s, d).select("event_id", "k"),
    "iso_offset_utc": _iso_offset,
    "date_labels": _date_labels,
    "season_features": _season,
    "land_raw": _land_raw,
    "land_new_by_id": _land_new_by_id,
    "scoped_replace": lambda s, d: scoped_replace(*_slices(s, d), ["date"]),
    "insert_if_absent": lambda s, d: insert_if_absent(*_slices(s, d), ["key", "date"]),
    "settled_history": lambda s, d: settled_history(events_daily(s, d), AS_OF, EVENT_METRICS).orderBy("date", "key"),
    "lag_features": lambda s, d: lag_features(events_daily(s, d), EVENT_METRICS, depth=2),
    "roll7_features": lambda s, d: roll7_features(lines_daily(s, d), ["quantity_sum", "quantity_max"]).select(
        "key", "date", F.round("roll7_quantity_sum", 6).alias("roll7_quantity_sum"),
        F.round("roll7_quantity_max", 6).alias("roll7_quantity_max")),
    "one_hot": _one_hot,
    "distinct_keys": lambda s, d: reports.distinct_keys(events_daily(s, d)),
    "data_up_to": lambda s, d: reports.data_up_to(events_daily(s, d), AS_OF),
    "report_daily": lambda s, d: reports.report_daily(events_daily(s, d), KEYS, AS_OF, EVENT_METRICS),
    "report_hourly": lambda s, d: reports.newest_first(
        table(s, d, "events").select(F.col("event_type").alias("key"), "ts", "event_id", "value"),
        KEYS, "ts", ["event_id"]),
    "report_fetch_log": lambda s, d: reports.fetch_log(
        table(s, d, "pages").withColumn("key", F.regexp_extract("html", '<html lang="([a-z]*)"', 1)),
        "key", "page_id", "url", "html", ["de", "en", "fr"]),
    "table_preview": lambda s, d: reports.table_preview(
        table(s, d, "documents"), skip=["source"], order=["doc_id"], clip=clip),
    "table_preview_vectors": lambda s, d: reports.table_preview(
        table(s, d, "embeddings"), skip=[], order=["vec_id"], clip=clip),
}

ORACLES = {
    "daily_rollup": f"WITH {EVENTS_DAILY} SELECT * FROM daily ORDER BY key, date",
    "daily_rollup_lineitem": f"WITH {LINES_DAILY} SELECT * FROM daily",
    "daily_rollup_orders": """
        SELECT o_orderpriority AS key, CAST(o_orderdate AS DATE) AS date,
               ROUND(MIN(o_totalprice), 1) AS price_min, ROUND(MAX(o_totalprice), 1) AS price_max,
               ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE), 1) AS price_sum
        FROM orders GROUP BY ALL""",
    "latest_wins": """
        SELECT user_id, hour, version, event_id, event_type, value FROM (
            SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, ts AS version, event_id, event_type, value,
                   ROW_NUMBER() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) AS rn
            FROM events) WHERE rn = 1""",
    "json_arrays_to_rows": """
        SELECT event_type AS key, CAST(date_trunc('minute', ts) AS TIMESTAMP) + to_hours(i) AS ts, event_id,
               CASE i WHEN 0 THEN value ELSE value / 2 END AS value, CAST(json_extract_string(props, '$.k') AS DOUBLE) + i AS k
        FROM events, (VALUES (0), (1)) AS points(i)""",
    "json_field": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "iso_offset_utc": """
        SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) + INTERVAL 5 HOUR AS issued_at FROM events""",
    "date_labels": """
        SELECT event_id, dayname(ts) AS weekday, strftime(ts, '%d %b %Y') AS day_label,
               strftime(ts, '%Y%m%dT%H%M%S') AS run_id FROM events""",
    "season_features": """
        SELECT date, ROUND(SIN(2 * PI() * dayofyear(date) / 365.25), 9) AS doy_sin,
               ROUND(COS(2 * PI() * dayofyear(date) / 365.25), 9) AS doy_cos
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)""",
    "land_raw": """
        SELECT event_type AS key, COUNT(*) AS rows_landed, MAX(ts) + INTERVAL 1 DAY AS last_fetched_at,
               MAX('events/' || event_id) AS last_source, COUNT(*) FILTER (WHERE LENGTH(props) > 0) AS with_payload
        FROM events GROUP BY event_type""",
    "land_new_by_id": """
        SELECT doc_id, source, lang, n_chars FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "scoped_replace": SLICES + """
        SELECT * FROM old WHERE date NOT IN (SELECT date FROM new) UNION ALL SELECT * FROM new""",
    "insert_if_absent": SLICES + """
        SELECT * FROM old UNION ALL
        SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.key = new.key AND old.date = new.date)""",
    "settled_history": f"""
        WITH {EVENTS_DAILY} SELECT key, date, {METRIC_LIST} FROM daily WHERE date <= DATE '{AS_OF}' ORDER BY date, key""",
    "lag_features": f"WITH {EVENTS_DAILY} SELECT *, " + ", ".join(
        f"LAG({m}, {k}) OVER (PARTITION BY key ORDER BY date) AS lag_{k}_{m}" for m in EVENT_METRICS for k in (1, 2)
    ) + " FROM daily",
    "roll7_features": f"WITH {LINES_DAILY} SELECT key, date, " + ", ".join(
        f"""CASE WHEN COUNT({m}) OVER w = 7 THEN ROUND(AVG({m}) OVER w, 6) END AS roll7_{m}"""
        for m in ("quantity_sum", "quantity_max")
    ) + " FROM daily WINDOW w AS (PARTITION BY key ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)",
    "one_hot": f"WITH {EVENTS_DAILY} SELECT key, date, " + ", ".join(
        f"CAST(key = '{k}' AS INTEGER) AS key_{k}" for k in ("click", "error", "purchase", "signup", "view")
    ) + " FROM daily",
    "distinct_keys": "SELECT DISTINCT event_type AS key FROM events ORDER BY key",
    "data_up_to": f"SELECT MAX(CAST(ts AS DATE)) AS data_up_to FROM events WHERE CAST(ts AS DATE) <= DATE '{AS_OF}'",
    "report_daily": f"""
        WITH {EVENTS_DAILY} SELECT key, date, {METRIC_LIST} FROM daily
        WHERE key IN ('click', 'purchase', 'view') AND date <= DATE '{AS_OF}' ORDER BY date DESC, key""",
    "report_hourly": """
        SELECT event_type AS key, ts, event_id, value FROM events
        WHERE event_type IN ('click', 'purchase', 'view') ORDER BY ts DESC, event_id""",
    "report_fetch_log": """
        SELECT regexp_extract(html, '<html lang="([a-z]*)"', 1) AS key, page_id, url, CAST(LENGTH(html) AS INTEGER) AS payload_chars
        FROM pages WHERE regexp_extract(html, '<html lang="([a-z]*)"', 1) IN ('de', 'en', 'fr') ORDER BY page_id DESC""",
    "table_preview": """
        SELECT doc_id, CASE WHEN LENGTH(text) > 120 THEN text[1:120] || '...' ELSE text END AS text, lang, n_chars
        FROM documents ORDER BY doc_id LIMIT 5""",
    "table_preview_vectors": "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 5",
}
