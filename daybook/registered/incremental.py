"""Registered queries: landing by listing, blocked windows, as-of joins, stored fits, late versions, reach in a graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions.text import labelled
from daybook.operators import lineage, retract
from daybook.operators.asof import as_of
from daybook.operators.blocked import BLOCK, lagged, rolling_mean
from daybook.operators.daily_pick import replace_documents
from daybook.operators.enrich import failures
from daybook.operators.nearest import nearest_many
from daybook.operators.rollup import Measure
from daybook.operators.search import facet_filter
from daybook.plans.fit_state import advance_by_runs, fit_state
from daybook.plans.forecast import settled_history, state_forecast, walk_forward
from daybook.registered.base import (
    EVENT_METRICS, EVENT_NON_NEGATIVE, EVENTS_DAILY, LINE_METRICS, LINE_NON_NEGATIVE, LINES_DAILY, events_daily, lines_daily, table,
)
from daybook.registered.catalog import GRAPH_SQL, docs_as_assets, graph
from daybook.registered.forecasting import LINES_AS_OF, event_history, next_day_sql, walk_forward_sql
from daybook.sources.landing import new_versions

# ---- landing --------------------------------------------------------------------------------------

LANDED_UNTIL, SINCE, UNTIL = "2024-01-20 09:30:00", "2024-01-08 00:00:00", "2024-01-27 12:00:00"


def _naive(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _listing(events):
    """A file per event type and day, as old as its newest event."""
    source = F.concat_ws("/", F.lit("feed"), "event_type", F.to_date("ts").cast("string"))
    return events.groupBy(source.alias("source_url")).agg(
        F.max("ts").cast("timestamp_ntz").alias("fetched_at"), F.sum(F.length("props")).alias("bytes"))


def _land_backfill(spark, d):
    events = table(spark, d, "events")
    landed = _listing(events.where(F.col("ts") < _naive(LANDED_UNTIL)))
    return new_versions(landed, _listing(events), _naive(SINCE), _naive(UNTIL))


def _listing_sql(where: str = "true") -> str:
    return f"""SELECT concat_ws('/', 'feed', event_type, CAST(ts AS DATE)) AS source_url, CAST(MAX(ts) AS TIMESTAMP) AS fetched_at,
                      CAST(SUM(LENGTH(props)) AS BIGINT) AS bytes FROM events WHERE {where} GROUP BY ALL"""


# ---- long series ----------------------------------------------------------------------------------


def _event_series(spark, d):
    events = table(spark, d, "events").select("event_type", "event_id", "ts", "value")
    return events.withColumn(BLOCK, F.to_date("ts"))


def _roll7_events(spark, d):
    series = _event_series(spark, d)
    order = ["ts", "event_id"]
    rolled = rolling_mean(series, ["event_type"], order, ["value"], 7, "roll7")
    out = lagged(rolled, ["event_type"], order, "value", "before")
    return out.select("event_type", "event_id", "before", F.round("roll7_value", 6).alias("roll7_value"))


def _walk_forward_blocked(spark, d):
    history = settled_history(lines_daily(spark, d), LINES_AS_OF, LINE_METRICS)
    return walk_forward(history, LINE_METRICS, LINE_NON_NEGATIVE, block=F.trunc("date", "quarter"))


# ---- as of ----------------------------------------------------------------------------------------


def _purchases(spark, d):
    """The purchase that each event's user made last, at that time or before."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    bought = table(spark, d, "events").where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("bought_at"), F.col("event_id").alias("purchase_id"))
    return as_of(events, bought, ["user_id"], "ts", "bought_at", ["purchase_id"]).select("event_id", "purchase_id")


def _known_forecast(spark, d):
    """The last daily total of its type that was known when an event happened: those of days that were over."""
    events = table(spark, d, "events").select("event_id", F.col("event_type").alias("key"), "ts")
    known = events_daily(spark, d).select(
        "key", F.date_add("date", 1).cast("timestamp_ntz").alias("known_at"), "date", "value_sum")
    return as_of(events, known, ["key"], "ts", "known_at", ["date", "value_sum"]).select("event_id", "date", "value_sum")


# ---- stored fits ----------------------------------------------------------------------------------

STATE_DAYS = [f"2024-01-{day}" for day in range(16, 26)]


def _forecast_from_state(spark, d):
    """Fits up to the 15th, then ten runs that add a day each."""
    daily = events_daily(spark, d).select("key", "date", *EVENT_METRICS)
    state = fit_state(daily.where(F.col("date") < F.lit(STATE_DAYS[0]).cast("date")), EVENT_METRICS)
    return state_forecast(advance_by_runs(state, daily, STATE_DAYS, EVENT_METRICS), EVENT_METRICS, EVENT_NON_NEGATIVE)


# ---- late versions --------------------------------------------------------------------------------

LATE_MEASURES = (
    Measure("value_min", "min", "value", 2), Measure("value_max", "max", "value", 2),
    Measure("value_avg", "avg", "value", 2, scale=2), Measure("value_sum", "sum", "value", 2, scale=2),
)
LANDINGS = 3


def _rollup_late(spark, d):
    """The newest event of each type and hour counts; events land in three parts, in no order of time."""
    hour = F.date_trunc("HOUR", "ts").cast("timestamp_ntz")
    rows = table(spark, d, "events").select("event_type", hour.alias("hour"), "ts", "event_id", "value")
    keys, version, ties = ["event_type", "hour"], "ts", ["event_id"]
    stored, state = rows.limit(0), None
    for landing in range(LANDINGS):
        changes = retract.landing_changes(stored, rows.where(F.col("event_id") % LANDINGS == landing), keys, version, ties)
        more = retract.value_counts(changes, "event_type", "hour", LATE_MEASURES)
        state = more if state is None else retract.with_counts(state, more)
        stored = retract.with_changed_rows(stored, changes, keys)
    return retract.summary(state, LATE_MEASURES)


# ---- reach ----------------------------------------------------------------------------------------


def _lineage_reach(spark, d):
    """From every region and nation, along a graph with circles: every tenth supplier leads back to a region."""
    edges = graph(spark, d)
    starts = edges.where(F.col("upstream").startswith("region:") | F.col("upstream").startswith("nation:"))
    return lineage.reach(edges, starts.select(F.col("upstream").alias("node")))


# ---- many questions -------------------------------------------------------------------------------


def _cosine_many(spark, d):
    """Every vector with an id divisible by 20 against all."""
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    found, _ = nearest_many(vectors, "embedding", "vec_id", vectors.where("vec_id % 20 = 0"), k=5, size=64)
    return found.withColumnRenamed("id", "vec_id")


# ---- smaller helpers ------------------------------------------------------------------------------


def _replaced(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    fresh = docs.where("doc_id % 7 = 0").select("doc_id", "lang", F.lit("again").alias("source"))
    return replace_documents(docs, fresh, "doc_id", ["doc_id", "lang", "source"])


def _left_open(spark, d):
    """Documents without a letter as calls that failed."""
    tried = table(spark, d, "documents").select(
        "doc_id", F.when(~F.col("text").rlike("[a-z]"), F.lit("ValueError: no words")).alias("error"))
    return failures(tried, "doc_id", "text", "silver.extractions")


QUERIES = {
    "land_backfill": _land_backfill,
    "roll7_events": _roll7_events,
    "walk_forward_blocked": _walk_forward_blocked,
    "asof_purchase": _purchases,
    "asof_daily_total": _known_forecast,
    "forecast_from_state": _forecast_from_state,
    "rollup_late_versions": _rollup_late,
    "lineage_reach": _lineage_reach,
    "cosine_many": _cosine_many,
    "replace_documents": _replaced,
    "enrich_left_open": _left_open,
    "facet_filter": lambda s, d: facet_filter(docs_as_assets(s, d), kinds=["Document"], layers=["fr", "de"]).select("id", "layer"),
    "labelled_text": lambda s, d: table(s, d, "documents").select("doc_id", labelled(F.col("source"), F.substring("text", 1, 40)).alias("label")),
}

ORACLES = {
    "land_backfill": f"""
        WITH listing AS ({_listing_sql()}), landed AS ({_listing_sql(f"ts < TIMESTAMP '{LANDED_UNTIL}'")})
        SELECT * FROM listing l WHERE fetched_at >= TIMESTAMP '{SINCE}' AND fetched_at < TIMESTAMP '{UNTIL}' AND NOT EXISTS (
            SELECT 1 FROM landed o WHERE o.source_url = l.source_url AND o.fetched_at = l.fetched_at)""",
    "roll7_events": """
        SELECT event_type, event_id, LAG(value) OVER w AS before,
               CASE WHEN COUNT(value) OVER seven = 7 THEN ROUND(AVG(value) OVER seven, 6) END AS roll7_value FROM events
        WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id),
               seven AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "walk_forward_blocked": f"""
        WITH {LINES_DAILY} {walk_forward_sql(f"(SELECT * FROM daily WHERE date <= DATE '{LINES_AS_OF}')", LINE_METRICS, LINE_NON_NEGATIVE)}""",
    "asof_purchase": """
        WITH bought AS (SELECT user_id, ts, MAX(event_id) AS purchase_id FROM events WHERE event_type = 'purchase' GROUP BY ALL)
        SELECT e.event_id, b.purchase_id FROM events e ASOF LEFT JOIN bought b ON e.user_id = b.user_id AND e.ts >= b.ts""",
    "asof_daily_total": f"""
        WITH {EVENTS_DAILY} SELECT e.event_id, k.date, k.value_sum
        FROM (SELECT event_id, event_type, CAST(ts AS TIMESTAMP) AS at FROM events) e
        ASOF LEFT JOIN (SELECT *, CAST(date + 1 AS TIMESTAMP) AS known_at FROM daily) k ON k.key = e.event_type AND e.at >= k.known_at""",
    "forecast_from_state": f"""
        WITH {EVENTS_DAILY} {next_day_sql(event_history(STATE_DAYS[-1]), EVENT_METRICS, EVENT_NON_NEGATIVE)}""",
    "rollup_late_versions": """
        SELECT event_type AS key, CAST(ts AS DATE) AS date, ROUND(MIN(value), 2) AS value_min, ROUND(MAX(value), 2) AS value_max,
               ROUND(CAST(SUM(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(value), 2) AS value_avg,
               ROUND(CAST(SUM(CAST(value AS DECIMAL(18, 2))) AS DOUBLE), 2) AS value_sum
        FROM (SELECT * FROM events QUALIFY row_number() OVER (
            PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1)
        GROUP BY ALL""",
    "lineage_reach": f"""
        WITH RECURSIVE {GRAPH_SQL}, walk(start, node, hops) AS (
            SELECT DISTINCT upstream, upstream, 0 FROM graph WHERE upstream LIKE 'region:%' OR upstream LIKE 'nation:%'
            UNION SELECT w.start, g.downstream, w.hops + 1 FROM walk w JOIN graph g ON g.upstream = w.node WHERE w.hops < 12
        ) SELECT start, node, MIN(hops) AS hops FROM walk GROUP BY ALL""",
    "cosine_many": """
        WITH units AS (
            SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v
            FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
        ), scored AS (
            SELECT q.vec_id AS question, u.vec_id, ROUND(list_dot_product(q.v, u.v), 6) AS similarity
            FROM units u, units q WHERE q.vec_id % 20 = 0
        )
        SELECT question, CAST(row_number() OVER (PARTITION BY question ORDER BY similarity DESC, vec_id) AS INTEGER) AS rank, vec_id, similarity
        FROM scored QUALIFY rank <= 5""",
    "replace_documents": """
        SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0 THEN 'again' ELSE source END AS source FROM documents""",
    "enrich_left_open": """
        SELECT 'text' AS step, 'enriched' AS check_name, 'silver.extractions' AS target, 'warn' AS status,
               'left open for the next run: ' || doc_id || ', ValueError: no words' AS detail
        FROM documents WHERE NOT regexp_matches(text, '[a-z]')""",
    "facet_filter": "SELECT doc_id AS id, lang AS layer FROM documents WHERE lang IN ('fr', 'de')",
    "labelled_text": "SELECT doc_id, source || ': ' || substr(text, 1, 40) AS label FROM documents",
}
