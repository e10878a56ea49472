"""Registered queries: sections, daily picks, grounding, enrichment, extraction, snippets, comparison of calls."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.text import highlight, normalise, snippet, stands_in
from daybook.operators.daily_pick import daily_pick, incremental_todo
from daybook.operators.enrich import FieldRule, enrich, extract_fields
from daybook.operators.quality import evidence_verified, run_suite
from daybook.operators.sections import HEADER, split_sections
from daybook.operators.vectors import cosine_topk, unit
from daybook.plans.three_way import three_way_compare
from daybook.registered.base import events_daily, events_with_k, table
from daybook.registered.forecasting import AS_OF, FORECASTS, stored_forecasts

# ---- sections ------------------------------------------------------------------------

# Lines that open or close a section in the test documents: (line start, what replaces it).
OPENERS = ("The", "In", "La", "De", "Der", "And", "En")
CLOSERS = ("Of", "Is", "Que")


def _with_headers(c):
    for w in OPENERS:
        c = F.replace(c, F.lit(f"\n{w} "), F.lit(f"\n.{w.upper()} PART /A/... "))
    for w in CLOSERS:
        c = F.replace(c, F.lit(f"\n{w} "), F.lit(f"\n && \n{w} "))
    return c


def _with_headers_sql(c: str) -> str:
    for w in OPENERS:
        c = f"replace({c}, chr(10) || '{w} ', chr(10) || '.{w.upper()} PART /A/... ')"
    for w in CLOSERS:
        c = f"replace({c}, chr(10) || '{w} ', chr(10) || ' && ' || chr(10) || '{w} ')"
    return c


def _split_sections(spark, d):
    docs = table(spark, d, "documents").select("doc_id", _with_headers(F.col("text")).alias("body"))
    return split_sections(docs, "body", ["doc_id"])


SPLIT = f"""
WITH docs AS (SELECT doc_id, string_split({_with_headers_sql('text')}, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
marked AS (
    SELECT doc_id, pos, line, trim(line) AS bare,
           regexp_matches(trim(line), '{HEADER}') AS opens,
           trim(line) IN ('&&', '$$') AS closes FROM lines),
numbered AS (
    SELECT *, SUM(CASE WHEN opens OR closes THEN 1 ELSE 0 END) OVER (
        PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS part FROM marked),
parts AS (
    SELECT doc_id, part, MIN(pos) AS pos, bool_or(opens) AS is_section,
           MAX(CASE WHEN opens THEN trim(regexp_extract(bare, '{HEADER}', 1)) END) AS section_name,
           trim(regexp_replace(string_agg(
               CASE WHEN opens THEN regexp_extract(bare, '{HEADER}', 2) ELSE line END,
               ' ' ORDER BY pos), '\\s+', ' ', 'g')) AS content
    FROM numbered GROUP BY doc_id, part)
SELECT doc_id, CAST(ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS INTEGER) AS section_index,
       section_name, content
FROM parts WHERE is_section AND LENGTH(content) >= 40"""

# ---- daily picks ------------------------------------------------------------------------


def _documents(spark, d):
    return events_with_k(spark, d).select("event_id", F.col("ts").alias("issued_at"), "value", "k")


def _picks(spark, d):
    return daily_pick(_documents(spark, d), "issued_at", "event_id", AS_OF)


def _todo(spark, d):
    done = events_daily(spark, d).where((F.col("key") == "signup") & (F.col("value_avg") > 50))
    return incremental_todo(_picks(spark, d), done.select(F.col("date").alias("target_date")))


PICKS = f"""
picks AS (
    SELECT run_date, event_id, issued_at, value, k FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY run_date ORDER BY issued_at DESC, event_id DESC) AS rn FROM (
            SELECT event_id, ts AS issued_at, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                   CAST(ts - INTERVAL 5 HOUR AS DATE) + 1 AS run_date FROM events)
        WHERE run_date > (SELECT MIN(CAST(ts AS DATE)) FROM events) AND run_date <= DATE '{AS_OF}')
    WHERE rn = 1)"""

# ---- grounding ----------------------------------------------------------------------------


def _quotes(spark, d):
    """Three quotes per page against the whole article: its title in small letters, an advert, a blank."""
    title = F.replace(F.lower(F.regexp_extract("html", "<title>([^<]*)</title>", 1)), F.lit(" "), F.lit("  "))
    advert = F.regexp_extract("html", '<div class="ad">([^<]*)</div>', 1)
    quotes = F.array(*[F.struct(F.lit(n).alias("kind"), c.alias("quote"))
                       for n, c in (("title", title), ("advert", advert), ("blank", F.lit(" ")))])
    article = F.regexp_extract("html", "(?s)</h1>(.*)</article>", 1)
    quoted = table(spark, d, "pages").select("page_id", normalise(article).alias("article"), F.inline(quotes))
    return quoted.select("page_id", "kind", stands_in(F.col("quote"), F.col("article")).alias("verified"))


def _norm_sql(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '\\s+', ' ', 'g'))"


GROUNDING = f"""
quotes AS (
    SELECT page_id, regexp_extract(html, '(?s)</h1>(.*)</article>', 1) AS article,
           unnest(['title', 'advert', 'blank']) AS kind,
           unnest([replace(lower(regexp_extract(html, '<title>([^<]*)</title>', 1)), ' ', '  '),
                   regexp_extract(html, '<div class="ad">([^<]*)</div>', 1), ' ']) AS quote FROM pages),
grounded AS (
    SELECT page_id, kind, LENGTH({_norm_sql('quote')}) > 0
           AND contains({_norm_sql('article')}, {_norm_sql('quote')}) AS verified FROM quotes)"""

# ---- enrichment and extraction ---------------------------------------------------------------

LETTERS = "abcdefgh"


def letter_counter():
    """A small deterministic stand-in for an embedding call; refuses texts that hold an address.

    The inner function travels to the executors by value, so they need not have this package.
    """
    letters = LETTERS

    def count(text: str) -> list[int]:
        if "@" in text:
            raise ValueError("holds an address")
        return [text.count(c) for c in letters]

    return count


def _enrich(spark, d):
    done = enrich(table(spark, d, "documents"), "text", ["doc_id"], letter_counter(), T.ArrayType(T.IntegerType()))
    return done.select("doc_id", F.array_join("result", ",").alias("vector"), "error")


RULES = (
    FieldRule("license_version", r"version ([0-9]+)", "int", requires="version "),
    FieldRule("address", r"([0-9A-Za-z._-]+@[a-z0-9.]+[a-z])", requires="@"),
    FieldRule("host", r"([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})"),
    FieldRule("license_kind", r"(?i)licensed under the ([a-z]+)", allowed=("gnu", "mit", "apache")),
    FieldRule("language_hint", r"^([A-Za-z]+)", allowed=("the", "of", "la", "der")),
)
MENTIONS = ("license", "token", "the", "der")


def _extract(spark, d):
    fields = extract_fields(table(spark, d, "documents"), "text", ["doc_id"], RULES, MENTIONS)
    return fields.withColumn("mentions", F.array_join("mentions", ","))


# ---- calls, model and reality ------------------------------------------------------------------


def three_way(spark, d):
    daily, forecasts = stored_forecasts(spark, d)
    k = F.col("k")
    calls = _picks(spark, d).select(
        F.date_add("run_date", 1).alias("target_date"), "issued_at",
        F.when(k % 3 == 0, "none").when(k % 3 == 1, "possible").otherwise("likely").alias("call"),
        F.col("value").alias("high_f"), (F.col("value") / 2).alias("low_f"), k.cast("double").alias("gust_mph"),
        F.when(k % 7 != 0, k % 2 == 1).alias("verified"),
        F.when(k % 5 == 0, F.array(F.lit("wind"), F.lit("flood"))).otherwise(F.array().cast("array<string>")).alias("hazards"),
        F.concat(F.lit("k is "), k.cast("string")).alias("summary"),
    )
    return three_way_compare(calls, forecasts, daily, "purchase", AS_OF, event_metric="value_sum",
                             high_metric="value_max", low_metric="value_min", wind_metric="k_avg", threshold=3300)


# Calls are scored against a table of what each word says about the day; a hedge says nothing. What is not
# known (no settled day, no forecast, no verdict) leaves the comparison NULL by itself.
THREE_WAY = f"""{FORECASTS}, {PICKS},
chosen AS (
    SELECT target_date, arg_min(f, (CAST(is_backtest AS INTEGER), model_type)) AS f
    FROM forecasts AS f WHERE key = 'purchase' GROUP BY target_date),
reality AS (
    SELECT date AS target_date, value_max, value_min, value_sum, k_avg FROM daily
    WHERE key = 'purchase' AND date < DATE '{AS_OF}'),
says(call, event) AS (VALUES ('none', FALSE), ('likely', TRUE)),
said AS (
    SELECT *, run_date + 1 AS target_date, ['none', 'possible', 'likely'][k % 3 + 1] AS call,
           CASE WHEN k % 7 > 0 THEN k % 2 = 1 END AS verified FROM picks),
compared AS (
    SELECT 'purchase' AS key, target_date, issued_at, call, ROUND((value - 32) * 5 / 9, 1) AS call_high,
           ROUND((value / 2 - 32) * 5 / 9, 1) AS call_low, ROUND(CAST(k AS DOUBLE) * 1.609, 1) AS call_gust,
           CASE WHEN k % 5 = 0 THEN 'wind,flood' ELSE '' END AS hazards, 'k is ' || k AS summary, verified,
           f.predicted_value_max AS model_high, f.predicted_value_min AS model_low, f.predicted_value_sum AS model_amount,
           f.is_backtest AS model_is_backtest, value_max AS actual_high, value_min AS actual_low, value_sum AS actual_amount,
           k_avg AS actual_wind,
           CASE WHEN verified IS DISTINCT FROM FALSE THEN event = (value_sum > 3300) END AS call_correct,
           (f.predicted_value_sum > 3300) = (value_sum > 3300) AS model_correct
    FROM said LEFT JOIN says USING (call) LEFT JOIN chosen USING (target_date) LEFT JOIN reality USING (target_date))"""

# ---- vectors -----------------------------------------------------------------------------------


QUESTIONS = 10


def _cosine(spark, d):
    """Ten questions, the vectors with the smallest ids, found by the scan itself."""
    vectors = table(spark, d, "embeddings")
    few = vectors.where(F.col("vec_id") < QUESTIONS).groupBy("vec_id").agg(F.first("embedding").alias("v"))
    held = few.agg(F.map_from_entries(F.collect_list(F.struct("vec_id", unit(F.col("v"))))).alias("m")).select("m").scalar()
    questions = {str(i): F.try_element_at(held, F.lit(i).cast("long")) for i in range(QUESTIONS)}
    return cosine_topk(vectors, "embedding", "vec_id", questions, k=5)


QUERIES = {
    "split_sections": _split_sections,
    "daily_pick": _picks,
    "incremental_todo": _todo,
    "grounding": _quotes,
    "dq_evidence": lambda s, d: run_suite(_quotes(s, d), "text", "pages", [evidence_verified("verified")], by=["kind"]),
    "enrich_batch": _enrich,
    "extract_fields": _extract,
    "snippet": lambda s, d: table(s, d, "documents").select("doc_id", snippet(F.col("text")).alias("snippet")),
    "highlight": lambda s, d: table(s, d, "documents").select(
        "doc_id", highlight(F.col("text"), ["thou", "ment", "le"]).alias("highlighted")),
    "three_way_compare": lambda s, d: three_way(s, d).withColumn("hazards", F.array_join("hazards", ",")).orderBy(F.desc("target_date")),
    "cosine_topk": _cosine,
}

_NON_EMPTY = "NULLIF(regexp_extract(text, '{0}', 1), '')"

ORACLES = {
    "split_sections": SPLIT,
    "daily_pick": f"WITH {PICKS} SELECT * FROM picks",
    "incremental_todo": f"""
        WITH {PICKS} SELECT run_date + 1 AS target_date, * FROM picks WHERE run_date + 1 NOT IN (
            SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'signup' GROUP BY ALL
            HAVING ROUND(CAST(SUM(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / COUNT(value), 2) > 50)""",
    "grounding": f"WITH {GROUNDING} SELECT * FROM grounded",
    "dq_evidence": f"""
        WITH {GROUNDING}, bad AS (SELECT kind, COUNT(*) FILTER (WHERE NOT verified) AS n FROM grounded GROUP BY kind)
        SELECT kind, 'text' AS step, 'evidence_verified' AS check_name, 'pages' AS target,
               CASE WHEN n > 0 THEN 'warn' ELSE 'pass' END AS status,
               CASE WHEN n > 0 THEN n || ' rows: evidence not found in the source'
                    ELSE 'all evidence found in the source' END AS detail FROM bad""",
    "enrich_batch": "SELECT doc_id, CASE WHEN NOT contains(text, '@') THEN concat_ws(',', " + ", ".join(
        f"LENGTH(text) - LENGTH(replace(text, '{c}', ''))" for c in LETTERS
    ) + ") END AS vector, CASE WHEN contains(text, '@') THEN 'ValueError: holds an address' END AS error FROM documents",
    "extract_fields": f"""
        SELECT doc_id, CAST({_NON_EMPTY.format('version ([0-9]+)')} AS INTEGER) AS license_version,
               {_NON_EMPTY.format('([0-9A-Za-z._-]+@[a-z0-9.]+[a-z])')} AS address,
               {_NON_EMPTY.format('([0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3})')} AS host,
               CASE WHEN lower(regexp_extract(text, '(?i)licensed under the ([a-z]+)', 1)) IN ('gnu', 'mit', 'apache')
                    THEN lower(regexp_extract(text, '(?i)licensed under the ([a-z]+)', 1)) END AS license_kind,
               CASE WHEN lower(regexp_extract(text, '^([A-Za-z]+)', 1)) IN ('the', 'of', 'la', 'der')
                    THEN lower(regexp_extract(text, '^([A-Za-z]+)', 1)) END AS language_hint,
               array_to_string(list_filter(['license', 'token', 'the', 'der'], lambda w: contains(lower(text), w)), ',') AS mentions
        FROM documents""",
    "snippet": """
        SELECT doc_id, CASE WHEN LENGTH(text) <= 180 THEN text
               ELSE regexp_replace(text[1:180], ' [^ ]*\\z', '') || ' ...' END AS snippet FROM documents""",
    "highlight": r"""
        SELECT doc_id, regexp_replace(text, '(?i)(^|[^A-Za-z0-9_])((?:thou|ment|le)[A-Za-z0-9]*)', '\1**\2**', 'g')
               AS highlighted FROM documents""",
    "three_way_compare": f"WITH {THREE_WAY} SELECT * FROM compared ORDER BY target_date DESC",
    "cosine_topk": """
        WITH q AS (SELECT CAST(vec_id AS VARCHAR) AS question, embedding AS v FROM embeddings WHERE vec_id < 10),
        scored AS (
            SELECT question, vec_id, ROUND(
                list_sum(list_transform(range(1, len(v) + 1), lambda i: CAST(embedding[i] AS DOUBLE) * CAST(v[i] AS DOUBLE)))
                / (sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))
                   * sqrt(list_sum(list_transform(v, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))))), 6) AS similarity
            FROM embeddings, q)
        SELECT question, CAST(rank AS INTEGER) AS rank, vec_id, similarity FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY question ORDER BY similarity DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 5""",
}
