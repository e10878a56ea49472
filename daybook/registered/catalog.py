"""Registered queries: lineage, the asset index, keyword search."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions.text import STOPWORDS
from daybook.operators import lineage, search
from daybook.plans import catalog
from daybook.plans.metrics import metric_definitions
from daybook.registered.base import TABLES, table
from daybook.registered.metrics import DAILY_METRICS
from daybook.schemas import LINEAGE_NODES

# ---- a graph in the data: suppliers and customers are built from nations, nations from regions ----


def _nodes(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    customer, supplier = table(spark, d, "customer"), table(spark, d, "supplier")

    def named(prefix: str, key: str):
        return F.concat(F.lit(prefix), F.col(key).cast("string"))

    nations = F.array(named("nation:", "c_nationkey"))
    return (
        region.select(named("region:", "r_regionkey").alias("node"), F.lit("source").alias("type"),
                      F.lit(None).cast("string").alias("built_by"), F.array().cast("array<string>").alias("upstream"))
        .unionByName(nation.select(named("nation:", "n_nationkey").alias("node"), F.lit("table").alias("type"),
                                   F.lit("nations.py").alias("built_by"),
                                   F.array(named("region:", "n_regionkey")).alias("upstream")))
        .unionByName(customer.select(
            named("customer:", "c_custkey").alias("node"), F.lit("view").alias("type"),
            F.lit("customers.py").alias("built_by"), nations.alias("upstream")))
        .unionByName(supplier.select(
            named("supplier:", "s_suppkey").alias("node"), F.lit("consumer").alias("type"),
            F.lit("suppliers.py").alias("built_by"),
            F.array(named("nation:", "s_nationkey"), F.concat(F.lit("customer:"), (F.col("s_suppkey") * 20).cast("string"))).alias("upstream")))
    )


NODES = """
nodes AS (
    SELECT 'region:' || r_regionkey AS node, 'source' AS type, NULL AS built_by FROM region
    UNION ALL SELECT 'nation:' || n_nationkey, 'table', 'nations.py' FROM nation
    UNION ALL SELECT 'customer:' || c_custkey, 'view', 'customers.py' FROM customer
    UNION ALL SELECT 'supplier:' || s_suppkey, 'consumer', 'suppliers.py' FROM supplier),
edges AS (
    SELECT 'region:' || n_regionkey AS upstream, 'nation:' || n_nationkey AS downstream, 'nations.py' AS built_by FROM nation
    UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey, 'customers.py' FROM customer
    UNION ALL SELECT 'nation:' || s_nationkey, 'supplier:' || s_suppkey, 'suppliers.py' FROM supplier
    UNION ALL SELECT 'customer:' || s_suppkey * 20, 'supplier:' || s_suppkey, 'suppliers.py' FROM supplier),
neighbours AS (
    SELECT downstream AS node, 'upstream' AS direction, upstream AS neighbour FROM edges
    UNION SELECT upstream, 'downstream', downstream FROM edges)"""


def graph(spark, d):
    """The declared edges and, from every tenth supplier, one back to a region."""
    back = table(spark, d, "supplier").where("s_suppkey % 10 = 0").select(
        F.concat(F.lit("supplier:"), F.col("s_suppkey").cast("string")).alias("upstream"),
        F.concat(F.lit("region:"), (F.col("s_suppkey") % 5).cast("string")).alias("downstream"))
    return lineage.declared_edges(_nodes(spark, d)).select("upstream", "downstream").unionByName(back)


GRAPH_SQL = f"""{NODES},
graph AS (
    SELECT upstream, downstream FROM edges
    UNION ALL SELECT 'supplier:' || s_suppkey, 'region:' || s_suppkey % 5 FROM supplier WHERE s_suppkey % 10 = 0)"""


def _lineage_edges(spark, d):
    nodes = _nodes(spark, d)
    return lineage.lineage_edges(lineage.declared_edges(nodes), nodes)


def _lineage_diff(spark, d):
    declared = table(spark, d, "labels").select(F.col("doc_id").alias("name"))
    actual = table(spark, d, "conversations").select(F.col("conv_id").alias("name"))
    return lineage.two_way_difference(declared, actual)


def _lineage_problems(spark, d):
    """Nations, suppliers and regions as what exists, suppliers as views over one table, a file that reads the regions."""
    files = table(spark, d, "region").select(
        F.concat(F.lit("gold."), F.replace(F.lower("r_name"), F.lit(" "), F.lit("_"))).alias("name"),
        F.when(F.col("r_regionkey") >= 0, "nations.py").alias("path"))
    region = files.select("name")
    nations = table(spark, d, "nation").select(F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("name"))
    suppliers = table(spark, d, "supplier").select(
        F.concat(F.lit("supplier:"), F.col("s_suppkey").cast("string")).alias("name"),
        F.lit("SELECT * FROM gold.supplies").alias("view_sql"))
    objects = region.unionByName(nations).withColumn("view_sql", F.lit(None).cast("string")).unionByName(suppliers)
    texts = files.select("path", F.concat(F.lit("reads "), "name", F.lit(" and gold.none")).alias("text"))
    return lineage.lineage_records(lineage.lineage_problems(_nodes(spark, d), objects, texts), "catalog")


def _reference_scan(spark, d):
    """Links in pages that name a word of the benchmark texts, but not one of the page's own title."""
    pages = table(spark, d, "pages")
    texts = pages.select(F.col("page_id").alias("path"), F.col("html").alias("text"))
    words = table(spark, d, "benchmark").select(F.explode(F.split("text", "[ \n]+")).alias("w"))
    title = F.split(F.regexp_extract("html", "<title>([^<]*)</title>", 1), " ")
    allowed = pages.select(F.col("page_id").alias("path"), F.explode(title).alias("w"))
    link = F.concat(F.lit("/"), "w").alias("name")
    return lineage.undeclared_references(
        texts, words.select(link), allowed.select("path", link), r'href="(/[^"]*)"', group=1)


# ---- the asset index over the given tables -------------------------------------------------------

_KEYS = {"nation": ["region"], "customer": ["nation"], "supplier": ["nation"], "orders": ["customer"],
         "lineitem": ["orders", "part", "supplier"], "labels": ["documents"], "daily": ["events"]}
_DESCRIPTIONS = {"events": "Timestamped user events", "documents": "Free text in four languages",
                 "orders": "Customer orders", "lineitem": "Order lines"}


def _asset_index(spark, d):
    tables = {t: table(spark, d, t) for t in TABLES}
    objects = spark.createDataFrame(
        [(t, "Table", "bronze", _DESCRIPTIONS.get(t, "")) for t in TABLES],
        "id string, kind string, layer string, description string")
    nodes = spark.createDataFrame(
        [(t, "table", None, None, None, _KEYS.get(t, [])) for t in TABLES]
        + [("daily", "consumer", "Daily rollup", "Daily rollup of events", "daily.py", _KEYS["daily"]),
           ("landing", "source", "Landing area", "Files as they arrive", None, [])], LINEAGE_NODES)
    index = catalog.asset_index(
        objects, catalog.column_rows(tables, {"events.ts": "Time of the event, UTC"}),
        metric_definitions(spark, DAILY_METRICS), nodes, lineage.declared_edges(nodes))
    return index.join(catalog.row_counts(tables), "id", "left")


def _asset_rows(spark, d):
    """The index as flat rows, which SQL can state too."""
    return _asset_index(spark, d).select(
        "id", "name", "kind", "layer", "description", "n_rows", F.size("columns").alias("n_columns"),
        F.array_join("upstream", ",").alias("upstream"), F.array_join("downstream", ",").alias("downstream"),
        F.array_join("metrics", ",").alias("metrics"))


# ---- search -----------------------------------------------------------------------------------------

GLOSSARY = {"reti": ["ment", "keit"], "inger": ["erth", "reti"], "license": ["public", "gnu"]}
QUERY = "the reti of tion"
DOC_QUERY = "licensed inger"
LANGUAGES = ("en", "de")


def _pages(spark, d):
    """Pages as assets: the links are columns by name, the paragraphs columns by their text."""
    links = F.transform(F.regexp_extract_all("html", F.lit('<a href="/([^"]*)"'), F.lit(1)),
                        lambda x: F.struct(x.alias("name"), F.lit("").alias("description")))
    paragraphs = F.transform(F.regexp_extract_all("html", F.lit("<p>([^<]*)"), F.lit(1)),
                             lambda x, i: F.struct(F.concat(F.lit("p"), i.cast("string")).alias("name"), x.alias("description")))
    return table(spark, d, "pages").select(
        F.col("page_id").alias("id"), F.col("url").alias("name"),
        F.when(F.col("url").startswith("https"), "Secure").otherwise("Plain").alias("kind"),
        F.regexp_extract("html", '<html lang="([a-z]*)"', 1).alias("layer"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("description"),
        F.concat(links, paragraphs).alias("columns"))


def docs_as_assets(spark, d):
    none = F.array().cast("array<struct<name:string,description:string>>")
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("name"), F.lit("Document").alias("kind"),
        F.col("lang").alias("layer"), F.col("text").alias("description"), none.alias("columns"))


def _found(spark, d):
    return search.search(_pages(spark, d), QUERY, GLOSSARY)


def _shown(results):
    return results.select("id", "name", "kind", "layer", "relevance",
                          F.array_join("matched_columns", ",").alias("matched_columns"))


def _search_top(spark, d):
    hits = _found(spark, d).select("id", "name", "kind", "layer", "relevance")
    chosen = search.facet_filter(hits, kinds=["Secure"], layers=LANGUAGES)
    return search.top_results(chosen).select("id", "name", "relevance", "n_more")


def _browse(spark, d):
    everything = search.search(docs_as_assets(spark, d), "the of", GLOSSARY)
    order = ("fr", "en", "de")
    return search.ranked(everything, order).select("id", "name", search.layer_rank(F.col("layer"), order).alias("layer_rank"))


def _glossary_expand(spark, d):
    """What the texts of all turns search for, counted."""
    turns = table(spark, d, "conversations")
    expanded = search.expand_terms(turns, "text", ["conv_id"], GLOSSARY)
    return expanded.groupBy("term", "word", "weight").agg(F.count("*").alias("n"))


QUERIES = {
    "lineage_edges": _lineage_edges,
    "lineage_neighbours": lambda s, d: lineage.neighbours(lineage.declared_edges(_nodes(s, d))),
    "lineage_neighbour_counts": lambda s, d: lineage.neighbour_counts(
        lineage.neighbours(lineage.declared_edges(_nodes(s, d)))),
    "lineage_unknown": lambda s, d: lineage.unknown_upstream(lineage.declared_edges(_nodes(s, d)), _nodes(s, d)),
    "lineage_diff": _lineage_diff,
    "lineage_problems": _lineage_problems,
    "reference_scan": _reference_scan,
    "asset_index": _asset_index,
    "asset_index_tables": _asset_rows,
    "keyword_search": lambda s, d: _shown(search.ranked(_found(s, d))),
    "keyword_search_documents": lambda s, d: _shown(search.search(docs_as_assets(s, d), DOC_QUERY, GLOSSARY)).drop("matched_columns"),
    "search_facets": lambda s, d: search.facets(_found(s, d)),
    "search_top": _search_top,
    "browse_order": _browse,
    "glossary_expand": _glossary_expand,
}


# ---- the same as SQL ------------------------------------------------------------------------------


def _words_sql(query: list[str]) -> str:
    rows, n = [], 0
    for t in query:
        for w, weight in [(t, 1.0), *[(w, search.SYNONYM_DISCOUNT) for w in _group_words(t)]]:
            rows.append(f"('{t}', '{w}', {weight}, {n})")
            n += 1
    return ", ".join(rows)


def _group_words(term: str) -> list[str]:
    out: list[str] = []
    for head, rest in GLOSSARY.items():
        if term in (head, *rest):
            out += [w for w in (head, *rest) if w != term and w not in out]
    return out


def _hit(word: str, text: str) -> str:
    return f"regexp_matches(replace({text}, '_', ' '), '(^|[^a-z0-9])' || {word})"


def _search_sql(assets: str, query: list[str]) -> str:
    return f"""
words(term, word, weight, word_no) AS (VALUES {_words_sql(query)}),
assets AS ({assets}),
cols AS (SELECT id, unnest(columns) AS c, unnest(range(len(columns))) AS pos FROM assets),
field_hits AS (
    SELECT id, term, {search.NAME_WEIGHT} * weight AS score FROM assets, words WHERE {_hit('word', "lower(name || ' ' || id)")}
    UNION ALL SELECT id, term, {search.DESCRIPTION_WEIGHT} * weight FROM assets, words WHERE {_hit('word', 'lower(description)')}),
col_hits AS (
    SELECT id, term, word_no, pos, c.name AS col, weight * CASE WHEN {_hit('word', 'lower(c.name)')} THEN {search.COLUMN_NAME_WEIGHT} ELSE {search.COLUMN_DESCRIPTION_WEIGHT} END AS score
    FROM cols, words WHERE {_hit('word', 'lower(c.name)')} OR {_hit('word', 'lower(c.description)')}),
best AS (
    SELECT id, term, MAX(score) AS score FROM (
        SELECT id, term, score FROM field_hits UNION ALL SELECT id, term, score FROM col_hits) GROUP BY id, term),
scored AS (SELECT id, SUM(score) AS score FROM best GROUP BY id HAVING COUNT(*) = {len(query)}),
firsts AS (SELECT id, col, MIN(word_no * 1000000 + pos) AS first_seen FROM col_hits GROUP BY id, col),
matched AS (SELECT id, COUNT(*) AS n, string_agg(col, ',' ORDER BY first_seen) AS names FROM firsts GROUP BY id),
results AS (
    SELECT a.id, a.name, a.kind, a.layer, ROUND(CAST(s.score + LEAST({search.COLUMN_BONUS} * COALESCE(m.n, 0), {search.MAX_COLUMN_BONUS}) AS DOUBLE), 6) AS relevance,
           COALESCE(m.names, '') AS matched_columns
    FROM assets a JOIN scored s ON s.id = a.id LEFT JOIN matched m ON m.id = a.id)"""


_PAGES_SQL = """
    SELECT page_id AS id, url AS name, CASE WHEN starts_with(url, 'https') THEN 'Secure' ELSE 'Plain' END AS kind,
           regexp_extract(html, '<html lang="([a-z]*)"', 1) AS layer,
           regexp_extract(html, '<title>([^<]*)</title>', 1) AS description,
           list_concat(
               list_transform(regexp_extract_all(html, '<a href="/([^"]*)"', 1),
                              lambda x: struct_pack(name := x, description := '')),
               list_transform(regexp_extract_all(html, '<p>([^<]*)', 1),
                              lambda x, i: struct_pack(name := 'p' || (i - 1), description := x))) AS columns
    FROM pages"""
_DOCS_SQL = """
    SELECT doc_id AS id, source AS name, 'Document' AS kind, lang AS layer, text AS description,
           CAST([] AS STRUCT(name VARCHAR, description VARCHAR)[]) AS columns FROM documents"""
_PAGE_SEARCH = _search_sql(_PAGES_SQL, ["reti", "tion"])
_COLUMN_COUNTS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11,
                  "events": 6, "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4}


def _feeds(name: str) -> str:
    return ",".join(sorted(t for t, ups in _KEYS.items() if name in ups))


def _asset_sql(id_: str, name: str, kind: str, layer: str, words: str, rows: str, columns: int, up: str, down: str) -> str:
    return (f"SELECT '{id_}' AS id, '{name}' AS name, '{kind}' AS kind, '{layer}' AS layer, '{words}' AS description, {rows} AS n_rows, "
            f"CAST({columns} AS INTEGER) AS n_columns, '{up}' AS upstream, '{down}' AS downstream, '' AS metrics")


_ASSETS_SQL = [
    *[_asset_sql(t, t, "Table", "bronze", _DESCRIPTIONS.get(t, ""), "COUNT(*)", _COLUMN_COUNTS[t], ",".join(_KEYS.get(t, [])), _feeds(t))
      + f" FROM {t}" for t in TABLES],
    *[_asset_sql(f"metric:{m.name}", m.label, "Metric", "semantic layer", m.description, "CAST(NULL AS BIGINT)", 0, m.table_name, "")
      for m in DAILY_METRICS],
    _asset_sql("daily", "Daily rollup", "Consumer", "outside the warehouse", "Daily rollup of events", "CAST(NULL AS BIGINT)", 0, "events", ""),
    _asset_sql("landing", "Landing area", "Source", "outside the warehouse", "Files as they arrive", "CAST(NULL AS BIGINT)", 0, "", ""),
]

ORACLES = {
    "lineage_edges": f"""
        WITH {NODES} SELECT e.upstream, e.downstream, u.type AS upstream_type, n.type AS downstream_type, e.built_by
        FROM edges e LEFT JOIN nodes u ON u.node = e.upstream LEFT JOIN nodes n ON n.node = e.downstream""",
    "lineage_neighbours": f"WITH {NODES} SELECT * FROM neighbours",
    "lineage_neighbour_counts": f"""
        WITH {NODES} SELECT node, COUNT(*) FILTER (WHERE direction = 'upstream') AS n_upstream,
               COUNT(*) FILTER (WHERE direction = 'downstream') AS n_downstream FROM neighbours GROUP BY node""",
    "lineage_unknown": f"""
        WITH {NODES} SELECT upstream, downstream FROM edges WHERE upstream NOT IN (SELECT node FROM nodes)""",
    "lineage_diff": """
        WITH declared AS (SELECT DISTINCT doc_id AS name FROM labels),
             actual AS (SELECT DISTINCT conv_id AS name FROM conversations)
        SELECT name, 'exists but not declared' AS problem FROM actual WHERE name NOT IN (SELECT name FROM declared)
        UNION ALL SELECT name, 'declared but missing' FROM declared WHERE name NOT IN (SELECT name FROM actual)""",
    "lineage_problems": f"""
        WITH {NODES}, regions AS (SELECT 'gold.' || replace(lower(r_name), ' ', '_') AS name FROM region),
             objects AS (SELECT name FROM regions UNION ALL SELECT 'nation:' || n_nationkey FROM nation
                         UNION ALL SELECT 'supplier:' || s_suppkey FROM supplier),
             declared AS (SELECT node AS name FROM nodes WHERE type IN ('table', 'view')),
             problems AS (
                SELECT downstream || ' lists unknown upstream ' || upstream AS detail FROM edges
                WHERE upstream NOT IN (SELECT node FROM nodes)
                UNION ALL SELECT name || ': declared but missing' FROM declared WHERE name NOT IN (SELECT name FROM objects)
                UNION ALL SELECT name || ': exists but not declared' FROM objects WHERE name NOT IN (SELECT name FROM declared)
                UNION ALL SELECT 'view supplier:' || s_suppkey || ' reads undeclared gold.supplies' FROM supplier
                UNION ALL SELECT 'nations.py references undeclared ' || name FROM regions)
        SELECT 'catalog' AS step, 'lineage' AS check_name, 'lineage' AS target, 'fail' AS status, detail FROM problems""",
    "reference_scan": """
        WITH found AS (SELECT DISTINCT page_id AS path, unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS name FROM pages),
             real AS (SELECT DISTINCT '/' || unnest(regexp_split_to_array(text, '[ \n]+')) AS name FROM benchmark),
             allowed AS (SELECT page_id AS path,
                                '/' || unnest(string_split(regexp_extract(html, '<title>([^<]*)</title>', 1), ' ')) AS name FROM pages)
        SELECT path, name FROM found f WHERE name IN (SELECT name FROM real)
           AND NOT EXISTS (SELECT 1 FROM allowed a WHERE a.path = f.path AND a.name = f.name)""",
    "asset_index_tables": " UNION ALL ".join(_ASSETS_SQL),
    "keyword_search": f"WITH {_PAGE_SEARCH} SELECT * FROM results ORDER BY relevance DESC, name",
    "keyword_search_documents": f"""
        WITH {_search_sql(_DOCS_SQL, ['licensed', 'inger'])} SELECT id, name, kind, layer, relevance FROM results""",
    "search_facets": f"""
        WITH {_PAGE_SEARCH} SELECT 'kind' AS facet, kind AS value, COUNT(*) AS n FROM results GROUP BY kind
        UNION ALL SELECT 'layer', layer, COUNT(*) FROM results GROUP BY layer""",
    "search_top": f"""
        WITH {_PAGE_SEARCH}, chosen AS (SELECT * FROM results WHERE kind = 'Secure' AND layer IN ('en', 'de'))
        SELECT id, name, relevance, GREATEST((SELECT COUNT(*) FROM chosen) - 8, 0) AS n_more
        FROM chosen ORDER BY relevance DESC, name, id LIMIT 8""",
    "browse_order": """
        SELECT doc_id AS id, source AS name,
               CAST(CASE lang WHEN 'fr' THEN 0 WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 9 END AS INTEGER) AS layer_rank
        FROM documents ORDER BY layer_rank, name""",
    "glossary_expand": f"""
        WITH tokens AS (
            SELECT unnest(regexp_extract_all(lower(text), '([a-z0-9_]+)', 1)) AS term FROM conversations),
        typed AS (SELECT term, COUNT(*) AS n FROM tokens WHERE term NOT IN ({', '.join(f"'{w}'" for w in STOPWORDS)}) GROUP BY term),
        related(term, word) AS (VALUES {', '.join(f"('{t}', '{w}')" for t in dict.fromkeys(
            w for head, rest in GLOSSARY.items() for w in (head, *rest)) for w in _group_words(t))})
        SELECT term, term AS word, 1.0::DOUBLE AS weight, n FROM typed
        UNION ALL SELECT term, word, {search.SYNONYM_DISCOUNT}::DOUBLE, n FROM typed JOIN related USING (term)""",
}
