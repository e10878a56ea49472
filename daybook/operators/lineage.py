"""Lineage: edges, neighbours, and whether the declaration matches what exists.

Neighbours come as rows, not as lists per node: a node that half of the graph is
built from stays spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.text import all_matches
from daybook.operators.joins import lookup, matching, unmatched
from daybook.session import materialise

# Fixed value: how a table is named in SQL and code.
TABLE_REFERENCE = r"\b(?:bronze|silver|gold)\.[a-z_]+\b"


def declared_edges(nodes: DataFrame) -> DataFrame:
    """(upstream, downstream, built_by) from nodes with an ``upstream`` array."""
    return nodes.select(F.explode("upstream").alias("upstream"), F.col("node").alias("downstream"), "built_by")


def lineage_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with the type of both ends; an edge from an unknown node keeps a NULL type.

    Nodes shrink to one row each first, so that copies cannot multiply edges; the edges of
    a hot node are split.
    """
    unique = nodes.groupBy("node").agg(F.min("type").alias("type"))
    up = unique.select(F.col("node").alias("upstream"), F.col("type").alias("upstream_type"))
    down = unique.select(F.col("node").alias("downstream"), F.col("type").alias("downstream_type"))
    typed = lookup(lookup(edges, up, ["upstream"]), down, ["downstream"])
    return typed.select("upstream", "downstream", "upstream_type", "downstream_type", "built_by")


def neighbours(edges: DataFrame) -> DataFrame:
    """(node, direction, neighbour): both directions of every edge, each once. One hop."""
    both = F.array(
        F.struct(F.col("downstream").alias("node"), F.lit("upstream").alias("direction"),
                 F.col("upstream").alias("neighbour")),
        F.struct(F.col("upstream").alias("node"), F.lit("downstream").alias("direction"),
                 F.col("downstream").alias("neighbour")),
    )
    return edges.select(F.inline(both)).distinct()


def neighbour_counts(neighbour_rows: DataFrame) -> DataFrame:
    """How many nodes each node reads from and feeds."""
    return neighbour_rows.groupBy("node").agg(
        F.count_if(F.col("direction") == "upstream").alias("n_upstream"),
        F.count_if(F.col("direction") == "downstream").alias("n_downstream"),
    )


def unknown_upstream(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges that name an upstream which is not a node."""
    known = nodes.select(F.col("node").alias("upstream"))
    return unmatched(edges, known, ["upstream"]).select("upstream", "downstream")


def two_way_difference(declared: DataFrame, actual: DataFrame, name: str = "name") -> DataFrame:
    """Names on one side only. Both sides shrink to distinct names, then meet in one join."""
    left = declared.select(name).distinct().withColumn("_declared", F.lit(True))
    right = actual.select(name).distinct().withColumn("_actual", F.lit(True))
    either = left.join(right, name, "full_outer")
    problem = (F.when(F.col("_actual").isNull(), "declared but missing")
               .when(F.col("_declared").isNull(), "exists but not declared"))
    return either.select(name, problem.alias("problem")).where(F.col("problem").isNotNull())


def references(texts: DataFrame, pattern: str = TABLE_REFERENCE, group: int = 0) -> DataFrame:
    """(path, name): every distinct name that a text mentions, found inside its row."""
    found = texts.select("path", F.explode_outer(all_matches(F.col("text"), pattern, group)).alias("name"))
    return found.where(F.col("name").isNotNull())


def undeclared_references(
    texts: DataFrame, real: DataFrame, allowed: DataFrame, pattern: str = TABLE_REFERENCE, group: int = 0
) -> DataFrame:
    """References to real names that the text's declaration (path, name) does not allow.

    A mention that is no real name is a comment, not a read.
    """
    found = references(texts, pattern, group)
    read = matching(found, real, ["name"])
    return unmatched(read, allowed, ["path", "name"]).select("path", "name")


def lineage_problems(nodes: DataFrame, objects: DataFrame, texts: DataFrame, view_reads: DataFrame | None = None) -> DataFrame:
    """Every mismatch between declared lineage and reality, as one text per row.

    ``nodes`` (node, type, built_by, upstream), ``objects`` (name, view_sql), ``texts`` (path, text). ``view_reads`` (path, name) has
    what the views' parsed plans read; without it names are looked for in their text.
    """
    edges = declared_edges(nodes)
    declared = nodes.where(F.col("type").isin("table", "view")).select(F.col("node").alias("name"))
    actual = objects.select("name")

    unknown = unknown_upstream(edges, nodes).select(
        F.concat("downstream", F.lit(" lists unknown upstream "), "upstream").alias("problem"))
    differing = two_way_difference(declared, actual).select(F.concat("name", F.lit(": "), "problem").alias("problem"))

    views = objects.where(F.col("view_sql").isNotNull()).select(F.col("name").alias("path"), F.col("view_sql").alias("text"))
    reads = (references(views) if view_reads is None else view_reads.distinct()).where(F.col("name") != F.col("path"))
    view_declared = edges.select(F.col("downstream").alias("path"), F.col("upstream").alias("name"))
    from_views = reads.join(view_declared, ["path", "name"], "left_anti").select(
        F.concat(F.lit("view "), "path", F.lit(" reads undeclared "), "name").alias("problem"))

    built = nodes.where(F.col("built_by").isNotNull())
    allowed = built.select(F.col("built_by").alias("path"), F.col("node").alias("name")).unionByName(
        edges.where(F.col("built_by").isNotNull()).select(F.col("built_by").alias("path"), F.col("upstream").alias("name")))
    known = declared.unionByName(actual)
    scanned = texts.join(built.select(F.col("built_by").alias("path")).distinct(), "path", "left_semi")
    from_code = undeclared_references(scanned, known, allowed).select(
        F.concat("path", F.lit(" references undeclared "), "name").alias("problem"))

    return unknown.unionByName(differing).unionByName(from_views).unionByName(from_code)


def lineage_records(problems: DataFrame, step: str) -> DataFrame:
    """The check records of :func:`lineage_problems`: one that failed per problem, or one that passed."""
    found = F.col("problem").isNotNull()
    none = problems.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("problem"))
    return problems.select("problem").unionByName(none).select(
        F.lit(step).alias("step"), F.lit("lineage").alias("check_name"), F.lit("lineage").alias("target"),
        F.when(found, "fail").otherwise("pass").alias("status"),
        F.coalesce("problem", F.lit("lineage matches the warehouse, view SQL and code")).alias("detail"))


def reach(edges: DataFrame, starts: DataFrame, most_hops: int | None = None) -> DataFrame:
    """(start, node, hops): every node that each start leads to over any number of edges, by the fewest of them.

    ``starts`` has ``node``; a start reaches itself in 0 hops. Round by round the nodes found last are joined to the edges, and
    those that a start has reached before drop out, so circles end. Rounds are as many as the longest of the shortest ways; each is
    stored, so a lost executor repeats one round. Names that are no node reach only themselves.
    """
    hops = edges.where("upstream IS NOT NULL AND downstream IS NOT NULL").select(F.col("upstream").alias("node"), "downstream").distinct()
    last = materialise(starts.where("node IS NOT NULL").select(F.col("node").alias("start"), "node", F.lit(0).alias("hops")).distinct())
    found, rounds = last, 0
    while most_hops is None or rounds < most_hops:
        rounds += 1
        ahead = last.join(hops, "node").select("start", F.col("downstream").alias("node"), F.lit(rounds).alias("hops")).distinct()
        last = materialise(ahead.join(found.select("start", "node"), ["start", "node"], "left_anti").select("start", "node", "hops"))
        if last.isEmpty():
            break
        found = found.unionByName(last)
    return found
