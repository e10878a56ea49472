"""What a query reads, from its parsed plan instead of a pattern over its text."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession


def _each(seq: JavaObject) -> Iterator[JavaObject]:
    items = seq.iterator()
    while items.hasNext():
        yield items.next()


def _read(plan: JavaObject, hidden: frozenset[str], found: set[str]) -> None:
    kind = plan.getClass().getSimpleName()
    if kind == "UnresolvedRelation":
        name = ".".join(_each(plan.multipartIdentifier()))
        if name.lower() not in hidden:
            found.add(name)
        return
    if kind == "UnresolvedWith":
        for named in _each(plan.cteRelations()):
            inner = hidden | {named._1().lower()} if plan.allowRecursion() else hidden
            _read(named._2(), inner, found)
            hidden = hidden | {named._1().lower()}  # for those after it and for the query itself
        _read(plan.child(), hidden, found)
        return
    for part in (plan.children(), plan.subqueries()):
        for inner in _each(part):
            _read(inner, hidden, found)


def tables_read(spark: SparkSession, query: str) -> set[str]:
    """The tables and views that the SQL names as sources, as it names them. Comments, strings, aliases and the names of
    WITH clauses are none; tables in subqueries of any place are."""
    found: set[str] = set()
    _read(spark._jsparkSession.sessionState().sqlParser().parsePlan(query), frozenset(), found)
    return found


def view_reads(spark: SparkSession, views: Mapping[str, str]) -> DataFrame:
    """(path, name): what each of the named queries reads. Queries are metadata of the catalog, a few words per view."""
    rows = [(path, name) for path, query in views.items() for name in sorted(tables_read(spark, query))]
    return spark.createDataFrame(rows, "path string, name string")
