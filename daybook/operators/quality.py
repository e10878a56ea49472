"""Data-quality checks: every check of a table is part of one aggregate over it.

A check turns into aggregate columns and a verdict on them, so a table is scanned
once however many checks it has, and partial aggregates absorb hot groups.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import age_hours

# The physically plausible temperature range.
PLAUSIBLE = (-90, 60)


class DataQualityError(Exception):
    """A failed check, raised after its record has been written."""


@dataclass(frozen=True)
class Check:
    """``counts`` are aggregate expressions by name; ``verdict`` maps them to (status, detail).

    Expressions are SQL text, so that gates can be declared before a session exists.
    """

    name: str
    counts: dict[str, str]
    verdict: Callable[[Callable[[str], Column]], tuple[Column, Column]] = field(repr=False)


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _bad_rows(name: str, bad: str, what: str, fine: str, status: str = "fail") -> Check:
    def verdict(at: Callable[[str], Column]) -> tuple[Column, Column]:
        n = at("bad")
        return (F.when(n > 0, status).otherwise("pass"),
                F.when(n > 0, _text(n, f" rows: {what}")).otherwise(F.lit(fine)))

    return Check(name, {"bad": f"count_if({bad})"}, verdict)


def not_empty() -> Check:
    def verdict(at: Callable[[str], Column]) -> tuple[Column, Column]:
        n = at("rows")
        return F.when(n == 0, "fail").otherwise("pass"), F.when(n == 0, "empty").otherwise(_text(n, " rows"))

    return Check("not_empty", {"rows": "count(*)"}, verdict)


def no_nulls(columns: Sequence[str]) -> Check:
    """Reports the first listed column that has NULLs."""
    def verdict(at: Callable[[str], Column]) -> tuple[Column, Column]:
        status, detail = F.lit("pass"), F.lit(f"no NULL in {', '.join(columns)}")
        for c in reversed(columns):
            status = F.when(at(c) > 0, "fail").otherwise(status)
            detail = F.when(at(c) > 0, _text(at(c), f" rows: {c} is NULL")).otherwise(detail)
        return status, detail

    return Check("no_nulls", {c: f"count_if({c} IS NULL)" for c in columns}, verdict)


def value_range(column: str, low: float, high: float, name: str = "value_range") -> Check:
    """Bounds are inclusive; NULL passes, as it means not stated."""
    bad = f"{column} < {low} OR {column} > {high}"
    return _bad_rows(name, bad, f"{column} outside [{low}, {high}]", f"{column} within [{low}, {high}]")


def plausible_temperature(column: str) -> Check:
    return value_range(column, *PLAUSIBLE, name="plausible_temperature")


def non_negative(column: str) -> Check:
    return _bad_rows("non_negative", f"{column} < 0", f"{column} is negative", f"{column} never negative")


def evidence_verified(column: str) -> Check:
    """Unverified evidence is worth a look but stops nothing."""
    return _bad_rows("evidence_verified", f"NOT {column}", "evidence not found in the source",
                     "all evidence found in the source", status="warn")


def fresh(column: str, now: str, max_age_hours: float) -> Check:
    """No rows or too old fails, past half the limit warns."""
    def verdict(at: Callable[[str], Column]) -> tuple[Column, Column]:
        age = age_hours(at("newest"), F.lit(now).cast("timestamp_ntz"))
        status = (F.when(at("newest").isNull() | (age > max_age_hours), "fail")
                  .when(age > max_age_hours / 2, "warn").otherwise("pass"))
        detail = F.when(at("newest").isNull(), "no rows").otherwise(
            _text(F.format_string("%.1f", age), f" h old, limit {max_age_hours} h"))
        return status, detail

    return Check("fresh", {"newest": f"max({column})"}, verdict)


def run_suite(df: DataFrame, step: str, target: str, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """One row per check (and group): step, check_name, target, status, detail."""
    named = {(i, k): f"_{i}_{k}" for i, check in enumerate(checks) for k in check.counts}
    columns = [F.expr(check.counts[k]).alias(named[i, k]) for i, check in enumerate(checks) for k in check.counts]
    counted = df.groupBy(*by).agg(*columns)

    records = []
    for i, check in enumerate(checks):
        status, detail = check.verdict(lambda k, i=i: F.col(named[i, k]))
        records.append(F.struct(F.lit(check.name).alias("check_name"), status.alias("status"), detail.alias("detail")))
    return counted.select(
        *by, F.lit(step).alias("step"), F.lit(target).alias("target"), F.inline(F.array(*records))
    ).select(*by, "step", "check_name", "target", "status", "detail")


def group_counts(df: DataFrame, column: str, expected: Sequence[str], minimum: int = 1) -> DataFrame:
    """Rows per expected group, 0 where a group is missing. Other groups are filtered at the scan."""
    groups = df.sparkSession.createDataFrame([(g,) for g in expected], "group string")
    found = df.where(F.col(column).isin(*expected)).groupBy(F.col(column).alias("group")).agg(F.count("*").alias("n"))
    counted = groups.join(found, "group", "left")
    n = F.coalesce("n", F.lit(0))
    return counted.select("group", n.alias("n"), F.when(n < minimum, "fail").otherwise("pass").alias("status"))


def group_count_record(counts: DataFrame, step: str, target: str, minimum: int) -> DataFrame:
    """The check record of :func:`group_counts`. The list is bounded by the expected groups."""
    short = F.array_sort(F.collect_list(F.when(F.col("status") == "fail", F.col("group"))))
    return counts.agg(short.alias("_short")).select(
        F.lit(step).alias("step"), F.lit("group_counts").alias("check_name"), F.lit(target).alias("target"),
        F.when(F.size("_short") > 0, "fail").otherwise("pass").alias("status"),
        F.when(F.size("_short") > 0, _text(f"fewer than {minimum} rows for ", F.array_join("_short", ", ")))
        .otherwise(F.lit(f"at least {minimum} rows for every group")).alias("detail"),
    )


def undocumented(metadata: DataFrame) -> DataFrame:
    """Objects and columns with no description. ``metadata`` is (object, column, description)."""
    return metadata.where(F.coalesce("description", F.lit("")) == "").select("object", "column")


def documented(metadata: DataFrame) -> DataFrame:
    """Per object: how many entries, how many lack a description, and the verdict."""
    missing = F.count_if(F.coalesce("description", F.lit("")) == "")
    counted = metadata.groupBy("object").agg(F.count("*").alias("n_entries"), missing.alias("n_undocumented"))
    return counted.withColumn("status", F.when(F.col("n_undocumented") > 0, "fail").otherwise("pass"))


def documented_records(metadata: DataFrame, step: str) -> DataFrame:
    """The check records: one that failed per entry without a description, one that passed per object that has all."""
    missing = undocumented(metadata).select("object", F.lit("fail").alias("status"), F.when(
        F.col("column") == "", "no description").otherwise(_text("no description of ", F.col("column"))).alias("detail"))
    fine = documented(metadata).where("status = 'pass'").select("object", "status", F.lit("all documented").alias("detail"))
    return missing.unionByName(fine).select(
        F.lit(step).alias("step"), F.lit("documented").alias("check_name"), F.col("object").alias("target"), "status", "detail")


def status_counts(results: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Passed, warned and failed checks per run, and the status of the run."""
    counted = results.groupBy(*by).agg(
        *[F.count_if(F.col("status") == s).cast("int").alias(f"n_{s}") for s in ("pass", "warn", "fail")]
    )
    status = F.when(F.col("n_fail") > 0, "failed").when(F.col("n_warn") > 0, "warning").otherwise("success")
    return counted.withColumn("status", status)
