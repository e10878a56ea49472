"""Row enrichment by a supplied function, and typed extraction by rules."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.dedupe import first_wins
from daybook.operators.joins import lookup, unmatched
from daybook.session import materialise
from daybook.sources.tables import append, ensure_table


def enrich(
    df: DataFrame, text: str | Sequence[str], keep: Sequence[str], fn: Callable[..., object] | None, result_type: T.DataType,
    setup: Callable[[], Callable[..., object]] | None = None, tasks: int | None = None, whole_batch: bool = False,
) -> DataFrame:
    """Add ``result`` and ``error`` columns by calling ``fn`` on each text, in Arrow batches.

    With several columns in ``text``, ``fn`` gets their values as arguments. With ``whole_batch`` it gets one
    list per column for all rows of a batch and returns a list of results; if that call fails, every row of
    the batch keeps the error. A row whose call fails keeps its error and a NULL result, so one bad document
    neither stops the run nor gets lost: the next run sees it as still to do.
    ``setup``, when given, builds ``fn`` once per task, e.g. to open a client. ``tasks``
    spreads few rows with slow calls over that many tasks.
    """
    schema = T.StructType(
        [df.schema[c] for c in keep]
        + [T.StructField("result", result_type), T.StructField("error", T.StringType())]
    )
    arguments = [text] if isinstance(text, str) else list(text)

    def attempt(call: Callable[..., object], values: Sequence[object]) -> tuple[object, str | None]:
        try:
            return call(*values), None
        except Exception as e:  # the failure belongs to the row, or to the batch that was asked for
            return None, f"{type(e).__name__}: {e}"

    def outcomes(call: Callable[..., object], batch: pd.DataFrame) -> list[tuple[object, str | None]]:
        if not whole_batch:
            return [attempt(call, values) for values in zip(*[batch[a] for a in arguments])]
        results, error = attempt(call, [batch[a].tolist() for a in arguments])
        if error is None and len(results) != len(batch):
            error = f"ValueError: {len(results)} results for {len(batch)} texts"
        return [(None, error)] * len(batch) if error else [(r, None) for r in results]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = setup() if setup else fn
        for batch in batches:
            made = outcomes(call, batch)
            out = batch[list(keep)].copy()
            out["result"] = pd.Series([r for r, _ in made], index=batch.index, dtype=object)
            out["error"] = pd.Series([e for _, e in made], index=batch.index, dtype=object)
            yield out

    rows = df.select(*dict.fromkeys([*keep, *arguments]))
    return (rows.repartition(tasks) if tasks else rows).mapInPandas(run, schema)


def call_digest(model: str, target: str, *arguments: Column) -> Column:
    """What a call depends on, as one digest: the model, what it is asked for, and its arguments."""
    parts = [p for a in (F.lit(model), F.lit(target), *arguments) for p in (a.isNull().cast("string"), F.coalesce(F.length(a.cast("string")), F.lit(0)).cast("string"), F.coalesce(a.cast("string"), F.lit("")))]
    return F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)


def still_to_pay(rows: DataFrame, paid: DataFrame) -> DataFrame:
    """One row per digest that has no stored result. Copies of a text shrink to one row before the join."""
    return unmatched(first_wins(rows, ["digest"], [c for c in rows.columns if c != "digest"]), paid, ["digest"]).select(*rows.columns)


def enrich_once(
    df: DataFrame, text: str | Sequence[str], keep: Sequence[str], fn: Callable[..., object] | None, result_type: T.DataType,
    model: str, table: str, target: str = "", tasks: int | None = None, whole_batch: bool = False,
) -> DataFrame:
    """:func:`enrich` where every call is paid once: results are stored in ``table`` under the digest of model, target and arguments.

    A call that has a result there is not made again, in this run or a later one; arguments that several rows share are asked for once. A
    failed call stores nothing, gives its error to all its rows, and is made again by the next run. Results are stored before they are used.
    """
    arguments = [text] if isinstance(text, str) else list(text)
    spark = df.sparkSession
    ensure_table(spark, table, T.StructType([
        T.StructField("digest", T.StringType()), T.StructField("model", T.StringType()), T.StructField("target", T.StringType()),
        T.StructField("result", result_type), T.StructField("paid_at", T.TimestampNTZType())]))
    digest = call_digest(model, target, *[F.col(a) for a in arguments])
    rows = materialise(df.select(*dict.fromkeys([*keep, *arguments]), digest.alias("digest")))
    todo = still_to_pay(rows.select("digest", *arguments), spark.table(table))
    made = materialise(enrich(todo, arguments, ["digest"], fn, result_type, tasks=tasks, whole_batch=whole_batch))
    append(succeeded(made).select(
        "digest", F.lit(model).alias("model"), F.lit(target).alias("target"), "result",
        F.to_timestamp_ntz(F.current_timestamp()).alias("paid_at")), table)
    stored = first_wins(spark.table(table).select("digest", "result", "paid_at"), ["digest"], ["paid_at"]).select("digest", "result")
    failed = made.where(F.col("error").isNotNull()).select("digest", "error")
    return lookup(lookup(rows, stored, ["digest"]), failed, ["digest"]).select(*keep, "result", "error")


def succeeded(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("error").isNull()).drop("error")


def failures(enriched: DataFrame, doc_id: str, step: str, target: str) -> DataFrame:
    """Failed rows as warnings in the shape of check records."""
    detail = F.concat(F.lit("left open for the next run: "), F.col(doc_id).cast("string"), F.lit(", "), "error")
    return enriched.where(F.col("error").isNotNull()).select(
        F.lit(step).alias("step"), F.lit("enriched").alias("check_name"), F.lit(target).alias("target"),
        F.lit("warn").alias("status"), detail.alias("detail"))


@dataclass(frozen=True)
class FieldRule:
    """A typed, nullable field read from the text: the first match of ``pattern``.

    With ``allowed``, any other value counts as not stated. ``requires`` is a literal that
    every match holds: texts without it skip the pattern.
    """

    name: str
    pattern: str
    type: str = "string"
    group: int = 1
    allowed: tuple[str, ...] = ()
    requires: str = ""

    def found(self, text: Column) -> Column:
        match = F.regexp_extract(text, self.pattern, self.group)
        return F.when(F.contains(text, F.lit(self.requires)), match) if self.requires else match

    def typed(self, match: Column) -> Column:
        stated = F.nullif(match, F.lit(""))
        if self.allowed:
            stated = F.when(F.lower(match).isin(*self.allowed), F.lower(match))
        return stated.try_cast(self.type)


def extract_fields(df: DataFrame, text: str, keep: Sequence[str], rules: Sequence[FieldRule],
                   mentions: Sequence[str] = ()) -> DataFrame:
    """A typed record per row plus the listed words that the text mentions, as an array."""
    matched = df.select(*keep, F.lower(text).alias("_lowered"), *[r.found(F.col(text)).alias(r.name) for r in rules])
    listed = F.array(*[F.lit(w) for w in mentions]) if mentions else F.array().cast("array<string>")
    found = F.filter(listed, lambda w: F.contains(F.col("_lowered"), w))
    return matched.select(*keep, *[r.typed(F.col(r.name)).alias(r.name) for r in rules], found.alias("mentions"))
