"""Nearest stored vectors by cosine similarity: exact, one pass over the table."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.scoring import rounded


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(v: Column) -> Column:
    return F.sqrt(_dot(v, v))


def unit(v: Column) -> Column:
    """The vector at length 1; elements are NULL for a zero vector."""
    length = norm(v)
    return F.transform(v, lambda x: F.try_divide(x.cast("double"), length))


def unit_literal(values: Sequence[float]) -> Column:
    """A question vector that the caller holds, at length 1."""
    length = math.sqrt(sum(v * v for v in values))
    if not math.isfinite(length) or length == 0:
        raise ValueError("a question vector must be finite and not zero")
    return F.lit([v / length for v in values])


def cosine_topk(
    df: DataFrame, vector: str, doc_id: str, questions: Mapping[str, Column], k: int, digits: int = 6
) -> DataFrame:
    """The k most similar rows for every question, ties by id; zero vectors and other lengths never match.

    Questions are unit vectors as columns (literals or scalar subqueries), scored while
    the table is scanned. The rank filter keeps k rows per question and task before the
    exchange, so the window sees tasks x k rows, not the table.
    """
    asked = {name: f"_q{i}" for i, name in enumerate(questions)}
    attached = df.select(
        doc_id, vector, norm(F.col(vector)).alias("_norm"), *[questions[name].alias(c) for name, c in asked.items()]
    )

    def similarity(q: Column) -> Column:
        same_length = F.size(vector) == F.size(q)
        return rounded(F.when(same_length, F.try_divide(_dot(F.col(vector), q), F.col("_norm"))), digits)

    scores = F.array(*[
        F.struct(F.lit(name).alias("question"), similarity(F.col(c)).alias("similarity")) for name, c in asked.items()
    ])
    scored = attached.select(doc_id, F.inline(scores)).where(F.col("similarity").isNotNull())
    best = Window.partitionBy("question").orderBy(F.desc("similarity"), doc_id)
    ranked = scored.withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("question", "rank", doc_id, "similarity")
