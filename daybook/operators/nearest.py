"""The nearest stored vectors for many questions: both are tables, and most pairs are never compared.

Vectors are dealt to the nearest of a few centres. Angles obey the triangle inequality, so the angle between a question and a vector is
at least the difference of their angles to a centre. Each question first looks into its own cell; the k-th best found there bounds what other
cells, and which of their vectors, can still matter. The result is exact.

A cell is worked on in parts of ``PART`` vectors and blocks of ``ASKED`` questions, so a hot cell, or one vector that a third of the rows
have, is spread over tasks. Centres are at most ``CENTRES`` vectors; nothing else goes to the driver or to every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.joins import lookup
from daybook.session import materialise

CENTRES = 64
PART, ASKED = 20_000, 2_000
#: Similarities are ranked after rounding to six digits, so a pair this close to the bound may still tie with it.
SLACK = 2e-6


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _units(df: DataFrame, vector: str, name: str, size: int) -> DataFrame:
    """id and the vector at length 1; those of another length, with NULLs or without a direction are left out."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    whole = df.where((F.size(vector) == size) & ~F.exists(vector, lambda x: x.isNull()))
    sized = whole.select(F.col(name).alias("id"), vector, length.alias("_length")).where("_length > 0 AND _length < double('infinity')")
    return sized.select("id", F.transform(vector, lambda x: x.cast("double") / F.col("_length")).alias("v"))


def _placed(units: DataFrame, centres, size: int, every: bool) -> DataFrame:
    """With the nearest cell and the angle to its centre, or the angles to all centres."""
    fields = [T.StructField("angles", T.ArrayType(T.DoubleType()))] if every else []
    schema = T.StructType([*units.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType()), *fields])

    def run(batches):
        for b in batches:
            angles = np.arccos(np.clip(_matrix(b.column(1), size) @ centres.value.T, -1, 1))
            cell = angles.argmin(axis=1) if len(angles) else np.zeros(0, dtype=np.int64)
            columns = [*b.columns, pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(cell)), cell])]
            if every:
                ends = np.arange(len(angles) + 1, dtype=np.int32) * angles.shape[1]
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(angles.ravel())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return units.mapInArrow(run, schema)


_FOUND = "question long, id long, similarity double, compared long"


def _compare(size: int, k: int):
    """One part of a cell against one block of questions: per question the k best, and how many vectors were compared."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            order = np.argsort(left["angle"].to_numpy())
            angle, ids = left["angle"].to_numpy()[order], left["id"].to_numpy()[order]
            v, q = _matrix(left["v"], size)[order], _matrix(right["v"], size)
            for name, one, near, reach in zip(right["id"].to_pylist(), q, right["angle"].to_numpy(), right["reach"].to_numpy()):
                low, high = np.searchsorted(angle, near - reach - 1e-9), np.searchsorted(angle, near + reach + 1e-9, side="right")
                scores = np.floor(np.abs(s := v[low:high] @ one) * 1e6 + 0.5) * np.sign(s) / 1e6
                best = np.lexsort((ids[low:high], -scores))[:k]
                out += [(name, int(ids[low:high][i]), float(scores[i]), 0) for i in best]
                out.append((name, None, None, int(high - low)))
        columns = list(zip(*out)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["question", "id", "similarity", "compared"])

    return run


def _searched(vectors: DataFrame, parts: DataFrame, asked: DataFrame, size: int, k: int) -> DataFrame:
    """``asked`` (id, v, cell, angle, reach) against the vectors of those cells."""
    blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("blocks"))
    held = lookup(vectors, parts, ["cell"], "inner").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    held = lookup(held, blocks, ["cell"], "inner").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    wanted = lookup(lookup(asked, blocks, ["cell"], "inner"), parts, ["cell"], "inner").withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit(3)), "blocks").cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    task = ["cell", "part", "block"]
    return held.select(*task, "id", "v", "angle").groupBy(*task).cogroup(
        wanted.select(*task, "id", "v", "angle", "reach").groupBy(*task)).applyInArrow(_compare(size, k), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("question").orderBy(F.desc("similarity"), "id")
    return found.where("id IS NOT NULL").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_many(df: DataFrame, vector: str, name: str, questions: DataFrame, k: int, size: int, most_centres: int = CENTRES) -> tuple[DataFrame, DataFrame]:
    """question, rank, id, similarity: the k most similar rows of ``df`` for every row of ``questions`` (same columns), ties by id; and
    question, compared: with how many vectors each was compared. ``name`` is a 64-bit integer id. A row without direction matches nothing."""
    spark = df.sparkSession
    units, asking = materialise(_units(df, vector, name, size)), _units(questions, vector, name, size)
    some = units.orderBy(F.xxhash64("id")).limit(most_centres).select("v").toArrow()
    if not some.num_rows:
        none = spark.createDataFrame([], "question long, rank int, id long, similarity double")
        return none, none.select("question", F.lit(0).cast("long").alias("compared"))
    centres = spark.sparkContext.broadcast(_matrix(some["v"], size))
    vectors = materialise(_placed(units, centres, size, False))
    asked = materialise(_placed(asking, centres, size, True))
    cells = materialise(vectors.groupBy("cell").agg(
        F.ceil(F.count("*") / PART).cast("int").alias("parts"), F.min("angle").alias("near"), F.max("angle").alias("far")))
    parts = cells.select("cell", "parts")

    first = materialise(_searched(vectors, parts, asked.select("id", "v", "cell", "angle", F.lit(7.0).alias("reach")), size, k))
    kth = _best(first, k).groupBy("question").agg(F.count("*").alias("n"), F.min("similarity").alias("least"))
    reach = F.when(F.col("n") == k, F.acos(F.greatest(F.lit(-1.0), F.col("least") - SLACK))).otherwise(F.lit(7.0))
    bounds = kth.select(F.col("question").alias("id"), reach.alias("reach"))
    spread = cells.select(F.col("cell").alias("other"), "near", "far")  # CENTRES rows at most
    others = lookup(asked, bounds, ["id"]).select(
        "id", "v", "cell", F.coalesce("reach", F.lit(7.0)).alias("reach"), F.posexplode("angles").alias("other", "angle"))
    others = others.where("other <> cell").join(F.broadcast(spread), "other").where(
        (F.col("angle") - F.col("reach") <= F.col("far") + 1e-9) & (F.col("angle") + F.col("reach") >= F.col("near") - 1e-9))
    second = _searched(vectors, parts, others.select("id", "v", F.col("other").alias("cell"), "angle", "reach"), size, k)
    both = materialise(first.unionByName(second))
    compared = both.groupBy("question").agg(F.sum("compared").alias("compared"))
    return _best(both, k).select("question", "rank", "id", "similarity"), compared
