"""Five stages from raw documents to packed training sequences.

Every stage reads what the one before kept. All but the last return the columns of ``documents``; what a
stage decides on is worked out inside it and takes effect there. Stages are written as Parquet under the
checkpoint folder that all executors share, so a lost executor repeats part of one stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import dart_minhash, decontaminate, exact_dedup, language_id
from daybook.llm.registered import packed, table
from daybook.llm.rows import held_out, quoted
from daybook.session import ensure_checkpoint_dir


def _as(docs: DataFrame, out: DataFrame) -> DataFrame:
    return out.select(*[quoted(c) for c in docs.columns])


def _judged(docs: DataFrame, results: list[tuple], judge: Callable[[DataFrame], DataFrame], keep: str) -> DataFrame:
    """The documents for which ``keep`` holds of what ``judge`` adds; own columns with a result's name step aside meanwhile."""
    taken = {name.lower() for name, _ in results}
    aside = {name: f"own {name}" for name in docs.columns if name.lower() in taken}
    kept = judge(docs.withColumnsRenamed(aside)).where(keep).drop(*[name for name, _ in results])
    return _as(docs, kept.withColumnsRenamed({held: name for name, held in aside.items()}))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; ambiguous ones stay, and so does every one where no row has a label to learn from."""
    model = language_id.train(docs.select("doc_id", "text", "lang"), teaches=~held_out(F.col("doc_id")))
    return _judged(docs, language_id.RESULTS, lambda d: language_id.predict(d, model), "letter")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id."""
    return _as(docs, exact_dedup.drop_copies(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the one with the smallest doc_id."""
    return _as(docs, dart_minhash.drop_near_copies(docs))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    items = table(spark, sf_dir, "benchmark")
    return _judged(docs, decontaminate.RESULTS, lambda d: decontaminate.find_contamination(d, items), "NOT contaminated")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packed(docs)


STAGES = [
    ("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", clean), ("packing", packing),
]

#: The packing needs a tokenizer, which SQL does not have; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    out = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made = stage(spark, out, sf_dir)
        path = f"{folder}/{name}"
        made.write.parquet(path)
        out = spark.read.schema(made.schema).parquet(path)
    return out
