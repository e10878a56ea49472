"""One run over all branches: the numeric steps, the text branch, the comparison and the catalog, each behind its gates.

The numeric steps stop the run when a gate fails. The text branch is optional: documents whose calls failed
become warnings and stay open. Everything is recorded in one run of the log.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daybook.plans import catalog_run, daily_run, text_run
from daybook.plans.gates import MAX_STALENESS_HOURS, RunLog, run_gates
from daybook.plans.metrics import Metric
from daybook.plans.three_way import publish_comparison_view


@dataclass(frozen=True)
class TextConfig:
    """The text branch: where raw documents are stored, the caller's functions, and the believable ranges."""

    documents: str
    extract: text_run.Extract
    embed: text_run.Embed
    models: tuple[str, str]
    record: T.StructType = text_run.WEATHER_RECORD
    ranges: Sequence[tuple[str, float, float]] = text_run.WEATHER_RANGES
    max_age_hours: float = MAX_STALENESS_HOURS
    #: Arguments of the comparison view besides the tables; none publishes no view.
    comparison: dict | None = None


@dataclass(frozen=True)
class CatalogConfig:
    """The catalog: published metrics, lineage nodes and the texts they are built by, layers that must be documented."""

    metrics: Sequence[Metric]
    nodes: Callable[[SparkSession], DataFrame]
    texts: Callable[[SparkSession], DataFrame]
    documented_layers: Sequence[str] = field(default=("gold",))


def run(
    spark: SparkSession, path: str, config: daily_run.DailyConfig, now: datetime, text: TextConfig | None = None,
    catalog: CatalogConfig | None = None, triggered_by: str = "local", since: str | None = None, until: str | None = None,
) -> None:
    with RunLog(spark, now, triggered_by) as log:
        daily_run.steps(spark, log, path, config, now, since, until)
        catalog_run.publish_evaluation_view(spark, daily_run.FORECAST, daily_run.DAILY, config.metrics)
        if text:
            _text(spark, log, text, now)
        if catalog:
            catalog_run.run(spark, log, catalog.metrics, catalog.nodes(spark), catalog.texts(spark), catalog.documented_layers)


def _text(spark: SparkSession, log: RunLog, config: TextConfig, now: datetime) -> None:
    stamp = now.isoformat(sep=" ")
    documents = spark.table(config.documents)
    log.record(run_gates({config.documents: documents}, [text_run.documents_gate(stamp, config.documents, config.max_age_hours)]))
    log.record(text_run.run(spark, documents, now.date().isoformat(), config.extract, config.embed, config.models, record=config.record))
    gate = text_run.extraction_gate(stamp, config.ranges)
    log.record(run_gates({gate.target: spark.table(gate.target)}, [gate]))
    if config.comparison:
        publish_comparison_view(spark, text_run.EXTRACTION_TABLE, daily_run.FORECAST, daily_run.DAILY, **config.comparison)
