"""Gates between layers and the log of runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.quality import Check, DataQualityError, run_suite, status_counts
from daybook.schemas import DQ_RESULTS, PIPELINE_RUNS
from daybook.sources.tables import append, ensure_table

# How old landed data and extractions may get, in hours.
MAX_STALENESS_HOURS = 30
MAX_EXTRACTION_LAG_HOURS = 72
# Failures that an error names; all of them are in the log.
SHOWN_FAILURES = 20


@dataclass(frozen=True)
class Gate:
    """The checks of one table after one step."""

    step: str
    target: str
    checks: tuple[Check, ...]


def run_gates(tables: dict[str, DataFrame], gates: Sequence[Gate]) -> DataFrame:
    """All check records: one aggregate per table."""
    parts = [run_suite(tables[g.target], g.step, g.target, g.checks) for g in gates]
    return reduce(DataFrame.unionByName, parts)


def warning(spark: SparkSession, step: str, check_name: str, target: str, detail: str) -> DataFrame:
    """A record for something skipped: an optional source that failed, a model without enough history."""
    row = [(step, check_name, target, "warn", detail)]
    return spark.createDataFrame(row, "step string, check_name string, target string, status string, detail string")


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class RunLog:
    """Records checks as they run and the run itself at the end, also when it fails.

    with RunLog(spark, started_at) as log:
        log.record(run_gates(tables, gates))
    """

    def __init__(self, spark: SparkSession, started_at: datetime, triggered_by: str = "local",
                 runs: str = "ops.pipeline_runs", results: str = "ops.dq_results"):
        self.spark, self.started_at, self.triggered_by = spark, started_at, triggered_by
        self.runs, self.results = runs, results
        self.run_id = started_at.strftime("%Y%m%dT%H%M%S")

    def __enter__(self) -> RunLog:
        ensure_table(self.spark, self.runs, PIPELINE_RUNS)
        ensure_table(self.spark, self.results, DQ_RESULTS)
        return self

    def record(self, checks: DataFrame) -> None:
        """Append the records from where they are made, then raise if one of them failed."""
        at = F.lit(_now()).cast("timestamp_ntz")
        rows = checks.select(F.lit(self.run_id).alias("run_id"), at.alias("checked_at"), "step", "check_name", "target", "status", "detail")
        rows.write.insertInto(self.results)
        own = self.spark.table(self.results).where((F.col("run_id") == self.run_id) & (F.col("checked_at") == at))
        failed = own.where("status = 'fail'").select(F.concat_ws(": ", "target", "detail").alias("said"))
        first = [r.said for r in failed.orderBy("said").limit(SHOWN_FAILURES + 1).collect()]
        if first:
            more = ["and others, see the log"] if len(first) > SHOWN_FAILURES else []
            raise DataQualityError("; ".join(first[:SHOWN_FAILURES] + more))

    def __exit__(self, kind, error, trace) -> None:
        # Counting from the stored records covers everything that was appended before an error.
        counts = status_counts(self.spark.table(self.results).where(F.col("run_id") == self.run_id)).first()
        message = f"{kind.__name__}: {error}" if kind else None
        n_pass, n_warn, n_fail = (counts.n_pass, counts.n_warn, counts.n_fail) if counts else (0, 0, 0)
        status = "failed" if message else ("warning" if n_warn else "success")
        row = [(self.run_id, self.started_at, _now(), status, n_pass, n_warn, n_fail, message, self.triggered_by)]
        append(self.spark.createDataFrame(row, PIPELINE_RUNS), self.runs)
