"""The text branch on stored tables."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from daybook.plans import gates, text_run
from daybook.schemas import RAW_DOCUMENTS
from tests.conftest import rows

BODY = "intro\n.FIRST PART...rain is likely over the whole of the city tomorrow\n&&\n.SECOND PART...winds stay light and nothing else is worth a word\n"


def _docs(spark):
    issued = [datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 9), datetime(2024, 1, 2, 9), datetime(2024, 1, 3, 9)]
    return spark.createDataFrame(
        [(f"d{i}", "x", t, t, "u", json.dumps({"productText": BODY + f"number {i}"})) for i, t in enumerate(issued)], RAW_DOCUMENTS)


def test_text_branch(spark):
    def extract(text, day, issued) -> dict:
        assert day.isoformat() > issued.date().isoformat()  # the day that the text is read for
        return {"rain_expected": "likely", "high_temp_f": 50.0, "hazards": ["wind"], "summary": "s",
                "evidence": "RAIN is  likely" if "number 1" in text else "made up"}

    def failing(text, day, issued) -> dict:
        if "number 2" in text:
            raise RuntimeError("quota " + "x" * 200)
        return extract(text, day, issued)

    def embed(texts: list[str]) -> list[list[float]]:
        return [[float(len(t)), 0.5] for t in texts]

    warned = text_run.run(spark, _docs(spark), "2024-01-04", failing, embed, ("rules", "lengths"), tasks=2)
    assert rows(warned) == [("discussions", "enriched", text_run.EXTRACTION_TABLE, "warn",
                             "left open for the next run: d2, RuntimeError: quota " + "x" * 200)]
    made = spark.table(text_run.EXTRACTION_TABLE)
    shown = made.select("doc_id", F.col("target_date").cast("string"), "evidence_verified", "low_temp_f", "hazards")
    assert rows(shown, "doc_id") == [("d1", "2024-01-03", True, None, ["wind"]), ("d3", "2024-01-05", False, None, ["wind"])]
    sections = spark.table(text_run.SECTION_TABLE).select("doc_id", "section_index", "section_name")
    assert rows(sections, "doc_id", "section_index")[:2] == [("d1", 0, "FIRST PART"), ("d1", 1, "SECOND PART")]

    # a broken embedding leaves the day open and stores nothing of it
    def no_second(texts: list[str]) -> list[list[float]]:
        if any(t.startswith("SECOND") for t in texts):
            raise ValueError("too long")
        return embed(texts)

    text_run.run(spark, _docs(spark), "2024-01-04", extract, no_second, ("rules", "lengths"), tasks=2)
    assert made.count() == 2 and spark.table(text_run.SECTION_TABLE).where("doc_id = 'd2'").count() == 0

    # the next run retries only the open day
    assert text_run.run(spark, _docs(spark), "2024-01-04", extract, embed, ("rules", "lengths"), tasks=2).count() == 0
    assert spark.table(text_run.EXTRACTION_TABLE).count() == 3
    assert spark.table(text_run.SECTION_TABLE).count() == 6

    gate = text_run.extraction_gate("2024-01-04 12:00:00")
    status = gates.run_gates({gate.target: spark.table(gate.target)}, [gate]).groupBy("status").count()
    assert dict(rows(status)) == {"pass": 6, "warn": 1}
