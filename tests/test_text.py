"""Sections, picks, grounding, enrichment, vectors and text helpers."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import text as tx
from daybook.functions.dates import utc_naive
from daybook.operators.daily_pick import daily_pick, incremental_todo, replace_documents
from daybook.operators.enrich import enrich, failures, succeeded
from daybook.operators.sections import HEADER, split_sections
from daybook.operators.vectors import cosine_topk, unit_literal
from daybook.plans.three_way import three_way_compare
from tests.conftest import rows

LONG = "a line that is certainly longer than forty characters"


def _split(spark, text, **kw):
    df = split_sections(spark.createDataFrame([(1, text)], "id int, t string"), "t", ["id"], **kw)
    return rows(df.select("section_index", "section_name", "content"), "section_index")


def test_sections(spark):
    text = "\n".join([
        "preamble dropped", ".FIRST SECTION..." + LONG, "  more   text", "&&", "outside any section, " + LONG,
        ".SHORT...too short", ".SECOND /UNTIL TONIGHT/..." + LONG, " $$ ", ".lower case... no header", ".THIRD...", LONG])
    assert _split(spark, text) == [
        (0, "FIRST SECTION", LONG + " more text"), (1, "SECOND /UNTIL TONIGHT/", LONG), (2, "THIRD", LONG)]


def test_every_kind_of_line_end(spark):
    text = f"x\r\n.A...{LONG} tail\x85.B...{LONG}\r&&\n.C...{LONG}\u2028\u2003more\u00a0of\u3000it"
    assert _split(spark, text) == [(0, "A", LONG + " tail"), (1, "B", LONG), (2, "C", LONG + " more of it")]


def test_text_without_sections(spark):
    assert _split(spark, "nothing here") == [] and _split(spark, "") == [] and _split(spark, None) == []


def _plain_split(text, minimum):
    """The rule read off its description, line by line."""
    out, name, body = [], None, []
    for line in [*re.split(r"\r\n|\n", text), "$$"]:
        m = re.match(HEADER, line.strip())
        if m or line.strip() in ("&&", "$$"):
            content = " ".join(" ".join(body).split())
            if name and len(content) >= minimum:
                out.append((len(out), name, content))
            name, body = (m.group(1).strip(), [m.group(2)]) if m else (None, [])
        elif name:
            body.append(line)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([".A...", ".B C... x", "&&", "$$", " && ", "word", "two  words", "", ".bad..", ".A /B/...y z"]), max_size=12))
def test_sections_property(spark, lines):
    text = "\n".join(lines)
    assert _split(spark, text, min_chars=3) == _plain_split(text, 3)


def test_daily_pick(spark):
    docs = spark.createDataFrame([
        (1, datetime(2024, 1, 1, 2)), (2, datetime(2024, 1, 1, 6)), (3, datetime(2024, 1, 2, 4, 59)),
        (4, datetime(2024, 1, 2, 5)), (5, datetime(2024, 1, 2, 5)), (6, datetime(2024, 1, 4, 7)),
    ], "id int, issued timestamp_ntz")
    picks = daily_pick(docs, "issued", "id", "2024-01-04").select("run_date", "id")
    # id 1 lies before the first full window, 4 and 5 tie, 6 belongs to the day after as_of
    assert rows(picks, "run_date") == [(date(2024, 1, 2), 3), (date(2024, 1, 3), 5)]
    done = spark.createDataFrame([(date(2024, 1, 3),)], "target_date date")
    todo = incremental_todo(daily_pick(docs, "issued", "id", "2024-01-04"), done)
    assert rows(todo.select("target_date", "id")) == [(date(2024, 1, 4), 5)]


def test_replacing_documents_drops_leftovers(spark):
    stored = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "doc string, i int")
    fresh = spark.createDataFrame([("a", 0)], "doc string, i int")
    assert rows(replace_documents(stored, fresh, "doc", ["doc", "i"]), "doc", "i") == [("a", 0), ("b", 0)]


@pytest.mark.parametrize("quote,found", [
    ("Rain is likely", True), ("RAIN   is\nlikely", True), ("rain is certain", False), ("", False), ("  ", False),
])
def test_grounding(spark, quote, found):
    df = spark.createDataFrame([(quote, "Today rain is  likely.")], "q string, s string")
    assert df.select(tx.is_verbatim(F.col("q"), F.col("s"))).first()[0] is found


def test_enrichment_keeps_failures_apart(spark):
    def vector(text):
        if not text:
            raise ValueError("empty")
        return [float(len(text)), 1.0]

    df = spark.createDataFrame([(1, "abc"), (2, ""), (3, "de")], "id int, t string")
    done = enrich(df, "t", ["id"], vector, T.ArrayType(T.DoubleType()))
    assert rows(succeeded(done), "id") == [(1, [3.0, 1.0]), (3, [2.0, 1.0])]
    assert rows(failures(done, "id", "s", "t").select("status", "detail")) == [("warn", "left open for the next run: 2, ValueError: empty")]
    per_task = enrich(df, "t", ["id"], vector, T.ArrayType(T.DoubleType()), setup=lambda: (lambda t: [0.0]))
    assert per_task.where("error IS NULL").count() == 3


def test_cosine(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 2.0]), (3, [0.0, 0.0]), (4, [1.0]), (5, [3.0, 0.0])],
                               "id int, v array<float>")
    top = cosine_topk(df, "v", "id", {"x": unit_literal([2.0, 0.0]), "y": unit_literal([0, 1])}, k=2)
    assert rows(top, "question", "rank") == [("x", 1, 1, 1.0), ("x", 2, 5, 1.0), ("y", 1, 2, 0.707107), ("y", 2, 1, 0.0)]
    with pytest.raises(ValueError):
        unit_literal([0.0, 0.0])


def test_snippet_and_highlight(spark):
    long = "word " * 50
    df = spark.createDataFrame([("short", long, "Rain rained_x drain RAINY")], "a string, b string, c string")
    got = df.select(tx.snippet(F.col("a")), tx.snippet(F.col("b")), tx.highlight(F.col("c"), ["rain"]), tx.clip(F.col("b"), 6)).first()
    assert got[0] == "short"
    assert got[1] == long[:180].rsplit(" ", 1)[0] + " ..."
    assert got[2] == "**Rain** **rained**_x drain **RAINY**"
    assert got[3] == "word w..."


def test_offset_to_naive_utc(spark):
    df = spark.createDataFrame([("2026-09-18T00:30:00-04:00",)], "s string")
    assert df.select(utc_naive(F.col("s"))).first()[0] == datetime(2026, 9, 18, 4, 30)


def test_three_way_scoring(spark):
    def day(i):
        return date(2024, 1, i)

    calls = spark.createDataFrame([
        (day(1), "likely", True), (day(2), "none", True), (day(3), "possible", True), (day(4), "likely", False),
        (day(5), "likely", None), (day(9), "likely", True),
    ], "target_date date, call string, verified boolean").withColumns({
        "issued_at": F.lit(datetime(2024, 1, 1)), "high_f": F.lit(50.0), "low_f": F.lit(32.0), "gust_mph": F.lit(10.0),
        "hazards": F.array(F.lit("flood")), "summary": F.lit("s")})
    daily = spark.createDataFrame([("a", day(i), 5.0, 1.0, 2.0, 3.0) for i in (1, 2, 3, 4, 5, 9)] + [("b", day(1), 0.0, 0.0, 0.0, 0.0)],
                                  "key string, date date, rain double, hi double, lo double, wind double")
    forecasts = spark.createDataFrame([
        ("a", day(1), 0.0, 1.0, 1.0, True, "m"), ("a", day(1), 2.0, 1.0, 1.0, False, "m"), ("a", day(2), 0.5, 1.0, 1.0, True, "m"),
    ], "key string, target_date date, predicted_rain double, predicted_hi double, predicted_lo double, is_backtest boolean, model_type string")
    out = three_way_compare(calls, forecasts, daily, "a", "2024-01-09", "rain", "hi", "lo", "wind", 1.0)
    assert rows(out.select("target_date", "call_correct", "model_correct", "actual_amount"), "target_date") == [
        (day(1), True, True, 5.0), (day(2), False, False, 5.0), (day(3), None, None, 5.0), (day(4), None, None, 5.0),
        (day(5), True, None, 5.0), (day(9), None, None, None)]
    assert out.select("call_high", "call_low", "call_gust").first() == (10.0, 0.0, 16.1)
