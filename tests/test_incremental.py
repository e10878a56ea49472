"""Landing by listing, publishing by switch, blocked windows, as-of joins, stored fits, retraction, reach, calls paid once."""

from __future__ import annotations

import itertools
import os
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import lineage, nearest, retract
from daybook.operators.asof import as_of
from daybook.operators.blocked import BLOCK, lagged, rolling_mean, running_sums
from daybook.operators.dedupe import latest_wins
from daybook.operators.enrich import enrich_once
from daybook.operators.features import roll7_features
from daybook.operators.reads import tables_read
from daybook.operators.rollup import Measure, daily_rollup
from daybook.plans.fit_state import advance, fit_state
from daybook.plans.forecast import next_day_forecast, state_forecast, walk_forward
from daybook.session import materialise
from daybook.sources import landing, tables
from tests.conftest import rows

# ---- landing and publishing


def test_only_new_files_are_opened(spark, tmp_path, monkeypatch):
    for i in range(40):
        (tmp_path / f"k{i}.json").write_text(f'{{"n": {i}}}')
    key = F.regexp_extract("source_url", r"([^/]+)\.json$", 1)
    listing = landing.list_files(spark, str(tmp_path))
    assert listing.count() == 40 and listing.agg(F.sum("bytes")).first()[0] == sum(f.stat().st_size for f in tmp_path.iterdir())
    landed = materialise(listing.select("source_url", "fetched_at"))

    odd = tmp_path / "with space [1] {a,b}*.json"
    odd.write_text('{"odd": 1}')
    os.utime(tmp_path / "k3.json", (2_000_000_000, 2_000_000_000))  # rewritten
    opened = []
    monkeypatch.setattr(landing, "payload_files", lambda s, paths, k, read=landing.payload_files: opened.extend(paths) or read(s, paths, k))
    new = materialise(landing.new_versions(landed, landing.list_files(spark, str(tmp_path))))
    found = [r.raw_json for part in landing.new_payloads(spark, new, key, at_once=1) for r in part.collect()]
    assert sorted(found) == ['{"n": 3}', '{"odd": 1}'] and len(opened) == 2


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a.json").write_text("x" * 1000)
    text = landing.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in text.split("ReadSchema:")[1]


def test_window_of_versions(spark):
    listing = spark.createDataFrame([("a", datetime(2024, 1, d)) for d in range(1, 6)], "source_url string, fetched_at timestamp_ntz")
    landed = listing.where("fetched_at = '2024-01-03'")
    bound = lambda d: F.lit(f"2024-01-0{d}").cast("timestamp_ntz")
    assert rows(landing.new_versions(landed, listing, bound(2), bound(5)), "fetched_at") == [
        ("a", datetime(2024, 1, 2)), ("a", datetime(2024, 1, 4))]
    assert landing.new_versions(landed, listing).count() == 4


def test_failed_refresh_leaves_the_old_table(spark):
    name = "t_switch.numbers"
    tables.publish(spark.range(3).toDF("n"), name)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="lost"):
        tables.publish(broken, name)
    assert rows(spark.table(name), "n") == [(0,), (1,), (2,)]
    tables.publish(spark.table(name).select((F.col("n") * 10).alias("n")), name)  # may read what it replaces
    assert rows(spark.table(name), "n") == [(0,), (10,), (20,)]


def test_failed_refresh_of_partitions_leaves_the_old_ones(spark):
    name = "t_switch.by_day"
    df = spark.createDataFrame([(1, "a"), (2, "it's"), (3, None)], "n int, day string")
    tables.publish(df, name, ["day"])
    lost = df.select(F.when(F.col("n") == 3, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n") + 10).alias("n"), "day")
    with pytest.raises(Exception, match="lost"):
        tables.publish(lost, name, ["day"])
    assert rows(spark.table(name), "n") == [(1, "a"), (2, "it's"), (3, None)]
    tables.publish(spark.table(name).where("n <> 2").withColumn("n", F.col("n") + 10), name, ["day"])
    assert rows(spark.table(name), "n") == [(11, "a"), (13, None)]
    tables.publish(df.where("n = 2"), name, ["day"])
    assert rows(spark.table(name), "n") == [(2, "it's")]


@pytest.mark.parametrize("next_is_whole", [True, False])
def test_switch_is_finished_after_a_crash(spark, next_is_whole):
    name = f"t_switch.crash_{next_is_whole}".lower()
    tables.publish(spark.range(3).toDF("n"), name)
    if next_is_whole:
        spark.range(2).toDF("n").write.saveAsTable(f"{name}__next")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old")
    tables._settle(spark, name)
    assert spark.table(name).count() == (2 if next_is_whole else 3)
    assert not spark.catalog.tableExists(f"{name}__old")


# ---- blocked windows


def series(seed: int, n: int = 300):
    rng = random.Random(seed)
    days = sorted(rng.sample(range(900), n))
    return [(k, date(2020, 1, 1) + timedelta(days=d), rng.choice([None, round(rng.gauss(40, 9), 2)]) if rng.random() < 0.1 else round(rng.gauss(40, 9), 2))
            for k in ("a", "b", None) for d in days]


@pytest.mark.parametrize("width", [1, 3, 40, 5_000])
def test_blocks_do_not_change_windows(spark, width):
    df = spark.createDataFrame(series(width), "key string, date date, m double")
    cut = df.withColumn(BLOCK, F.floor(F.unix_date("date") / width))
    plain = "OVER (PARTITION BY key ORDER BY date"
    want = df.selectExpr(
        "key", "date", f"lag(m) {plain})", f"coalesce(sum(m) {plain} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    got = running_sums(lagged(cut, ["key"], ["date"], "m", "before"), ["key"], ["date"], {"total": F.col("m")})
    got = got.select("key", "date", "before", "total")
    near = lambda r: (r[0] or "", r[1], r[2], round(r[3], 6))
    assert sorted(map(near, got.collect()), key=repr) == sorted(map(near, want.collect()), key=repr)
    rolled = rolling_mean(cut, ["key"], ["date"], ["m"], 7, "roll7").select("key", "date", F.round("roll7_m", 8))
    assert sorted(rolled.collect(), key=repr) == sorted(roll7_features(df, ["m"]).select("key", "date", F.round("roll7_m", 8)).collect(), key=repr)


@pytest.mark.parametrize("days", [7, 100])
def test_walk_forward_by_blocks(spark, days):
    data = [(k, d, m, 5.0 if k == "b" else (m or 0.0) * 2) for k, d, m in series(4, 120) if k]
    df = spark.createDataFrame(data, "key string, date date, m double, c double")
    block = F.floor(F.unix_date("date") / days)
    order = ["key", "target_date"]
    want = rows(walk_forward(df, ["m", "c"], ["m"]), *order)
    assert len(want) > 60 and rows(walk_forward(df, ["m", "c"], ["m"], block=block), *order) == want


def test_one_long_key_uses_many_tasks(spark):
    df = spark.range(0, 200_000, 1, 8).select(
        F.lit("k").alias("key"), F.col("id").alias("at"), (F.col("id") % 10).cast("double").alias("m"), F.floor(F.col("id") / 1000).alias(BLOCK))
    out = running_sums(df, ["key"], ["at"], {"total": F.col("m")})
    assert out.agg(F.max("total")).first()[0] == 900_000 - 9
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1


# ---- as of


@pytest.mark.parametrize("block", ["HOUR", "DAY", "YEAR"])
def test_as_of(spark, block):
    rng = random.Random(3)
    at = lambda: datetime(2024, 1, 1) + timedelta(minutes=15 * rng.randrange(2_000))
    left = [(i, rng.choice(["a", "b", "c", None]), at() if rng.random() < 0.95 else None) for i in range(400)]
    right = [(rng.choice(["a", "b", None]), at() if rng.random() < 0.95 else None, i % 50) for i in range(60)]

    def known(k, t):
        return max(((w, v) for key, w, v in right if None not in (k, t, w) and key == k and w <= t), default=(None, None))[1]

    got = as_of(spark.createDataFrame(left, "id int, k string, t timestamp_ntz"),
                spark.createDataFrame(right, "k string, w timestamp_ntz, v int"), ["k"], "t", "w", ["v"], block)
    assert got.columns == ["id", "k", "t", "v"]
    assert rows(got, "id") == [(i, k, t, known(k, t)) for i, k, t in left]


def test_as_of_without_rows(spark):
    left = spark.createDataFrame([(1, "a", datetime(2024, 1, 1))], "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame([], "k string, w timestamp_ntz, v int")
    assert rows(as_of(left, right, ["k"], "t", "w", ["v"])) == [(1, "a", datetime(2024, 1, 1), None)]
    assert as_of(left.limit(0), right, ["k"], "t", "w", ["v"]).count() == 0


# ---- stored fits


def test_runs_add_days_to_stored_fits(spark):
    data = [(k, d, m, 7.0) for k, d, m in series(6, 60) if k] + [("late", date(2022, 6, 1) + timedelta(days=i), float(i % 5), 1.0) for i in range(20)]
    df = materialise(spark.createDataFrame(data, "key string, date date, m double, c double"))
    days = sorted({d for _, d, _, _ in data})
    state = fit_state(df.where(F.col("date") <= F.lit(days[30])), ["m", "c"])
    for low, high in itertools.pairwise([days[30], days[31], days[32], days[45], days[-1]]):
        state = materialise(advance(state, df.where((F.col("date") > F.lit(low)) & (F.col("date") <= F.lit(high))), ["m", "c"]))
    again = advance(state, df, ["m", "c"])  # days that are known change nothing
    want = rows(next_day_forecast(df, ["m", "c"]), "key")
    assert len(want) == 3
    assert rows(state_forecast(state, ["m", "c"]), "key") == want == rows(state_forecast(again, ["m", "c"]), "key")


# ---- late versions

MEASURES = (Measure("lo", "min", "v", 2), Measure("hi", "max", "v", 2), Measure("avg", "avg", "v", 2, scale=2), Measure("sum", "sum", "v", 2, scale=2))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_landings_gives_the_rebuilt_summary(spark, seed):
    rng = random.Random(seed)
    every = [(rng.choice("ab"), datetime(2024, 1, rng.randint(1, 3), rng.randrange(24)), rng.randrange(6), i,
              None if rng.random() < 0.1 else rng.randrange(500) / 100) for i in range(150)]
    schema = "key string, ts timestamp_ntz, version int, id int, v double"
    df = spark.createDataFrame(every, schema)
    rng.shuffle(every)
    parts = [every[:60], every[60:], every[:30]]  # the last lands again
    stored, state = spark.createDataFrame([], schema), None
    for part in parts:
        changes = materialise(retract.landing_changes(stored, spark.createDataFrame(part, schema), ["key", "ts"], "version", ["id"]))
        more = retract.value_counts(changes, "key", "ts", MEASURES)
        state = materialise(more if state is None else retract.with_counts(state, more))
        stored = materialise(retract.with_changed_rows(stored, changes, ["key", "ts"]))
    newest = latest_wins(df, ["key", "ts"], "version", ["id"])
    order = ["key", "date"]
    assert rows(retract.summary(state, MEASURES), *order) == rows(daily_rollup(newest, "key", "ts", MEASURES), *order)
    assert rows(stored, "key", "ts") == rows(newest.select(*stored.columns), "key", "ts")


# ---- reach


def test_reach_with_circles(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(45)] + [(1, 1), (None, 2), (2, None), (1, 2), (1, 2)]
    want = set()
    for start in (0, 1, 99):
        hops, last = {start: 0}, [start]
        while last:
            last = [b for x in last for a, b in edges if a == x and b is not None and b not in hops and not hops.update({b: hops[x] + 1})]
        want |= {(start, node, n) for node, n in hops.items()}
    got = lineage.reach(spark.createDataFrame(edges, "upstream int, downstream int"), spark.createDataFrame([(0,), (1,), (99,), (None,)], "node int"))
    assert sorted(rows(got)) == sorted(want)
    near = lineage.reach(spark.createDataFrame(edges, "upstream int, downstream int"), spark.createDataFrame([(1,)], "node int"), most_hops=1)
    assert sorted(rows(near)) == sorted(w for w in want if w[0] == 1 and w[2] <= 1)


# ---- calls paid once


def test_a_call_is_paid_once(spark, tmp_path):
    log = str(tmp_path)

    def asked(text):
        open(f"{log}/{abs(hash(text))}-{os.urandom(4).hex()}", "w").write(text or "")
        if text == "bad" and len([f for f in os.listdir(log)]) < 6:
            raise RuntimeError("busy")
        return len(text or "")

    def calls():
        return sorted(open(f"{log}/{f}").read() for f in os.listdir(log))

    docs = spark.createDataFrame([(1, "same"), (2, "same"), (3, "same"), (4, "bad"), (5, "bad"), (6, None), (7, "")], "id int, text string")
    once = lambda model: enrich_once(docs, "text", ["id"], asked, T.LongType(), model, "t_paid.results")
    first = rows(once("m1"), "id")
    assert calls() == ["", "", "bad", "same"]
    assert first[:3] == [(1, 4, None), (2, 4, None), (3, 4, None)] and first[5:] == [(6, 0, None), (7, 0, None)]
    assert [r[1:] for r in first[3:5]] == [(None, "RuntimeError: busy")] * 2
    rows(once("m1"))
    assert calls() == ["", "", "bad", "bad", "same"]  # only what failed is asked again
    again = rows(once("m1"), "id")
    assert again[3] == (4, 3, None) and calls().count("bad") == 3 and calls().count("same") == 1
    rows(once("m2"))
    assert calls().count("same") == 2  # another model is another call


# ---- many questions


@pytest.mark.parametrize("centres", [1, 7, 64])
def test_nearest_of_many_questions(spark, centres, monkeypatch):
    monkeypatch.setattr(nearest, "PART", 40)
    monkeypatch.setattr(nearest, "ASKED", 9)
    rng = np.random.default_rng(2)
    families = rng.normal(size=(6, 8))
    v = [(families[i % 6] + rng.normal(size=8) * 0.2).tolist() for i in range(250)] + [families[0].tolist()] * 120
    data = [(i, x) for i, x in enumerate(v)] + [(900, None), (901, [0.0] * 8), (902, [1.0] * 3), (903, [None] * 8)]
    df = spark.createDataFrame(data, "id long, v array<double>")
    found, compared = nearest.nearest_many(df, "v", "id", df.where("id % 9 = 0"), k=4, size=8, most_centres=centres)
    m = np.array(v) / np.linalg.norm(v, axis=1, keepdims=True)
    want = []
    for q in range(0, len(v), 9):
        scores = np.round(m @ m[q], 6)
        want += [(q, r + 1, int(i), float(scores[i])) for r, i in enumerate(np.lexsort((np.arange(len(v)), -scores))[:4])]
    got = [(q, r, i, round(s, 6)) for q, r, i, s in rows(found, "question", "rank")]
    assert got == want
    share = compared.agg(F.sum("compared")).first()[0] / (len(v) * len(range(0, len(v), 9)))
    assert share <= 1 and (centres < 64 or share < 0.6)
    none = nearest.nearest_many(df.limit(0), "v", "id", df, k=4, size=8)
    assert none[0].count() == 0 == none[1].count()


# ---- what a view reads


@pytest.mark.parametrize("sql,names", [
    ("SELECT 'from gold.fake' AS a -- silver.comment\nFROM gold.real AS silver_alias", {"gold.real"}),
    ("WITH x AS (SELECT * FROM bronze.a), y AS (SELECT * FROM x JOIN bronze.b USING (k)) SELECT * FROM y, x", {"bronze.a", "bronze.b"}),
    ("SELECT * FROM silver.t WHERE k IN (SELECT k FROM silver.u WHERE EXISTS (SELECT 1 FROM silver.w)) OR v > (SELECT max(v) FROM gold.m)",
     {"silver.t", "silver.u", "silver.w", "gold.m"}),
    ("SELECT * FROM a.t1 UNION ALL (SELECT * FROM a.t2 LEFT JOIN LATERAL (SELECT * FROM a.t3) ON true)", {"a.t1", "a.t2", "a.t3"}),
    ("WITH x AS (WITH y AS (SELECT 1 AS k) SELECT * FROM y) SELECT * FROM x JOIN y", {"y"}),
])
def test_tables_read(spark, sql, names):
    assert tables_read(spark, sql) == names
