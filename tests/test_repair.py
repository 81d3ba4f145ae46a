"""Backfills, hot keys, scans, adjusted prices and sketches on hand-made panels."""

import datetime as dt
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meadowlark.functions import indicators
from meadowlark.operators import adjust, backfill, fundamentals, quality, rs, sketches

DAYS = [dt.date(2019, 1, 1) + dt.timedelta(days=i) for i in range(1900)]
BAR = "symbol string, dt date, open double, high double, low double, close double, volume long"


def made(spark, skip=lambda s, d: False, symbols="abcdef"):
    rng = random.Random(4)
    rows = []
    for s in symbols:
        for d in DAYS:
            x = rng.uniform(5, 9)
            if not skip(s, d):
                rows.append((s, d, x, x, x, x, 10))
    return spark.createDataFrame(rows, BAR)


@pytest.fixture(scope="module")
def gap():
    return lambda s, d: dt.date(2021, 3, 1) <= d <= dt.date(2021, 4, 15) and s != "a"


def write(spark, bars, base):
    dim = spark.createDataFrame([(s, s.upper(), "S", "I") for s in "abcdefn"], "symbol string, name string, sector string, industry string")
    backfill.write_panel(bars.join(rs.individual(bars, calendar="all").drop("rank"), ["symbol", "dt"], "left"), dim, base)
    return dim


def panel_of(spark, base):
    return {(r.symbol, r.dt): (r.close, r.rs_percentile) for r in backfill.read_years(spark, base, list(range(2019, 2026))).collect()}


def full(spark, bars):
    scored = bars.join(rs.individual(bars, calendar="all"), ["symbol", "dt"], "left").collect()
    return {(r.symbol, r.dt): (r.close, r.rs_percentile) for r in scored}


def test_backfill_equals_full_recomputation(spark, tmp_path, gap):
    base = str(tmp_path / "p")
    held, whole = made(spark, gap), made(spark)
    dim = write(spark, held, base)
    before = panel_of(spark, base)
    offered = whole.where("dt between date'2021-03-01' and date'2021-04-15'").withColumn("close", F.when(F.col("symbol") == "a", 1000.0).otherwise(F.col("close")))

    fresh = backfill.new_bars(spark, base, offered)
    assert fresh.where("symbol = 'a'").count() == 0 and fresh.count() == 5 * 46
    what = backfill.plan(spark, base, fresh)
    assert what.write == (2021,) and what.read == (2020, 2021) and len(what.dirty) == 46 + backfill.LOOKBACK
    rows = backfill.backfill(spark, base, offered)
    scans = re.findall(r"FileScan json.*?PartitionFilters: \[(.*?)\], ", rows._jdf.queryExecution().executedPlan().toString())
    assert scans and all("2020,2021" in x.replace(" ", "") for x in scans)

    times = {p: p.stat().st_mtime for p in (tmp_path / "p" / "core").rglob("*.json")}
    done = backfill.apply(spark, base, offered, dim, keep=False)
    assert panel_of(spark, base) == full(spark, whole)
    assert {r.dt.year for r in done.where("changed").select("dt").collect()} == {2021}
    assert all(p.exists() and p.stat().st_mtime == t for p, t in times.items() if "year=2021" not in str(p))  # other years lie untouched
    assert backfill.apply(spark, base, offered, dim, keep=False).where("changed").count() == 0  # a rerun changes nothing
    assert before != panel_of(spark, base)


def test_backfill_keeps_scores(spark, tmp_path, gap):
    base = str(tmp_path / "p")
    whole = made(spark)
    dim = write(spark, made(spark, gap), base)
    before, all_ = panel_of(spark, base), full(spark, whole)
    backfill.apply(spark, base, whole.where("year(dt) = 2021"), dim)
    after = panel_of(spark, base)
    assert set(after) == set(all_)
    for k, (close, score) in after.items():
        old = before.get(k, (None, None))[1]
        assert close == all_[k][0] and score == (old if old is not None else all_[k][1])


def test_backfill_of_a_symbol_that_becomes_long_enough(spark, tmp_path):
    """Symbol n has 250 closes: three more give it scores wherever it has rows, so all its years are ranked again."""
    base = str(tmp_path / "p")
    only = DAYS[700:953]
    whole = made(spark, lambda s, d: s == "n" and d not in only, "abcn")
    late = F.col("dt").isin(only[-3:]) & (F.col("symbol") == "n")
    dim = write(spark, whole.where(~late), base)
    assert not any(s == "n" and v is not None for (s, _), (_, v) in panel_of(spark, base).items())
    backfill.apply(spark, base, whole.where(late), dim, keep=False)
    assert panel_of(spark, base) == full(spark, whole)
    empty = backfill.backfill(spark, base, whole.limit(0))
    assert empty.count() == 0


def test_sliced_announcements(spark):
    rng = random.Random(8)
    start = dt.date(2024, 1, 1)
    at = lambda: start + dt.timedelta(days=rng.randrange(400))
    periods = spark.createDataFrame([("hot" if i % 5 else None, at(), i) for i in range(300)] + [("lone", start, 1), ("hot", start, 0), ("hot", start, 0)], "k string, period_end date, n int")
    events = spark.createDataFrame([("hot", at(), i, float(i)) for i in range(30)] + [("hot", start, 99, 9.0), ("hot", start, 98, 8.0)], "k string, announced date, idx int, eps double")
    for days, tolerance in ((7, 120), (30, 120), (1, 10), (500, 120)):
        want = fundamentals.next_announcement(periods, events, "k", tolerance)
        got = fundamentals.next_announcement_sliced(periods, events, "k", tolerance, days).select(want.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == 303
    assert fundamentals.next_announcement_sliced(periods, events.limit(0), "k").where("eps is not null").count() == 0
    assert fundamentals.next_announcement_sliced(periods.limit(0), events, "k").count() == 0


def test_ema_scan(spark):
    rng = random.Random(2)
    xs = [None if i % 37 == 5 else rng.uniform(-5, 1e4) for i in range(1500)]
    rows = [("long", DAYS[i], x) for i, x in enumerate(xs)] + [("one", DAYS[0], 7.0), ("none", DAYS[0], None)]
    df = spark.createDataFrame(rows, "symbol string, dt date, close double")
    for span in (1, 2, 21, 300):
        want = pd.Series([x for x in xs if x is not None]).ewm(span=span, adjust=False).mean().tolist()
        out = indicators.ema_scan(df, F.year("dt"), span, rows_at_once=100)
        got = [r.ema for r in out.where("symbol = 'long'").orderBy("dt").collect()]
        assert got == pytest.approx(want, rel=1e-9, abs=1e-6)
        assert out.where("symbol = 'one'").first().ema == 7.0 and out.where("symbol = 'none'").count() == 0
    plan = indicators.ema_scan(df, F.year("dt"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1 and "collect_list(struct(_bucket" in plan  # of chunks, not of rows


def test_adjusted_prices(spark):
    d = DAYS
    bars = spark.createDataFrame([("a", d[i], 100.0 + i, 100.0 + i, 100.0 + i, 100.0 + i, 10.0) for i in range(6)] + [("b", d[0], 1.0, 1.0, 1.0, 1.0, 1.0)], "symbol string, dt date, open double, high double, low double, close double, volume double")
    actions = spark.createDataFrame([("a", d[2], 2.0, None), ("a", d[4], None, 10.3), ("a", d[4], 4.0, None), ("a", d[0], 3.0, None), ("b", d[3], None, 5.0), ("c", d[1], 2.0, 1.0)], "symbol string, ex_date date, ratio double, dividend double")
    got = {(r.symbol, r.dt): r for r in adjust.adjusted(bars, actions).collect()}
    assert len(got) == 7
    late = (1 - 10.3 / 103.0) / 4
    for i, factor in enumerate([late / 2, late / 2, late, late, 1, 1]):
        r = got["a", d[i]]
        assert r.factor == pytest.approx(factor) and r.close == pytest.approx((100 + i) * factor) == pytest.approx(r.open)
    assert got["a", d[0]].volume == pytest.approx(80) and got["a", d[3]].volume == pytest.approx(40) and got["a", d[5]].volume == 10
    assert got["b", d[0]].close == 1.0  # a dividend above the price changes nothing
    one = adjust.adjusted(bars, actions.where("ratio = 2")).where("symbol = 'a'").orderBy("dt").collect()
    assert [r.factor for r in one] == pytest.approx([0.5, 0.5, 1, 1, 1, 1])  # only dates before the event
    assert adjust.adjusted(bars, actions.limit(0)).where("factor <> 1").count() == 0


def test_sketches_merge(spark):
    df = spark.range(60000).select((F.col("id") % 700).cast("string").alias("symbol"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int")).alias("dt"), (F.col("id") * 7919 % 60000 / 600.0).alias("rs_percentile"))
    kept = sketches.yearly(df)
    one, all_ = sketches.told(sketches.merged(kept)).first(), sketches.told(sketches.yearly(df.withColumn("dt", F.lit("2020-01-01").cast("date")))).first()
    assert one.n == 60000 and abs(one.total_symbols - 700) <= 35 and abs(one.total_days - 1000) <= 50 and abs(one.median - 50) <= 1
    assert abs(one.median - all_.median) <= 2 and (one.low, one.high) == (all_.low, all_.high)
    assert sketches.told(kept).count() == 3
    rank = sketches.merged(kept).select(sketches.rank_of("scores", F.lit(25.0)).alias("r")).first().r
    assert abs(rank - 0.25) <= sketches.RANK_ERROR


def test_types_of_documents(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": {"c": "1", "d": [1]}}',), ('{"a": "1", "b": null}',), ('{"a": 1.5, "b": {"c": true, "d": {"e": {"f": 1}}}}',), (None,), ("{bad",), ("[1]",)], "doc string")
    got = {(r.field, r.type): r.n for r in quality.document_types(docs, "doc").collect()}
    assert got == {("a", "integer"): 1, ("a", "string"): 1, ("a", "double"): 1, ("b", "object"): 2, ("b", "null"): 1, ("b.c", "string"): 1, ("b.c", "boolean"): 1, ("b.d", "array"): 1, ("b.d", "object"): 1, ("b.d.e", "object"): 1}
