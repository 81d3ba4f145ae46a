"""Hand-made panels with known answers."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from meadowlark.functions import indicators, scalars
from meadowlark.operators import panel, rank, rs

D = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(400)]


def bars(spark, rows):
    """rows: symbol -> list of closes by date, None for a missing row."""
    data = [(s, D[i], float(c), float(c), float(c), float(c), 10.0) for s, cs in rows.items() for i, c in enumerate(cs) if c is not None]
    return spark.createDataFrame(data, "symbol string, dt date, open double, high double, low double, close double, volume double")


def test_lag_counts_calendar_positions(spark):
    b = panel.positioned(bars(spark, {"a": [1, 2, 4, 8, 16], "b": [1, None, 3, 4, 5], "c": [1, 1, None, 1, 1]}))
    got = {(r.symbol, r.dt): r.x for r in b.select("symbol", "dt", panel.pct_change("close", 2).alias("x")).collect()}
    assert got["a", D[2]] == 300 and got["b", D[2]] == 200
    assert got["b", D[3]] is None  # b has no row two dates before
    assert got["c", D[3]] == 0 and got["c", D[4]] is None


def test_zero_before_gives_null(spark):
    b = panel.positioned(bars(spark, {"a": [0, 5]}))
    assert [r.x for r in b.select(panel.pct_change("close", 1).alias("x"), "dt").orderBy("dt").collect()] == [None, None]


def test_percentile_and_rank_with_ties(spark):
    df = spark.createDataFrame([("d", "a", 1.0), ("d", "b", 2.0), ("d", "c", 2.0), ("d", "e", 3.0), ("d", "n", None), ("x", "a", 7.0), ("y", "a", None)], "d string, s string, v double")
    got = {(r.d, r.s): (r.p, r.r) for r in rank.percentile(df, "v", ["d"], "p", "r").withColumn("same", rank.competition_rank("v", ["d"])).where("same <=> r").collect()}
    assert len(got) == 7
    want = pd.Series([1.0, 2, 2, 3]).rank(pct=True) * 98 + 1
    assert [got["d", s][0] for s in "abce"] == list(want)
    assert [got["d", s][1] for s in "abce"] == [4, 2, 2, 1]
    assert got["d", "n"] == (None, None) and got["x", "a"] == (99.0, 1) and got["y", "a"] == (None, None)


def test_rs_equals_pandas(spark):
    import random

    random.seed(3)
    rows = {s: [random.choice([None, 1, 2, 3]) and random.uniform(5, 9) if random.random() > 0.02 else None for _ in range(300)] for s in "abcdef"}
    rows["short"] = [1.0] * 100
    wide = pd.DataFrame({s: pd.Series([float("nan") if c is None else c for c in cs]) for s, cs in rows.items()})
    wide = wide[[s for s in wide if wide[s].count() >= 252]]
    wide = wide[wide.notna().any(axis=1)]
    raw = sum(wide.pct_change(n, fill_method=None) * 100 * w for n, w in rs.LEGS.items())
    want = (raw.rank(axis=1, pct=True) * 98 + 1).stack().dropna()
    got = {(D.index(r.dt), r.symbol): r.rs_percentile for r in rs.individual(bars(spark, rows)).collect()}
    assert set(got) == set(want.index) and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_calendar_option(spark):
    b = bars(spark, {"a": list(range(1, 301)), "z": [None] * 300 + [5]})
    assert rs.raw(b).where("rs_raw is not null").count() == rs.raw(b, calendar="all").where("rs_raw is not null").count() == 48


def test_weights(spark):
    rows = [("a", D[0], 2.0, 3.0), ("a", D[1], None, 5.0), ("b", D[0], 4.0, 2.0), ("b", D[1], 3.0, 0.0), ("c", D[0], None, None)]
    b = spark.createDataFrame(rows, "symbol string, dt date, close double, volume double")
    w = {k: {r.symbol: r.weight for r in rs.weights(b, k).collect()} for k in ("last_row", "ffill", "last_valid")}
    assert w["last_row"] == {"a": 1.0, "b": 0.0, "c": 1.0}
    assert w["ffill"] == {"a": 10.0, "b": 1.0, "c": 1.0}
    assert w["last_valid"] == {"a": 6.0, "b": 0.0, "c": 1.0}
    with pytest.raises(ValueError):
        rs.weights(b, "none")


def test_groups_leave_out_unclassified(spark):
    scores = spark.createDataFrame([("a", D[0], 10.0), ("b", D[0], 20.0), ("c", D[0], 90.0), ("d", D[0], 50.0)], "symbol string, dt date, rs_percentile double")
    members = spark.createDataFrame([("a", "a", "X", "i"), ("b", "b", "X", "i"), ("c", "c", "N/A", "N/A"), ("d", "d", None, ""), ("e", "e", "X", "j")], "symbol string, name string, sector string, industry string")
    weight = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 1.0), ("d", 1.0)], "symbol string, weight double")
    assert [tuple(r) for r in rs.group_raw(scores, members, weight, "sector").collect()] == [("X", D[0], 17.5)]
    assert [(r.sector, r.rs_percentile, r.rank, r.stock_count) for r in rs.group(scores, members, weight, "sector").collect()] == [("X", 99.0, 1, 3)]
    zero = weight.withColumn("weight", F.lit(0.0))
    assert rs.group_raw(scores, members, zero, "sector").first().group_raw is None


def test_tail_counts_empty_dates(spark):
    df = spark.createDataFrame([("a", D[0], 1.0), ("a", D[1], 2.0)], "symbol string, dt date, v double")
    dates = spark.createDataFrame([(d,) for d in D[:4]], "dt date")
    assert [r.dt for r in panel.tail_dates(df, 3, dates).collect()] == [D[1]]


def test_dense_grid_latest_and_fill(spark):
    b = bars(spark, {"a": [1, 2, None], "b": [None, None, 5]})
    assert panel.dense(b).count() == 6
    assert {r.symbol: r.close for r in panel.latest(b).collect()} == {"a": 2.0, "b": 5.0}
    assert panel.drop_empty(spark.createDataFrame([(None, None), (1.0, None)], "close double, volume double")).count() == 1


def test_indicators_equal_pandas(spark):
    import random

    random.seed(5)
    closes = [random.uniform(10, 20) for _ in range(60)]
    rows = [("a", D[i], c, c + random.random(), c - random.random(), c, 100.0 + i) for i, c in enumerate(closes)]
    b = spark.createDataFrame(rows, "symbol string, dt date, open double, high double, low double, close double, volume double")
    p = pd.DataFrame(rows, columns=["s", "dt", "open", "high", "low", "close", "volume"])

    def close(got, want):
        for g, w in zip(got, want, strict=True):
            assert (g is None and pd.isna(w)) or abs(g - w) < 1e-9

    col = lambda df, c: [r[c] for r in df.orderBy("dt").collect()]
    close(col(indicators.with_smas(b, (20,)), "sma20"), p.close.rolling(20).mean())
    close(col(indicators.ema(b), "ema"), p.close.ewm(span=21, adjust=False).mean())
    before = p.close.shift(1)
    tr = pd.concat([p.high - p.low, (p.high - before).abs(), (p.low - before).abs()], axis=1).max(axis=1)
    close(col(indicators.with_atr(b), "atr"), tr.rolling(14).mean())
    d = p.close.diff()
    gain, loss = d.clip(lower=0).rolling(14).mean(), (-d).clip(lower=0).rolling(14).mean()
    close(col(indicators.rsi(b), "rsi"), 100 - 100 / (1 + gain / loss))
    money, big = p.close * p.volume, d.abs() >= tr.rolling(14).mean() * 0.3
    up, down = money.where(big & (d > 0), 0).rolling(20).sum(), money.where(big & (d < 0), 0).rolling(20).sum()
    close(col(indicators.buying_pressure(b), "buying_pressure"), (up / (up + down)).where(up + down > 0))
    typical = (p.high + p.low + p.close) / 3
    close(col(indicators.vwap(b), "vwap"), (typical * p.volume).cumsum() / p.volume.cumsum())


def test_scalars(spark):
    keys = {"stocks/daily/core/2020/A.json": 2020, "scores/sector/2024.json": 2024, "meta/list.csv": None, "x/20201/A.json": None, "2019/b.json": 2019}
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    assert {r.key: r.y for r in df.select("key", scalars.year_of_key(F.col("key")).alias("y")).collect()} == keys
    prefixes = [r.p for r in df.select(scalars.prefix_of_key(F.col("key"), ["stocks", "scores"]).alias("p")).collect()]
    assert prefixes == ["stocks/daily/core", "scores/sector", "meta", "x", "2019"]
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    assert get(scalars.human_size(F.lit(1536))) == "1.50 KB" and get(scalars.human_size(F.lit(5))) == "5.00 B"
    assert get(scalars.prefix_of_key(F.lit("a.json"), [])) == "(root)"
    assert get(scalars.local_time(F.lit("2024-07-01 13:30:00").cast("timestamp"))) == "2024-07-01T09:30:00"
    assert get(scalars.with_suffix(F.lit("130A"))) == "130A.T" and get(scalars.with_suffix(F.lit("^N225"))) == "^N225"
    assert get(scalars.without_suffix(F.lit("1306.T"))) == "1306" and get(scalars.without_suffix(F.lit("A"))) == "A"
    assert get(scalars.rounded(F.lit(0.125), 2)) == 0.13 and get(scalars.rounded(F.lit(0.125), 2, "even")) == 0.12


def test_ranks_of_one_hot_group(spark):
    """All rows in one group, a third of them with one value: the spread form equals the window form."""
    i = F.col("id")
    df = spark.range(4000).select("id", F.lit("d").alias("d"), F.when(i % 11 != 0, F.when(i % 3 == 0, 7).otherwise(F.floor(F.sqrt("id")))).cast("double").alias("v"))
    want = rank.percentile(df, "v", ["d"], "p", "r")
    got = rank.percentile_spread(df, "v", ["d"], "p", "r").select(want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == 4000
    assert rank.percentile_spread(df.limit(0), "v", ["d"], "p").count() == 0
    groups = df.withColumn("d", F.when(i % 2 == 0, "x"))  # a null group is a group
    want = rank.percentile(groups, "v", ["d"], "p", "r")
    assert rank.percentile_spread(groups, "v", ["d"], "p", "r").select(want.columns).exceptAll(want).count() == 0
    # the windows of the spread form are by group and range, none by the group alone but over a row a range
    plan = rank.percentile_spread(df, "v", ["d"], "p")._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan and "rank(" not in plan


def test_numbers_over_ranges(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), "id")
    got = [(r.k, r.id) for r in rank.numbered(df, [F.desc("k"), F.asc("id")]).orderBy("n").collect()]
    assert got == sorted(((i % 7, i) for i in range(3000)), key=lambda x: (-x[0], x[1]))
    assert rank.numbered(df.limit(0), [F.asc("id")]).count() == 0


def test_groups_share_exchanges(spark):
    """The ranks of a day's symbols are worked out once, though sectors, industries and symbols use them."""
    import re

    rng = __import__("random").Random(1)
    b = bars(spark, {s: [rng.uniform(5, 9) for _ in range(260)] for s in "abcd"})
    dim = spark.createDataFrame([(s, s, "S", "I") for s in "abcd"], "symbol string, name string, sector string, industry string")
    scores, weight = rs.individual(b), rs.weights(b)
    out = rs.day_summary(scores, dim, rs.group(scores, dim, weight, "sector", 6), rs.group(scores, dim, weight, "industry", 6))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"ReusedExchange", final)) >= 4
