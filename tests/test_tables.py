"""Universes, facts, merges, plans of what to write, documents, readers."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meadowlark import schemas
from meadowlark.operators import fundamentals, market, merge, publish, quality, universe
from meadowlark.sources import derived, readers

d = dt.date


def test_common_stock(spark):
    cases = {("AAPL", "Apple"): True, ("A", ""): True, ("", "x"): False, ("ABCDEF", "x"): False, ("BRK.B", "x"): False, ("AB1", "x"): False, ("ABCDU", "x"): False, ("ABCDX", "x"): False, ("ABCU", "x"): True, ("AB", "Brightside"): False, ("AB", "United"): False, ("AB", "Gold Fund"): False, ("AB", None): True}
    df = spark.createDataFrame(list(cases), "s string, n string")
    got = {(r.s, r.n): r.x for r in df.select("s", "n", universe.common_stock(F.col("s"), F.col("n")).alias("x")).collect()}
    assert got == cases


def test_listing_age_and_names(spark):
    df = spark.createDataFrame([("2022-01-01",), ("2022-01-02",), ("",), (None,), ("bad",)], "ipo string")
    got = [r.x for r in df.select(universe.old_ipo(F.col("ipo"), F.lit("2024-01-01").cast("date")).alias("x")).collect()]
    assert got == [True, False, False, False, False]
    names = spark.createDataFrame([("Old Co",), ("Goldman",), (None,), ("Foo Delisted",)], "n string")
    assert [r.x for r in names.select(universe.not_delisted(F.col("n")).alias("x")).collect()] == [False, True, True, False]


def test_selected_universe(spark):
    stocks = spark.createDataFrame([("AAA", "Triple", "NYSE", 5.0), ("SPY", "SPDR ETF Trust", "NYSE", 5.0), ("BBB", "B", "NYSE", 0.0), ("CCC", "C", "NYSE", None), ("DDD", "D", "NYSE", 1.0), ("EEE", "E", "NYSE", 1.0)], schemas.SCREENER)
    profiles = spark.createDataFrame([("AAA", True, "Triple", "NYSE", "2000-01-01", "S", "I", None), ("SPY", None, "SPDR", "NYSE", None, None, None, 1.0), ("DDD", False, "D", "NYSE", "2000-01-01", "S", "I", 1.0), ("EEE", True, "E", "OTC", "2000-01-01", "S", "I", 1.0)], schemas.PROFILE)
    out = universe.select(stocks, profiles, "2024-01-01")
    assert {r.symbol: r.market_cap for r in out.collect()} == {"AAA": 0.0, "SPY": 1.0}
    whole = universe.inject(out, universe.guaranteed(spark))
    assert whole.where("symbol = 'SPY'").first().sector == "N/A" and whole.count() == 1 + len(universe.GUARANTEED)


def test_announcements(spark):
    periods = spark.createDataFrame([("a", d(2024, 3, 31)), ("a", d(2024, 6, 30)), ("b", d(2024, 1, 1)), ("c", d(2024, 1, 1))], "k string, period_end date")
    events = spark.createDataFrame(
        [("a", d(2024, 3, 31), 0, 1.0), ("a", d(2024, 4, 20), 5, 2.0), ("a", d(2024, 4, 20), 3, 3.0), ("b", d(2024, 4, 30), 1, 4.0), ("c", d(2024, 5, 1), 1, 5.0), ("z", d(2024, 1, 1), 1, 0.0)], "k string, announced date, idx int, eps double"
    )
    got = {(r.k, r.period_end): (r.announced, r.eps) for r in fundamentals.next_announcement(periods, events, "k").collect()}
    assert got["a", d(2024, 3, 31)] == (d(2024, 4, 20), 3.0)  # strictly after; lowest index of the day
    assert got["a", d(2024, 6, 30)] == (None, None)
    assert got["b", d(2024, 1, 1)] == (d(2024, 4, 30), 4.0)  # 120 days
    assert got["c", d(2024, 1, 1)] == (None, None)  # 121 days


def test_ratios(spark):
    df = spark.createDataFrame([(10.0, 50.0, 0.02), (10.0, 0.0, None), (None, 5.0, 0.0), (1.0, None, 0.0)], "netIncome double, stockholdersEquity double, roic_raw double")
    got = [(r.roe_quarterly, r.roe, r.roic_quarterly, r.roic) for r in fundamentals.with_ratios(df).collect()]
    assert got == [(20.0, 80.0, 2.0, 8.0), (None, None, None, None), (None, None, 0.0, 0.0), (None, None, 0.0, 0.0)]
    s = spark.createDataFrame([(3.0, -2.0), (3.0, 0.0), (None, 2.0), (3.0, None)], "a double, e double")
    assert [r.x for r in s.select(fundamentals.surprise_pct(F.col("a"), F.col("e")).alias("x")).collect()] == [250.0, None, None, None]


def test_five_way_join_needs_all(spark):
    t = lambda rows, name: spark.createDataFrame(rows, f"symbol string, date date, {name} double")
    a = fundamentals.last_per_key(spark.createDataFrame([("x", d(2024, 1, 1), 1.0, 0), ("x", d(2024, 1, 1), 2.0, 1)], "symbol string, date date, a double, i int"), ["symbol", "date"], ["i"]).drop("i")
    b = t([("x", d(2024, 1, 1), 5.0), ("y", d(2024, 1, 1), 6.0)], "b")
    assert [(r.symbol, r.a, r.b) for r in fundamentals.merged([a, b], ["symbol", "date"]).collect()] == [("x", 2.0, 5.0)]
    assert fundamentals.merged([a, b], ["symbol", "date"], "2025-01-01").count() == 0


def test_merges(spark):
    old = spark.createDataFrame([(1, "d1", 1.0, None), (1, "d2", None, 2.0)], "k int, dt string, p double, rs double")
    new = spark.createDataFrame([(1, "d2", 9.0, 9.0), (1, "d3", 3.0, None)], "k int, dt string, p double, rs double")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(merge.upsert(old, new, ["k", "dt"])) == [(1, "d1", 1.0, None), (1, "d2", 9.0, 9.0), (1, "d3", 3.0, None)]
    filled = merge.fill(old, new, ["k", "dt"], ["rs"])
    assert rows(filled) == [(1, "d1", 1.0, None, False), (1, "d2", None, 2.0, False), (1, "d3", 3.0, None, True)]
    again = merge.fill(filled.drop("changed"), new, ["k", "dt"], ["rs"])
    assert again.where("changed").count() == 0 and rows(again.drop("changed")) == rows(filled.drop("changed"))
    assert rows(merge.add_missing_dates(old, new)) == rows(old) + [(1, "d3", 3.0, None)]
    assert rows(merge.replace_dates(old, new)) == [(1, "d1", 1.0, None), (1, "d2", 9.0, 9.0), (1, "d3", 3.0, None)]
    maps = spark.sql("select map('a', 1, 'b', 2) as x, map('b', 3, 'c', 4) as y").select(merge.overlay("x", "y").alias("m"))
    assert maps.first().m == {"a": 1, "b": 3, "c": 4}


def test_freezing(spark):
    keys = spark.createDataFrame([("a/2023/x", 2023), ("a/2023/y", 2023), ("a/2024/x", 2024), ("a/2025/x", 2025), ("m.csv", None)], "key string, year long")
    there = spark.createDataFrame([("a/2023/x",), ("a/2024/x",), ("a/2025/x",)], "key string")
    plan = lambda **o: {r.key: r.reason for r in publish.freeze_years(keys, there, 2024, **o).collect()}
    assert plan() == {"a/2023/y": "missing", "a/2024/x": "current", "m.csv": "current"}
    assert plan(future_open=True)["a/2025/x"] == "current"
    assert plan(force=True)["a/2023/x"] == "forced"
    months = spark.createDataFrame([("p", 2024, 1), ("q", 2024, 2)], "key string, year long, month long")
    both = months.select("key")
    assert {r.key for r in publish.freeze_months(months, both, "2024-03-31").collect()} == {"p", "q"}  # 60 days
    assert {r.key for r in publish.freeze_months(months, both, "2024-04-01").collect()} == {"q"}


def test_documents_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", d(2023, 1, 2), 1.0, 2.0, 0.5, 1.5, 10, 50.0), ("a", d(2023, 1, 1), 1.0, 2.0, 0.5, 1.4, 10, None), ("a", d(2024, 1, 1), 1.0, 2.0, 0.5, 1.6, 10, 51.0), ("zz", d(2023, 1, 1), 1.0, 1.0, 1.0, 1.0, 1, 1.0)], "symbol string, dt date, open double, high double, low double, close double, volume long, rs_percentile double")
    dim = spark.createDataFrame([("a", "Aa", "S", "I")], "symbol string, name string, sector string, industry string")
    docs = publish.year_documents(rows, dim)
    assert [(r.year, [x.close for x in r.data]) for r in docs.orderBy("year").collect()] == [(2023, [1.4, 1.5]), (2024, [1.6])]
    out = docs.select("year", F.col("symbol").alias("ticker"), "name", "sector", "industry", F.transform("data", lambda x: F.struct(x["dt"].alias("date"), *[x[c].alias(c) for c in (*publish.BAR, "rs_percentile")])).alias("data"))
    path = str(tmp_path / "core")
    publish.write_documents(out, path, ["year"])
    publish.write_documents(out.where("year = 2024").withColumn("name", F.lit("new")), path, ["year"])  # replaces that year alone
    back = readers.core_docs(spark, path)
    assert {(r.year, r.name) for r in back.collect()} == {(2023, "Aa"), (2024, "new")}
    assert readers.core_docs(spark, path, [2023]).count() == 2
    assert readers.core_docs(spark, path, [1999]).count() == 0
    found = readers.keys(spark, path)
    assert found.where(F.col("key").startswith("year=2023/") & (F.col("size") > 0)).count() >= 1


def test_csv_universe(spark, tmp_path):
    f = tmp_path / "u.csv"
    f.write_text("﻿Symbol,Company Name,Sector,Industry,Price,Market_Cap,IPO_Date,Exchange\nNA,First,N/A,x,1,,,\nA,Old,S,I,1,,,\nA,New,S2,I,1,,,\n", encoding="utf-8")
    got = {r.symbol: (r.name, r.sector) for r in readers.universe(spark, str(f)).collect()}
    assert got == {"NA": ("First", "N/A"), "A": ("New", "S2")}
    j = tmp_path / "j.csv"
    j.write_text("Symbol,Company Name,Sector,Industry,Market,Size,Exchange\n 130A ,Eins,S,I,Prime,x,TSE\n130A,Zwei,S,I,Prime,x,TSE\n ,Drei,S,I,Prime,x,TSE\n")
    assert [(r.symbol, r.name) for r in readers.universe_jp(spark, str(j)).collect()] == [("130A", "Eins")]
    assert readers.universe_jp(spark, str(j), dedup=False).count() == 2


def test_government_bonds(spark, tmp_path):
    f = tmp_path / "jgb.csv"
    f.write_bytes("国債金利情報\r\n基準日,1年,10年\r\nS49.9.24,10.3,8.1\r\nH1.1.4,4.0,-\r\nR6.6.30,0.1,1.05\r\nbad,1,2\r\n\r\n".encode("cp932"))
    assert [(r.dt, r["yield"]) for r in readers.government_bonds(spark, str(f)).orderBy("dt").collect()] == [(d(1974, 9, 24), 8.1), (d(2024, 6, 30), 1.05)]


def test_landed_json(spark, tmp_path):
    (tmp_path / "n.json").write_text('{"lastUpdated": "x", "symbols": {"a": {"name": "A", "sector": "S", "industry": "I", "data": [{"date": "2024-01-01", "close": 1.0, "volume": 3}]}}}')
    r = readers.nested_panel(spark, str(tmp_path / "n.json")).first()
    assert (r.symbol, r.dt, r.close, r.open) == ("a", d(2024, 1, 1), 1.0, None)
    (tmp_path / "f.json").write_text('[{"ticker": "a", "floatShares": 5.0}, {"ticker": "b"}]')
    (tmp_path / "g.json").write_text("[]")
    assert [(x.ticker, x.floatShares) for x in readers.shares_float(spark, str(tmp_path / "[fg].json")).collect()] == [("a", 5.0)]
    (tmp_path / "m.json").write_text('{"data": {"VIX": {"2024-01-01": {"close": 1.5, "volume": 0}}}}')
    m = readers.market_series(spark, str(tmp_path / "m.json")).first()
    assert (m.ticker, m.dt, m.close, m.volume) == ("VIX", d(2024, 1, 1), 1.5, None)
    chunks = [tuple(x) for x in readers.date_chunks(spark.sql("select date'2024-01-01' as start, date'2024-04-01' as `end` union all select null, null")).collect()]
    assert chunks == [(d(2024, 1, 1), d(2024, 2, 25)), (d(2024, 2, 26), d(2024, 4, 1))]


def test_series(spark):
    rates = spark.createDataFrame([(d(2024, 1, 1), 1.0, None)], "dt date, year2 double, year10 double")
    assert [(r.ticker, r.open, r.close, r.volume) for r in market.yields_as_bars(rates, {"year2": "A", "year10": "B"}).collect()] == [("A", 1.0, 1.0, None)]
    s = spark.createDataFrame([("x", d(2024, 1, 1), 4.0), ("y", d(2024, 1, 1), 2.0), ("x", d(2024, 1, 2), 4.0), ("x", d(2025, 1, 1), 4.0), ("y", d(2025, 1, 1), 0.0)], "ticker string, dt date, close double")
    assert [(r.dt, r.value) for r in market.ratio(s, "x", "y").collect()] == [(d(2024, 1, 1), 2.0)]
    docs = {r.year: r for r in market.year_documents(s, ["close"]).collect()}
    assert docs[2024].tickers == ["x", "y"] and docs[2024].data["2024-01-02"]["x"].close == 4.0
    one = lambda *x: spark.createDataFrame([(list(x),)], "t array<string>")
    assert market.ordered_union(one("b", "a"), one("a", "c"), "t").first().t == ["b", "a", "c"]


def test_quality(spark):
    listed = spark.createDataFrame([("x",), ("none",)], "ticker string")
    s = spark.createDataFrame([("x", d(2024, 1, 1))], "ticker string, dt date")
    assert {r.ticker: r.rows for r in quality.series_coverage(s, listed).collect()} == {"x": 1, "none": 0}
    v = spark.createDataFrame([("1",), ("1.5",), ("true",), ("null",), ("[1]",), ('{"a":1}',), ('"s"',), (None,)], "v string")
    assert {r.type: r.n for r in quality.field_types(v, "v").collect()} == {"integer": 1, "double": 1, "boolean": 1, "null": 2, "array": 1, "object": 1, "string": 1}
    dates = spark.createDataFrame([("2024-01-01",), ("2024-1-1",), (None,)], "x string")
    assert quality.invalid_dates(dates, "x").count() == 2
    keys = spark.createDataFrame([("stocks/summary/a", 1), ("stocks/daily/b", 1)], schemas.KEYS)
    assert [(r.prefix, r.files) for r in quality.deprecated(keys).collect()] == [("stocks/summary/", 1)]
    assert publish.deletion_plan(keys, quality.DEPRECATED).count() == 1
    many = spark.range(25).select(F.format_string("stocks/summary/%02d", "id").alias("key"), F.lit(1).alias("size"))
    batches = publish.deletion_plan(many, quality.DEPRECATED, 10).groupBy("batch").agg(F.count("*").alias("n"), F.min("key").alias("k"))
    assert {(r.batch, r.n, r.k[-2:]) for r in batches.collect()} == {(0, 10, "00"), (1, 10, "10"), (2, 5, "20")}


def test_streamed_bars_equal_batch(spark, tmp_path):
    from meadowlark.streaming import bars

    t = lambda m, s=0: dt.datetime(2024, 1, 1, 10, m, s)
    rows = [(1, t(0), "a", 1.0), (2, t(3), "a", 4.0), (3, t(6), "a", 2.0), (4, t(7), "b", None), (5, t(9), "b", 7.0), (6, t(59), "z", 0.0)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    q = bars.append(bars.bars_5min(bars.events(spark, str(tmp_path / "in"), "event_id long, ts timestamp, event_type string, value double")), out, str(tmp_path / "c"))
    assert q.awaitTermination(120)
    want = sorted(map(tuple, derived.bars_5min(events).where("symbol <> 'z'").select("symbol", "ts", "open", "high", "low", "close", "n").collect()))
    assert sorted(map(tuple, spark.read.parquet(out).select("symbol", "ts", "open", "high", "low", "close", "n").collect())) == want
    assert bars.once(bars.events(spark, str(tmp_path / "in"), "event_id long, ts timestamp, event_type string, value double")).isStreaming


def test_guard():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    with pytest.raises(ValueError):
        from meadowlark.operators import rs

        rs.weights(None, "x")


def test_listings_and_fallbacks(spark, tmp_path):
    keys = spark.createDataFrame([("core/2023/A.json", 1), ("core/2024/A.json", 1), ("core/2024/B.json", 1), ("meta/x.csv", 1)], schemas.KEYS)
    assert {r.child for r in readers.children(keys, "core/").collect()} == {"2023", "2024"}
    assert {r.symbol: r.years for r in readers.years_by_symbol(keys).collect()} == {"A": [2023, 2024], "B": [2024]}
    path = str(tmp_path / "cache")
    made = readers.read_or_build(lambda: spark.read.parquet(path), lambda: keys)
    assert made.count() == 4
    with pytest.raises(AnalysisException):  # a misspelt column isn't a missing file
        readers.read_or_build(lambda: keys.select("kye"), lambda: keys)
    keys.limit(1).write.parquet(path)
    assert readers.read_or_build(lambda: spark.read.parquet(path), lambda: keys).count() == 1
    (tmp_path / "y.json").write_text('{"year": 2024, "tickers": ["V"], "data": {"2024-01-02": {"V": {"close": 2.5}}}}')
    y = readers.market_year(spark, str(tmp_path / "y.json")).first()
    assert (y.year, y.ticker, y.dt, y.close, y.open) == (2024, "V", d(2024, 1, 2), 2.5, None)
    bars = spark.createDataFrame([("a", 1, 0, "x"), ("a", 1, 1, "y"), ("b", 1, 0, "z")], "symbol string, ts int, n int, v string")
    assert {r.symbol: r.v for r in readers.unique_bars(bars, "n").collect()} == {"a": "x", "b": "z"}
    assert universe.known_only(["a", "b"], ["b"]) == ["b"] and universe.known_only(["a"], None) == ["a"]
    with pytest.raises(ValueError):
        universe.known_only(["a"], ["z"])


def test_segments(spark):
    rows = [("1", "プライム（内国株式）", "S", "I", 0), ("1", "グロース（内国株式）", "S", "I", 1), ("2", "ETF", "S", "I", 2), ("3", "プライム（内国株式）", "-", "I", 3)]
    out = universe.classified(spark.createDataFrame(rows, "symbol string, segment string, sector string, industry string, line int"))
    assert [(r.symbol, r.market) for r in out.collect()] == [("1", "Prime")]


def test_month_documents_and_metadata(spark):
    bars = spark.createDataFrame([("a", dt.datetime(2024, 3, 1, 3, 0), 1.0), ("a", dt.datetime(2024, 3, 1, 15, 0), 2.0)], "symbol string, ts timestamp, close double")
    dim = spark.createDataFrame([("a", "A")], "symbol string, name string")
    docs = {r.month: r for r in publish.month_documents(bars, dim).collect()}
    assert set(docs) == {"02", "03"} and docs["02"].data[0]["local"] == dt.datetime(2024, 2, 29, 22, 0)  # New York's wall clock
    scores = spark.createDataFrame([("a", d(2024, 1, 1)), ("b", d(2024, 1, 3))], "symbol string, dt date")
    assert tuple(publish.metadata(scores).first()) == (d(2024, 1, 1), d(2024, 1, 3), 2, 2, 1000)
