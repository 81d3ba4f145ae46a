"""Queries whose one key, date or symbol has all rows; sketches; adjusted prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from meadowlark.functions import indicators
from meadowlark.operators import adjust, fundamentals, quality, rank, sketches
from meadowlark.plans import sql
from meadowlark.plans.prices import bars_of, rounded, scores_of
from meadowlark.plans.registry import query
from meadowlark.plans.series import _FIVE, settled, settled_sql
from meadowlark.sources import derived
from meadowlark.sources.derived import table
from meadowlark.sources.scratch import staged


@query(
    "hot_date_rank",
    "SELECT l_orderkey, l_linenumber, l_partkey, round((rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0e0) / count(*) OVER () * 98 + 1, 6) AS percentile, rank() OVER (ORDER BY l_quantity DESC) AS rank FROM lineitem",
)
def hot_date_rank(spark, sf):
    """All line items as if of one date, ranked by a value with many ties."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return rounded(rank.percentile_spread(rows, "l_quantity", [], "percentile", "rank").drop("l_quantity"), "percentile")


@query("numbered_orders", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders")
def numbered_orders(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rank.numbered(rows, [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", F.col("n").cast("long").alias("n"))


@query(
    "asof_hot_key",
    """WITH p AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS period_end FROM orders WHERE o_orderstatus = 'F' AND day(o_orderdate) % 3 = 0),
    e AS (SELECT CAST(o_orderdate AS DATE) AS announced, o_orderkey AS idx, o_totalprice AS actual FROM orders WHERE o_orderstatus <> 'F' AND month(o_orderdate) % 4 = 1 QUALIFY row_number() OVER (PARTITION BY announced ORDER BY idx) = 1)
    SELECT id, period_end, CASE WHEN announced <= period_end + 60 THEN announced END AS announced, CASE WHEN announced <= period_end + 60 THEN idx END AS idx, CASE WHEN announced <= period_end + 60 THEN actual END AS actual FROM p ASOF LEFT JOIN e ON p.period_end < e.announced""",
)
def asof_hot_key(spark, sf):
    """All orders under one key."""
    o = table(spark, sf, "orders").select(F.lit("all").alias("k"), F.to_date("o_orderdate").alias("d"), "o_orderstatus", "o_orderkey", "o_totalprice")
    periods = o.where("o_orderstatus = 'F' and day(d) % 3 = 0").select("k", F.col("o_orderkey").alias("id"), F.col("d").alias("period_end"))
    events = o.where("o_orderstatus <> 'F' and month(d) % 4 = 1").select("k", F.col("d").alias("announced"), F.col("o_orderkey").alias("idx"), F.col("o_totalprice").alias("actual"))
    return fundamentals.next_announcement_sliced(periods, events, "k", 60, 14).drop("k")


@query("asof_sliced", "WITH p AS (SELECT DISTINCT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS period_end FROM orders WHERE o_orderstatus = 'F'), e AS (SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS announced, o_orderkey AS idx FROM orders WHERE o_orderstatus <> 'F') SELECT p.symbol, period_end, announced, idx FROM p LEFT JOIN e ON e.symbol = p.symbol AND announced > period_end AND announced <= period_end + 120 QUALIFY row_number() OVER (PARTITION BY p.symbol, period_end ORDER BY announced, idx) = 1")
def asof_sliced(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("d"), "o_orderstatus", "o_orderkey")
    periods = o.where("o_orderstatus = 'F'").select("symbol", F.col("d").alias("period_end")).distinct()
    events = o.where("o_orderstatus <> 'F'").select("symbol", F.col("d").alias("announced"), F.col("o_orderkey").alias("idx"))
    return fundamentals.next_announcement_sliced(periods, events, "symbol")


@query(
    "ema_intraday",
    f"WITH {_FIVE}, n AS (SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS i FROM five), q AS (SELECT 20.0e0 / 22 AS q) "
    "SELECT b.symbol, b.ts, round(sum(CASE WHEN a.i = 0 THEN a.close ELSE a.close * (1 - q) END * power(q, b.i - a.i)), 6) AS ema FROM n b JOIN n a ON a.symbol = b.symbol AND a.i BETWEEN b.i - 450 AND b.i, q GROUP BY 1, 2",
)
def ema_intraday(spark, sf):
    """Five-minute bars by type of event: few symbols, long ones. The SQL adds up weights from the row itself back to the
    450th before it, where they are under 10^-18."""
    bars = derived.bars_5min(table(spark, sf, "events"))
    return rounded(indicators.ema_scan(bars, F.to_date("ts"), order="ts").select("symbol", "ts", "ema"), "ema")


_EMA = sql.BARS + ", n AS (SELECT symbol, dt, close, row_number() OVER (PARTITION BY symbol ORDER BY dt) - 1 AS i FROM bars WHERE close IS NOT NULL), s AS (SELECT *, sum(CASE WHEN i = 0 THEN close ELSE close * (2.0e0 / 22) * power(20.0e0 / 22, -i) END) OVER (PARTITION BY symbol ORDER BY i) AS t FROM n)"


@query("ema_chunked", f"WITH {_EMA} SELECT symbol, dt, round(t * power(20.0e0 / 22, i), 6) AS ema FROM s")
def ema_chunked(spark, sf):
    return rounded(indicators.ema_scan(bars_of(spark, sf), F.year("dt"), rows_at_once=20).select("symbol", "dt", "ema"), "ema")


_ACTIONS = """a AS (
  SELECT s_suppkey AS symbol, CAST(date_trunc('week', o_orderdate) AS DATE) AS ex_date, CASE WHEN o_orderkey % 2 = 0 THEN 1 + o_orderkey % 3 END AS ratio, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 1000 END AS dividend
  FROM orders JOIN supplier ON s_suppkey = o_custkey WHERE o_orderkey % 5 = 0),
g AS (SELECT symbol, ex_date, product(ratio) AS ratio, sum(dividend) AS dividend FROM a GROUP BY 1, 2)"""


@query(
    "adjusted_prices",
    f"""WITH {sql.BARS}, {_ACTIONS},
    f AS (SELECT g.symbol, ex_date, coalesce(1 / ratio, 1) * coalesce(CASE WHEN c.close > 0 AND dividend < c.close THEN 1 - dividend / c.close END, 1) AS factor, ratio FROM g ASOF LEFT JOIN bars c ON c.symbol = g.symbol AND c.dt < g.ex_date)
    SELECT b.symbol, b.dt, {settled_sql('b.close * coalesce(product(factor), 1)')} AS close, {settled_sql('b.volume * coalesce(product(ratio), 1)')} AS volume FROM bars b LEFT JOIN f ON f.symbol = b.symbol AND f.ex_date > b.dt GROUP BY b.symbol, b.dt, b.close, b.volume""",
)
def adjusted_prices(spark, sf):
    """Splits and dividends derived from orders, by supplier and week."""
    o, s = table(spark, sf, "orders").where("o_orderkey % 5 = 0"), table(spark, sf, "supplier")
    ratio = F.when(F.col("o_orderkey") % 2 == 0, (1 + F.col("o_orderkey") % 3).cast("double"))
    dividend = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") / 1000)
    actions = o.join(s, o.o_custkey == s.s_suppkey).select(F.col("s_suppkey").alias("symbol"), F.trunc("o_orderdate", "week").alias("ex_date"), ratio.alias("ratio"), dividend.alias("dividend"))
    return settled(settled(adjust.adjusted(bars_of(spark, sf), actions).select("symbol", "dt", "close", "volume"), "close"), "volume")


_NAMED = "coalesce(CAST(year AS VARCHAR), 'all') AS years"


@query(
    "sketched_metadata",
    f"WITH {sql.RS}, y AS (SELECT year(dt) AS year, * FROM rs) SELECT {_NAMED}, count(*) AS n, min(dt) AS start_date, max(dt) AS end_date, round(min(rs_percentile), 6) AS low, round(max(rs_percentile), 6) AS high, count(DISTINCT symbol) AS total_symbols, count(DISTINCT dt) AS total_days, TRUE AS symbols_close, TRUE AS days_close, TRUE AS median_close FROM y GROUP BY GROUPING SETS ((year), ())",
)
def sketched_metadata(spark, sf):
    """By year, and of all years from the years' sketches alone, beside the exact counts: are the estimates within their
    stated errors? The share of scores at or under the estimated median is worked out exactly."""
    scores = staged(scores_of(spark, sf).select("symbol", "dt", "rs_percentile"), "scores")
    kept = staged(sketches.yearly(scores), "sketches")
    everything = sketches.told(sketches.merged(kept)).withColumn("years", F.lit("all"))
    told = sketches.told(kept).withColumn("years", F.col("year").cast("string")).drop("year").unionByName(everything)

    both = F.explode(F.array(F.year("dt").cast("string"), F.lit("all"))).alias("years")
    rows = scores.select("symbol", "dt", "rs_percentile", both)
    exact = rows.groupBy("years").agg(F.countDistinct("symbol").alias("exact_symbols"), F.countDistinct("dt").alias("exact_days"))
    under = rows.join(F.broadcast(told.select("years", "median")), "years").groupBy("years").agg(F.avg((F.col("rs_percentile") < F.col("median")).cast("int")).alias("less"), F.avg((F.col("rs_percentile") <= F.col("median")).cast("int")).alias("upto"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= sketches.COUNT_ERROR * F.col(b)
    out = told.join(exact, "years").join(under, "years")
    median = (F.col("less") <= 0.5 + sketches.RANK_ERROR) & (F.col("upto") >= 0.5 - sketches.RANK_ERROR)
    return rounded(
        out.select("years", "n", "start_date", "end_date", "low", "high", F.col("exact_symbols").alias("total_symbols"), F.col("exact_days").alias("total_days"), near("total_symbols", "exact_symbols").alias("symbols_close"), near("total_days", "exact_days").alias("days_close"), median.alias("median_close")), "low", "high"
    )





@query(
    "document_field_types",
    "SELECT * FROM (SELECT 'id' AS field, 'integer' AS type, count(*) AS n FROM events UNION ALL SELECT 'text', 'string', count(*) FROM events UNION ALL SELECT 'flag', 'boolean', count(*) FROM events "
    "UNION ALL SELECT 'value', CASE WHEN value IS NULL THEN 'null' WHEN value = floor(value) THEN 'integer' ELSE 'double' END, count(*) FROM events GROUP BY 2 UNION ALL SELECT 'sub', CASE WHEN event_id % 3 = 0 THEN 'object' ELSE 'null' END, count(*) FROM events GROUP BY 2 "
    "UNION ALL SELECT 'sub.t', 'string', count(*) FROM events WHERE event_id % 3 = 0 UNION ALL SELECT 'sub.u', CASE WHEN event_id % 2 = 0 AND user_id IS NOT NULL THEN 'integer' ELSE 'null' END, count(*) FROM events WHERE event_id % 3 = 0 GROUP BY 2) WHERE n > 0",
)
def document_field_types(spark, sf):
    """Types of all fields of documents made of the events, nested ones too; a number in quotes is a string."""
    i = F.col("event_id")
    sub = F.when(i % 3 == 0, F.struct(F.col("event_type").alias("t"), F.when(i % 2 == 0, F.col("user_id")).alias("u")))
    doc = F.to_json(F.struct(i.alias("id"), i.cast("string").alias("text"), "value", sub.alias("sub"), (i % 2 == 0).alias("flag")), {"ignoreNullFields": "false"})
    return quality.document_types(table(spark, sf, "events").select(doc.alias("doc")), "doc")


@query("quoted_number_types", "SELECT CASE event_id % 4 WHEN 0 THEN 'string' WHEN 1 THEN 'integer' WHEN 2 THEN 'invalid' ELSE 'null' END AS type, count(*) AS n FROM events GROUP BY 1")
def quoted_number_types(spark, sf):
    i = F.col("event_id")
    text = F.when(i % 4 == 0, F.concat(F.lit('"'), i.cast("string"), F.lit('"'))).when(i % 4 == 1, i.cast("string")).when(i % 4 == 2, F.lit("{not json"))
    return quality.field_types(table(spark, sf, "events").select(text.alias("v")), "v")
