"""Queries over orders and customers: universes, quarterly facts, announcements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meadowlark.operators import fundamentals, universe
from meadowlark.plans.registry import query
from meadowlark.sources import readers
from meadowlark.sources.derived import table

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
#: Parts of part names that stand for the excluded words of company names.
WORDS = ["WIDGET", "ANVIL"]
AS_OF = "1998-01-01"


def part_symbol() -> Column:
    return F.upper(F.regexp_replace("p_brand", "[^A-Za-z]", ""))


_EXCLUDED = " AND ".join(f"NOT contains(upper(coalesce(p_name, '')), '{w}')" for w in WORDS)
_SYMBOL = "upper(regexp_replace(p_brand, '[^A-Za-z]', '', 'g'))"


@query(
    "universe_filter",
    f"SELECT p_partkey, {_SYMBOL} AS symbol, p_name, p_size IN (1, 2) OR (length({_SYMBOL}) BETWEEN 1 AND 5 AND NOT regexp_matches({_SYMBOL}, '[UWRX]$') AND {_EXCLUDED}) AS kept FROM part WHERE p_retailprice > 0",
)
def universe_filter(spark, sf):
    rows = table(spark, sf, "part").where(universe.has_price(F.col("p_retailprice")))
    passed = F.col("p_size").isin(1, 2) | universe.common_stock(part_symbol(), F.col("p_name"), WORDS)
    return rows.select("p_partkey", part_symbol().alias("symbol"), "p_name", F.coalesce(passed, F.lit(False)).alias("kept"))


@query("ipo_filter", f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS listed FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '{AS_OF}' - 730")
def ipo_filter(spark, sf):
    rows = table(spark, sf, "orders").withColumn("listed", F.to_date("o_orderdate"))
    return rows.where(universe.old_ipo(F.col("listed"), F.lit(AS_OF).cast("date"))).select("o_orderkey", "listed")


@query(
    "universe_inject",
    "SELECT p_partkey AS symbol, p_name AS name, p_type AS sector FROM part WHERE p_partkey NOT IN (0, 1, 2, 3) UNION ALL SELECT * FROM (VALUES (1::BIGINT, 'one', 'N/A'), (2, 'two', 'N/A'), (3, 'three', 'N/A'), (0, 'zero', 'N/A')) v(symbol, name, sector)",
)
def universe_inject(spark, sf):
    rows = spark.createDataFrame([(1, "one", "N/A"), (2, "two", "N/A"), (3, "three", "N/A"), (0, "zero", "N/A")], "symbol long, name string, sector string")
    return universe.inject(table(spark, sf, "part").select(F.col("p_partkey").alias("symbol"), F.col("p_name").alias("name"), F.col("p_type").alias("sector")), rows)


@query("universe_value_counts", "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 10")
def universe_value_counts(spark, sf):
    return universe.value_counts(table(spark, sf, "part"), "p_type")


@query("universe_counts", "SELECT count(DISTINCT p_type) AS types, count(DISTINCT p_brand) AS brands, count(*) AS parts FROM part")
def universe_counts(spark, sf):
    return table(spark, sf, "part").agg(F.countDistinct("p_type").alias("types"), F.countDistinct("p_brand").alias("brands"), F.count("*").alias("parts"))


@query("symbol_list", "SELECT DISTINCT o_custkey AS symbol FROM orders WHERE o_custkey IS NOT NULL")
def symbol_list(spark, sf):
    return readers.symbols(table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol")))


_QUARTERS = """src AS (
  SELECT c_nationkey AS symbol, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS date, o_orderpriority AS p, round(sum(o_totalprice), 2) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
m AS (
  SELECT s1.symbol, s1.date, s1.v AS revenue, s2.v AS cost, s3.v AS equity, s4.v AS earned, s5.v AS invested
  FROM src s1 JOIN src s2 USING (symbol, date) JOIN src s3 USING (symbol, date) JOIN src s4 USING (symbol, date) JOIN src s5 USING (symbol, date)
  WHERE s1.p = '1-URGENT' AND s2.p = '2-HIGH' AND s3.p = '3-MEDIUM' AND s4.p = '4-NOT SPECIFIED' AND s5.p = '5-LOW' AND s1.date >= DATE '1995-01-01')"""


def quarterly(spark, sf) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(F.col("c_nationkey").alias("symbol"), F.trunc("o_orderdate", "quarter").alias("date"), "o_orderpriority", "o_totalprice")
    return rows.groupBy("symbol", "date", "o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("v"))


def facts(spark, sf) -> DataFrame:
    rows = quarterly(spark, sf)
    names = ("revenue", "cost", "equity", "earned", "invested")
    sources = [rows.where(F.col("o_orderpriority") == p).select("symbol", "date", F.col("v").alias(n)) for p, n in zip(PRIORITIES, names, strict=True)]
    return fundamentals.merged(sources, ["symbol", "date"], "1995-01-01")


@query("fundamentals_merge", f"WITH {_QUARTERS} SELECT * FROM m")
def fundamentals_merge(spark, sf):
    return facts(spark, sf)


@query("common_dates", f"WITH {_QUARTERS} SELECT DISTINCT date FROM src WHERE p = '1-URGENT' INTERSECT SELECT date FROM src WHERE p = '2-HIGH' INTERSECT SELECT date FROM src WHERE p = '5-LOW'")
def common_dates(spark, sf):
    rows = quarterly(spark, sf)
    dates = [rows.where(F.col("o_orderpriority") == p).select("date") for p in (PRIORITIES[0], PRIORITIES[1], PRIORITIES[4])]
    return dates[0].intersect(dates[1]).intersect(dates[2])


@query(
    "roe_roic",
    f"WITH {_QUARTERS}, q AS (SELECT symbol, date, (revenue - cost) / nullif(equity, 0) * 100 AS a, earned / nullif(invested, 0) * 100 AS b FROM m) SELECT symbol, date, round(a, 6) AS roe_quarterly, round(a * 4, 6) AS roe, round(b, 6) AS roic_quarterly, round(b * 4, 6) AS roic FROM q",
)
def roe_roic(spark, sf):
    named = facts(spark, sf).select("symbol", "date", (F.col("revenue") - F.col("cost")).alias("netIncome"), F.col("equity").alias("stockholdersEquity"), F.try_divide("earned", "invested").alias("roic_raw"))
    out = fundamentals.with_ratios(named)
    return out.select("symbol", "date", *[F.round(c, 6).alias(c) for c in ("roe_quarterly", "roe", "roic_quarterly", "roic")])


_ASOF = """p AS (SELECT DISTINCT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS period_end FROM orders WHERE o_orderstatus = 'F'),
e AS (SELECT o_custkey AS symbol, CAST(o_orderdate AS DATE) AS announced, o_orderkey AS idx, o_totalprice AS actual FROM orders WHERE o_orderstatus <> 'F'),
j AS (SELECT p.symbol, period_end, announced, idx, actual FROM p LEFT JOIN e ON e.symbol = p.symbol AND announced > period_end AND announced <= period_end + 120
      QUALIFY row_number() OVER (PARTITION BY p.symbol, period_end ORDER BY announced, idx) = 1)"""


def matched(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("d"), "o_orderstatus", "o_orderkey", "o_totalprice")
    periods = o.where("o_orderstatus = 'F'").select("symbol", F.col("d").alias("period_end")).distinct()
    events = o.where("o_orderstatus <> 'F'").select("symbol", F.col("d").alias("announced"), F.col("o_orderkey").alias("idx"), F.col("o_totalprice").alias("actual"))
    return fundamentals.next_announcement(periods, events, "symbol")


@query("asof_announcement", f"WITH {_ASOF} SELECT symbol, period_end, announced, idx, actual FROM j")
def asof_announcement(spark, sf):
    return matched(spark, sf)


@query("pit_filter", f"WITH {_ASOF} SELECT symbol, period_end, announced FROM j WHERE announced <= DATE '1996-01-01'")
def pit_filter(spark, sf):
    return fundamentals.known_at(matched(spark, sf), "1996-01-01").select("symbol", "period_end", "announced")


@query("surprise", f"WITH {_ASOF} SELECT j.symbol, period_end, round((actual - c_acctbal) / abs(nullif(c_acctbal, 0)) * 100, 6) AS surprise_pct FROM j JOIN customer ON c_custkey = j.symbol")
def surprise(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("symbol"), "c_acctbal")
    out = matched(spark, sf).join(c, "symbol")
    return out.select("symbol", "period_end", F.round(fundamentals.surprise_pct(F.col("actual"), F.col("c_acctbal")), 6).alias("surprise_pct"))


@query(
    "ttm_revenue",
    "WITH q AS (SELECT c_nationkey AS symbol, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS date, round(sum(o_totalprice), 2) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) "
    "SELECT symbol, date, round(CASE WHEN count(revenue) OVER w = 4 THEN sum(revenue) OVER w END, 2) AS ttm FROM q WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)",
)
def ttm_revenue(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    q = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("symbol"), F.trunc("o_orderdate", "quarter").alias("date")).agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    return fundamentals.trailing_sum(q, "symbol", "date", "revenue", 4, "ttm").select("symbol", "date", F.round("ttm", 2).alias("ttm"))
