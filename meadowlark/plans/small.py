"""Queries for operators that are one expression: predicates, windows, set operations, functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from meadowlark.functions import indicators, scalars
from meadowlark.operators import market, merge, rs, universe
from meadowlark.plans import sql
from meadowlark.plans.prices import bars_of
from meadowlark.plans.registry import query
from meadowlark.sources import derived, readers


@query("diff_shift", f"WITH {sql.BARS} SELECT symbol, dt, lag(close) OVER w AS before, close - lag(close) OVER w AS diff FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY dt)")
def diff_shift(spark, sf):
    return bars_of(spark, sf).select("symbol", "dt", F.lag("close").over(indicators.rows()).alias("before"), indicators.diff("close").alias("diff"))


@query(
    "rolling_sum_mean",
    f"WITH {sql.BARS} SELECT symbol, dt, CASE WHEN count(volume) OVER a = 20 THEN sum(volume) OVER a END AS sum20, round(CASE WHEN count(volume) OVER b = 14 THEN avg(volume) OVER b END, 6) AS mean14 FROM bars WINDOW a AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), b AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)",
)
def rolling_sum_mean(spark, sf):
    v = F.col("volume")
    return bars_of(spark, sf).select("symbol", "dt", indicators.full(F.sum, v, 20).alias("sum20"), F.round(indicators.full(F.avg, v, 14), 6).alias("mean14"))


@query("bar_weights", f"WITH {sql.BARS}, {sql.WEIGHTS['last_row']}, {sql.WEIGHTS['ffill'].replace('weights AS', 'f AS')}, {sql.WEIGHTS['last_valid'].replace('weights AS', 'v AS')} SELECT symbol, weights.weight AS last_row, f.weight AS ffill, v.weight AS last_valid FROM weights JOIN f USING (symbol) JOIN v USING (symbol)")
def bar_weights(spark, sf):
    bars = bars_of(spark, sf)
    kinds = [rs.weights(bars, k).withColumnRenamed("weight", k) for k in ("last_row", "ffill", "last_valid")]
    return kinds[0].join(kinds[1], "symbol").join(kinds[2], "symbol")


@query("year_union", "SELECT DISTINCT year(o_orderdate) AS year FROM orders UNION SELECT DISTINCT year(l_shipdate) FROM lineitem")
def year_union(spark, sf):
    years = lambda t, c: derived.table(spark, sf, t).select(F.year(c).cast("long").alias("year"))
    return years("orders", "o_orderdate").union(years("lineitem", "l_shipdate")).distinct()


@query("key_difference", "SELECT c_custkey AS symbol FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def key_difference(spark, sf):
    return derived.table(spark, sf, "customer").select(F.col("c_custkey").alias("symbol")).subtract(derived.table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_custkey"))


@query("first_wins", "SELECT p_brand AS symbol, first(p_partkey ORDER BY p_partkey) AS line, first(p_name ORDER BY p_partkey) AS name FROM part GROUP BY 1")
def first_wins(spark, sf):
    rows = derived.table(spark, sf, "part").select(F.col("p_brand").alias("symbol"), F.col("p_partkey").alias("line"), F.col("p_name").alias("name"))
    return readers.first_rows(rows, ["symbol"], [F.asc("line")])


@query("map_overlay", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS a, 'old' AS b, CASE WHEN c_custkey % 2 = 0 THEN 'new' END AS c FROM customer")
def map_overlay(spark, sf):
    new = F.when(F.col("c_custkey") % 2 == 0, F.create_map(F.lit("a"), F.lit("new"), F.lit("c"), F.lit("new"))).otherwise(F.create_map().cast("map<string,string>"))
    rows = derived.table(spark, sf, "customer").select("c_custkey", F.create_map(F.lit("a"), F.lit("old"), F.lit("b"), F.lit("old")).alias("x"), new.alias("y"))
    return rows.select("c_custkey", merge.overlay("x", "y").alias("m")).select("c_custkey", *[F.col("m")[k].alias(k) for k in "abc"])


@query("ticker_union", "SELECT array_to_string(list(t ORDER BY k, t), ',') AS tickers FROM (SELECT r_name AS t, 0 AS k FROM region WHERE r_regionkey < 2 UNION ALL SELECT r_name, 1 FROM region WHERE r_regionkey >= 2)")
def ticker_union(spark, sf):
    r = derived.table(spark, sf, "region")
    names = lambda c: r.where(c).agg(F.array_sort(F.collect_list("r_name")).alias("t"))
    return market.ordered_union(names("r_regionkey < 2"), names("r_regionkey >= 1"), "t").select(F.array_join("t", ",").alias("tickers"))


@query("delisting_filter", "SELECT p_partkey FROM part WHERE NOT regexp_matches(upper(p_name), '\\b(ANVIL|RING)\\b')")
def delisting_filter(spark, sf):
    return derived.table(spark, sf, "part").where(universe.not_delisted(F.col("p_name"), ["ANVIL", "RING"])).select("p_partkey")


@query("local_codes", "SELECT s_suppkey, s_suppkey || '.T' AS code, CAST(s_suppkey AS VARCHAR) AS back FROM supplier")
def local_codes(spark, sf):
    code = scalars.with_suffix(F.col("s_suppkey").cast("string"))
    return derived.table(spark, sf, "supplier").select("s_suppkey", code.alias("code"), scalars.without_suffix(code).alias("back"))


@query("valid_groups", "SELECT industry, count(*) AS n FROM (SELECT CASE n_nationkey % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN '-' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE n_name END AS industry FROM nation) WHERE industry NOT IN ('', '-', 'N/A') GROUP BY 1")
def valid_groups(spark, sf):
    k = F.col("n_nationkey") % 5
    name = F.when(k == 0, "N/A").when(k == 1, "-").when(k == 2, "").when(k == 3, F.lit(None)).otherwise(F.col("n_name"))
    return rs.member_count(derived.table(spark, sf, "nation").select(name.alias("industry")), "industry").withColumnRenamed("stock_count", "n")


@query(
    "date_chunks",
    "WITH r AS (SELECT o_custkey AS symbol, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders GROUP BY 1), c AS (SELECT symbol, a, b, unnest(range(0, b - a + 1, 56)) AS n FROM r) SELECT symbol, a + n::INTEGER AS chunk_start, least(a + n::INTEGER + 55, b) AS chunk_end FROM c",
)
def date_chunks(spark, sf):
    """Each customer's span of orders, cut as a source that serves 56 days at a time is asked for it."""
    day = F.to_date("o_orderdate")
    spans = derived.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("symbol")).agg(F.min(day).alias("start"), F.max(day).alias("end"))
    return readers.date_chunks(spans)
