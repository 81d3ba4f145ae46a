"""Panels derived from the star schema: what the price, event and key tables of the queries are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, dt, open, high, low, close, volume): a supplier's week of unit prices. The order of
    trades within a week is total, so first and last don't depend on partitioning."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.trunc("l_shipdate", "week").alias("dt"), price.alias("price"), order.alias("o"), "l_quantity")
    return rows.groupBy("symbol", "dt").agg(
        F.min_by("price", "o").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "o").alias("close"), F.sum("l_quantity").alias("volume")
    )


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, name, industry, sector): suppliers, their nations and regions."""
    s, n, r = (table(spark, sf_dir, x) for x in ("supplier", "nation", "region"))
    return (
        s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(F.col("s_suppkey").alias("symbol"), F.col("s_name").alias("name"), F.col("n_name").alias("industry"), F.col("r_name").alias("sector"))
    )


def bars_5min(events: DataFrame) -> DataFrame:
    """(symbol, ts, open, high, low, close, n): events of a type by five minutes."""
    bucket = F.window("ts", "5 minutes").start
    order = F.struct("ts", "event_id", "value")
    rows = events.where("value is not null").select(F.col("event_type").alias("symbol"), bucket.alias("bar"), "value", order.alias("o"))
    bars = rows.groupBy("symbol", "bar").agg(F.min_by("value", "o").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "o").alias("close"), F.count("*").alias("n"))
    return bars.withColumnRenamed("bar", "ts")


def sector_series(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """(ticker, dt, close, volume): each sector's volume-weighted price by week, as macro series."""
    rows = bars.join(dim.select("symbol", "sector"), "symbol")
    return rows.groupBy(F.col("sector").alias("ticker"), "dt").agg((F.sum(F.col("close") * F.col("volume")) / F.sum("volume")).alias("close"), F.sum("volume").alias("volume"))


def core_keys(bars: DataFrame) -> DataFrame:
    """(key, size, symbol, year): where a symbol's year document would lie."""
    per = bars.groupBy(F.year("dt").cast("long").alias("year"), "symbol").agg((F.count("*") * 100).alias("size"))
    return per.select(F.concat(F.lit("stocks/daily/core/"), "year", F.lit("/"), "symbol", F.lit(".json")).alias("key"), "size", "symbol", "year")


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, dt, open, high, low, close, volume): a nation's day of unit prices, by its suppliers."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    names = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", F.col("n_name").alias("symbol"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("dt"), price.alias("price"), order.alias("o"), "l_quantity")
    rows = rows.join(names, rows.l_suppkey == names.s_suppkey)
    return rows.groupBy("symbol", "dt").agg(F.min_by("price", "o").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "o").alias("close"), F.sum("l_quantity").cast("long").alias("volume"))


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, name, sector, industry) of the daily panel."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_name").alias("symbol"), F.col("n_name").alias("name"), F.col("r_name").alias("sector"), F.lit("N/A").alias("industry"))
