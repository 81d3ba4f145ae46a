"""Queries over versioned tables and over landed requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from meadowlark.operators import panel
from meadowlark.plans import sql
from meadowlark.plans.prices import bars_of
from meadowlark.plans.registry import query
from meadowlark.sources import landed, snapshots
from meadowlark.sources.scratch import fresh_path

_NEW = "SELECT symbol, dt, close * 1.01e0 AS close, volume, year(dt) AS year FROM bars WHERE year(dt) BETWEEN 1997 AND 1998 AND symbol % 2 = 0"
_OLD = "SELECT symbol, dt, close, volume, year(dt) AS year FROM bars WHERE year(dt) < 2000 AND (year(dt) <> 1998 OR symbol % 3 = 0)"


def _rows(spark, sf):
    return bars_of(spark, sf).select("symbol", "dt", "close", "volume", F.year("dt").alias("year"))


def _base(spark, sf) -> str:
    """A table of the years before 2000, then other prices for two of them."""
    rows, base = _rows(spark, sf), fresh_path(spark, "table")
    snapshots.replace(spark, base, rows.where("year < 2000 and (year <> 1998 or symbol % 3 = 0)"), "year")
    snapshots.upsert(spark, base, rows.where("year between 1997 and 1998 and symbol % 2 = 0").withColumn("close", F.col("close") * 1.01), ["symbol", "dt"], "year")
    return base


@query("snapshot_upsert", f"WITH {sql.BARS}, o AS ({_OLD}), n AS ({_NEW}) SELECT symbol, dt, close, volume, year FROM n UNION ALL SELECT symbol, dt, close, volume, year FROM o ANTI JOIN n USING (symbol, dt)")
def snapshot_upsert(spark, sf):
    return snapshots.read(spark, _base(spark, sf)).withColumn("year", F.col("year").cast("long"))


@query("snapshot_as_before", f"WITH {sql.BARS} SELECT year, count(*) AS n, sum(volume) AS volume FROM ({_OLD}) GROUP BY 1")
def snapshot_as_before(spark, sf):
    """The version before the upsert can still be read."""
    return snapshots.read(spark, _base(spark, sf), 1).groupBy(F.col("year").cast("long").alias("year")).agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query("snapshot_missing_years", f"WITH {sql.BARS} SELECT year(dt) AS year, count(*) AS n FROM bars WHERE year(dt) >= 2000 OR year(dt) <> 1998 OR symbol % 3 = 0 GROUP BY 1")
def snapshot_missing_years(spark, sf):
    """Years that aren't there are added; those that are stay, with what they lack."""
    base, rows = fresh_path(spark, "table"), _rows(spark, sf)
    snapshots.replace(spark, base, rows.where("year < 2000 and (year <> 1998 or symbol % 3 = 0)"), "year")
    snapshots.add_missing(spark, base, rows.withColumn("close", F.lit(0.0)), "year")
    return snapshots.read(spark, base).groupBy(F.col("year").cast("long").alias("year")).agg(F.count("*").alias("n"))


def _landed(spark, sf) -> str:
    path = fresh_path(spark, "landed")
    bars = bars_of(spark, sf).where("symbol % 9 <> 4").withColumns({"symbol": F.col("symbol").cast("string"), "volume": F.col("volume").cast("long")})
    landed.land(bars, path)
    return path


@query("landed_range", f"WITH {sql.BARS} SELECT symbol::VARCHAR AS symbol, dt, open, high, low, close, volume::BIGINT AS volume FROM bars WHERE symbol % 9 <> 4 AND dt BETWEEN DATE '1996-03-01' AND DATE '1997-02-20'")
def landed_range(spark, sf):
    """A year of the landed requests: the others aren't opened."""
    return landed.read(spark, _landed(spark, sf)).where("dt >= date'1996-03-01' and dt <= date'1997-02-20'")


@query("landed_symbols", f"WITH {sql.BARS} SELECT symbol::VARCHAR AS symbol, count(*) AS n, min(dt) AS first, max(dt) AS last FROM bars WHERE symbol IN (2, 3, 5, 7) AND dt < DATE '1999-01-01' GROUP BY 1")
def landed_symbols(spark, sf):
    rows = landed.read(spark, _landed(spark, sf)).where(F.col("symbol").isin("2", "3", "5", "7", "none")).where("dt < date'1999-01-01'")
    return rows.groupBy("symbol").agg(F.count("*").alias("n"), F.min("dt").alias("first"), F.max("dt").alias("last"))


@query("landed_failures", "SELECT s_suppkey::VARCHAR AS symbol FROM supplier WHERE s_suppkey % 9 = 4 OR s_suppkey NOT IN (SELECT l_suppkey FROM lineitem)")
def landed_failures(spark, sf):
    """Symbols of the universe that no request brought anything for."""
    from meadowlark.sources.derived import table

    listed = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"))
    return panel.missing_symbols(listed, landed.read(spark, _landed(spark, sf), "symbol string"))
