"""Queries over a published panel that is repaired: late bars, dirty ranges, what changed."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meadowlark.operators import backfill, rs
from meadowlark.plans import sql
from meadowlark.plans.prices import rounded
from meadowlark.plans.registry import query
from meadowlark.sources import derived
from meadowlark.sources.scratch import fresh_path, staged

GAP = ("1997-01-06", "1997-05-22")

_ORDER = "ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity"
DAILY = f"""bars AS (
  SELECT n_name AS symbol, CAST(l_shipdate AS DATE) AS dt, first(l_extendedprice / l_quantity {_ORDER}) AS open, max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
         last(l_extendedprice / l_quantity {_ORDER}) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)"""
#: Scores over all dates that any bar has, of the bars as they are and of those before the gap is filled.
_CHAIN = sql.RS.split("dim AS", 1)[1].split("),\n", 1)[1].replace("WHERE symbol IN (SELECT symbol FROM elig) AND close IS NOT NULL", "WHERE close IS NOT NULL")
_HELD = re.sub(r"\b(bars|elig|cal|grid|raw|rs)\b", r"\1_h", _CHAIN)
_MISSING = f"dt BETWEEN DATE '{GAP[0]}' AND DATE '{GAP[1]}' AND NOT starts_with(symbol, 'I')"
REPAIRED = f"""{DAILY}, {_CHAIN}, bars_h AS (SELECT * FROM bars WHERE NOT ({_MISSING})), {_HELD},
done AS (
  SELECT b.symbol, b.dt, b.close, b.volume, rs_h.rs_percentile AS old, coalesce(rs_h.rs_percentile, rs.rs_percentile) AS new, {_MISSING} AS added
  FROM bars b LEFT JOIN rs USING (symbol, dt) LEFT JOIN rs_h ON rs_h.symbol = b.symbol AND rs_h.dt = b.dt)"""


def published(spark, sf) -> tuple[str, DataFrame, DataFrame, DataFrame]:
    """A panel with a gap, where it lies, all bars, and the bars that are offered for the gap: the missing ones, and
    others for dates that are there, which don't count."""
    bars = staged(derived.bars_daily(spark, sf), "daily")
    gap = F.col("dt").between(*[F.lit(d).cast("date") for d in GAP])
    kept = bars.where(~(gap & ~F.col("symbol").startswith("I")))
    base, dim = fresh_path(spark, "panel"), derived.nations(spark, sf)
    backfill.write_panel(kept.join(rs.individual(kept, calendar="all").drop("rank"), ["symbol", "dt"], "left"), dim, base)
    offered = bars.where(gap).withColumn("close", F.when(F.col("symbol").startswith("I"), F.col("close") * 2).otherwise(F.col("close")))
    return base, dim, bars, offered


@query("gap_backfill", f"WITH {REPAIRED} SELECT year(dt) AS year, symbol, dt, close, volume, round(new, 6) AS rs_percentile FROM done")
def gap_backfill(spark, sf):
    """The whole panel as it lies after the repair: the years that weren't touched, too."""
    base, dim, _, offered = published(spark, sf)
    backfill.apply(spark, base, offered, dim)
    rows = backfill.read_years(spark, base, list(range(1990, 2010)))
    return rounded(rows.select(F.year("dt").cast("long").alias("year"), "symbol", "dt", "close", "volume", "rs_percentile"), "rs_percentile")


@query("gap_rescored", f"WITH {DAILY}, {_CHAIN} SELECT symbol, dt, round(rs_percentile, 6) AS rs_percentile FROM rs")
def gap_rescored(spark, sf):
    """Without keeping old scores the repaired panel has those that all bars give, though only some years were read."""
    base, dim, _, offered = published(spark, sf)
    backfill.apply(spark, base, offered, dim, keep=False)
    rows = backfill.read_years(spark, base, list(range(1990, 2010))).where("rs_percentile is not null")
    return rounded(rows.select("symbol", "dt", "rs_percentile"), "rs_percentile")


@query(
    "gap_fill_report",
    f"WITH {REPAIRED} SELECT symbol, year(dt) AS year, count(*) FILTER (NOT added) AS records_before, count(old) FILTER (NOT added) AS filled_before, count(*) AS records, count(new) AS filled FROM done GROUP BY 1, 2 HAVING count(*) FILTER (added OR old IS DISTINCT FROM new) > 0",
)
def gap_fill_report(spark, sf):
    """By symbol and year that changed: rows and scores before and after."""
    base, _, _, offered = published(spark, sf)
    after = staged(backfill.backfill(spark, base, offered), "after")
    year = F.year("dt").cast("long").alias("year")
    counts = after.groupBy("symbol", year).agg(F.count("*").alias("records"), F.count("rs_percentile").alias("filled"), F.count_if("changed").alias("n")).where("n > 0").drop("n")
    before = backfill.read_years(spark, base, list(range(1990, 2010))).groupBy("symbol", year).agg(F.count("*").alias("records_before"), F.count("rs_percentile").alias("filled_before"))
    zero = {"records_before": F.coalesce("records_before", F.lit(0)), "filled_before": F.coalesce("filled_before", F.lit(0))}
    return counts.join(before, ["symbol", "year"], "left").withColumns(zero)
