"""Prices adjusted for what happened after them: splits and dividends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PRICES = ("open", "high", "low", "close")


def factors(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """(symbol, ex_date, factor): by how much an action changes the prices before it. ``actions`` have symbol, ex_date,
    ``ratio`` (new shares for one old) and ``dividend``, either may be null. A dividend takes its share of the last close
    before its date; without such a close, or of one that isn't above it, it changes nothing."""
    a = actions.groupBy("symbol", F.col("ex_date").alias("dt")).agg(F.product(F.when(F.col("ratio") > 0, F.col("ratio"))).alias("ratio"), F.sum("dividend").alias("dividend"))
    both = bars.select("symbol", "dt", "close", F.lit(0).alias("kind")).unionByName(a.withColumn("kind", F.lit(-1)), allowMissingColumns=True)
    before = F.last("close", ignorenulls=True).over(Window.partitionBy("symbol").orderBy("dt", "kind").rowsBetween(Window.unboundedPreceding, -1))
    share = F.when((before > 0) & (F.col("dividend") < before), 1 - F.col("dividend") / before)
    out = both.withColumn("factor", F.coalesce(1 / F.col("ratio"), F.lit(1.0)) * F.coalesce(share, F.lit(1.0)))
    return out.where("kind = -1").select("symbol", F.col("dt").alias("ex_date"), "factor")


def adjusted(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """The bars with prices as of the last date: each price times the factors of all later actions, volumes divided
    by what splits made of a share; and ``factor``. One pass over bars and actions from the last date back; an
    action changes only dates before its own."""
    told = factors(bars, actions)
    splits = actions.where("ratio > 0").groupBy("symbol", F.col("ex_date").alias("dt")).agg(F.product("ratio").alias("_ratio"))
    events = told.select("symbol", F.col("ex_date").alias("dt"), "factor").join(splits, ["symbol", "dt"], "left")
    both = bars.withColumn("_bar", F.lit(True)).unionByName(events.withColumnRenamed("factor", "_factor"), allowMissingColumns=True)
    later = Window.partitionBy("symbol").orderBy(F.unix_date("dt").desc()).rangeBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.exp(F.coalesce(F.sum(F.ln(c)).over(later), F.lit(0.0)))
    out = both.withColumns({"factor": total("_factor"), "_split": total("_ratio")}).where("_bar")
    prices = {c: F.col(c) * F.col("factor") for c in PRICES if c in bars.columns}
    volume = {"volume": F.col("volume") * F.col("_split")} if "volume" in bars.columns else {}
    return out.withColumns(prices | volume).select(*bars.columns, "factor")
