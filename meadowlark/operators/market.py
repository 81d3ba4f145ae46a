"""Macro series: yields as bars, transposition, overlays, ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def yields_as_bars(rates: DataFrame, tenors: dict[str, str]) -> DataFrame:
    """One row per date and ticker from a column per tenor (column -> ticker); open, high, low and close
    are the yield, volume is null, missing yields give no row."""
    parts = ", ".join(f"'{ticker}', `{column}`" for column, ticker in tenors.items())
    long = rates.select("dt", F.expr(f"stack({len(tenors)}, {parts}) as (ticker, close)")).where("close is not null")
    return long.select("dt", "ticker", *[F.col("close").alias(c) for c in ("open", "high", "low")], "close", F.lit(None).cast("long").alias("volume"))


def by_date(series: DataFrame, fields: list[str]) -> DataFrame:
    """(year, dt, bars): each date's bars as a map by ticker. A date holds one entry a series."""
    entry = F.struct("ticker", F.struct(*fields).alias("bar"))
    return series.groupBy(F.year("dt").cast("long").alias("year"), "dt").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("bars"))


def year_documents(series: DataFrame, fields: list[str]) -> DataFrame:
    """(year, tickers, data): a document per year, date -> ticker -> bar."""
    days = by_date(series, fields)
    tickers = series.groupBy(F.year("dt").cast("long").alias("year")).agg(F.array_sort(F.collect_set("ticker")).alias("tickers"))
    data = days.groupBy("year").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("dt").cast("string").alias("d"), "bars")), _by_day)).alias("data"))
    return tickers.join(data, "year")


def _by_day(a, b):
    return F.when(a["d"] < b["d"], -1).when(a["d"] > b["d"], 1).otherwise(0)


def ratio(series: DataFrame, above: str, below: str, difference: bool = False) -> DataFrame:
    """(dt, value): one ticker's close over (or less) another's, where both are there."""
    wide = series.where(F.col("ticker").isin(above, below)).groupBy("dt").pivot("ticker", [above, below]).agg(F.first("close"))
    a, b = F.col(f"`{above}`"), F.col(f"`{below}`")
    return wide.select("dt", (a - b if difference else a / F.nullif(b, F.lit(0.0))).alias("value")).where("value is not null")


def ordered_union(old: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """One array: the old values in their order, then new ones that aren't there."""
    return old.crossJoin(F.broadcast(new.withColumnRenamed(column, "_new"))).select(F.array_union(column, "_new").alias(column))
