"""Panels of symbols by dates: calendars, lags by calendar position, minimum history.

A lag by n calendar positions is a range frame from n to n before over the date's ordinal, so gaps
stay gaps without filling symbols x dates: a date that a symbol lacks has no row to give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def min_history(bars: DataFrame, least: int, value: str = "close") -> DataFrame:
    """Rows of the symbols with at least ``least`` rows and non-null values. One exchange by symbol,
    which later windows by symbol share."""
    whole = Window.partitionBy("symbol")
    counted = bars.withColumn("_n", F.count(value).over(whole))
    return counted.where(F.col("_n") >= least).drop("_n")


def calendar(bars: DataFrame) -> DataFrame:
    """(dt, pos): the distinct dates with a value, numbered from 1. As long as the calendar, whatever
    the number of symbols, so one window over all of it is fine."""
    return bars.where("close is not null").select("dt").distinct().withColumn("pos", F.row_number().over(Window.orderBy("dt")))


def positioned(bars: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Adds ``pos``, the calendar position. The calendar is a row a day: a century's are 36,525."""
    return bars.join(F.broadcast(dates if dates is not None else calendar(bars)), "dt")


def lag_by_calendar(value: str, n: int) -> Column:
    frame = Window.partitionBy("symbol").orderBy("pos").rangeBetween(-n, -n)
    return F.max(value).over(frame)


def pct_change(value: str, n: int) -> Column:
    """Percent change to n calendar positions before; null where either is missing or the earlier is 0."""
    return (F.col(value) / F.nullif(lag_by_calendar(value, n), F.lit(0.0)) - 1) * 100


def dense(bars: DataFrame) -> DataFrame:
    """Every symbol on every date of the union calendar, null where it has no bar: for outputs that
    need the grid. The calendar side is small, so it is sent to the symbols."""
    grid = bars.select("symbol").distinct().crossJoin(F.broadcast(bars.select("dt").distinct()))
    return grid.join(bars, ["symbol", "dt"], "left")


def tail_dates(df: DataFrame, n: int, dates: DataFrame) -> DataFrame:
    """Rows on the last n dates of a calendar (dates without values count)."""
    last = dates.select("dt").distinct().orderBy(F.desc("dt")).limit(n)
    return df.join(F.broadcast(last), "dt", "left_semi")


def latest(bars: DataFrame) -> DataFrame:
    """Each symbol's last row."""
    return bars.groupBy("symbol").agg(F.max_by(F.struct(*[c for c in bars.columns if c != "symbol"]), "dt").alias("r")).select("symbol", "r.*")


def forward_filled_latest(bars: DataFrame, fields: list[str]) -> DataFrame:
    """Each symbol's last non-null value of each field, on its own."""
    some = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col("dt"))).alias(f) for f in fields]
    return bars.groupBy("symbol").agg(*some)


def drop_empty(bars: DataFrame) -> DataFrame:
    """Without rows that have none of open, high, low, close and volume."""
    return bars.dropna(how="all", subset=[c for c in ("open", "high", "low", "close", "volume") if c in bars.columns])


def missing_symbols(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """Symbols of the universe that have no bar at all. Bars give each symbol once a task before they are dealt out."""
    return universe.select("symbol").join(bars.select("symbol").distinct(), "symbol", "left_anti")
