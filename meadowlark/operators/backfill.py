"""Backfilling a published panel: late bars go in, and only what they can change is ranked again.

A panel lies under a folder as ``core`` (year documents), ``history`` (closes by year and symbol) and ``calendar``
(the dates that have a close). A score at a calendar position looks back ``LOOKBACK`` positions at most, so a bar
that comes in late dirties its own date and as many positions after it, and no other date; unless it gives its
symbol enough history to take part, which dirties all dates of the symbol's years. Only the years of dirty dates
are written again, and only those and the ones that they look back to are read.

Existing bars stay as they are. Existing scores stay, too, with ``keep``, as in a repair of what was left
out; without it they are what a computation of the whole panel would give."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meadowlark.operators import merge, panel, publish, rs
from meadowlark.operators.rank import percentile
from meadowlark.sources import readers
from meadowlark.sources.scratch import staged

LOOKBACK = max(rs.LEGS)
BARS = ["open", "high", "low", "close", "volume"]
CALENDAR, HISTORY = "year int, dt date", "year int, symbol string, closes long"


def history_of(bars: DataFrame) -> DataFrame:
    """(year, symbol, closes): how many dates of each year a symbol has a close on."""
    return bars.groupBy(F.year("dt").alias("year"), F.col("symbol").cast("string").alias("symbol")).agg(F.count("close").alias("closes"))


def calendar_of(bars: DataFrame) -> DataFrame:
    return bars.where("close is not null").select(F.year("dt").alias("year"), "dt").distinct()


def write_panel(rows: DataFrame, dim: DataFrame, base: str) -> None:
    """Writes the years that ``rows`` (bars with ``rs_percentile``) has, in place of those years' documents,
    history and calendar; other years stay."""
    docs = publish.year_documents(rows.withColumn("symbol", F.col("symbol").cast("string")), dim)
    publish.write_documents(docs.withColumnsRenamed({"symbol": "ticker"}).withColumn("data", F.transform("data", lambda r: r.withField("date", r["dt"]).dropFields("dt"))), f"{base}/core", ["year"])
    for part, name in ((history_of(rows), "history"), (calendar_of(rows), "calendar")):
        part.repartition("year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(f"{base}/{name}")


def read_years(spark: SparkSession, base: str, years: list[int]) -> DataFrame:
    """(symbol, dt, bar, rs_percentile) of some years; the others aren't listed."""
    rows = readers.core_docs(spark, f"{base}/core", years) if years else readers.core_docs(spark, f"{base}/core").where("false")
    return rows.select("symbol", "dt", *BARS, "rs_percentile")


@dataclass(frozen=True)
class Plan:
    """What a backfill reads, ranks and writes."""

    calendar: tuple[dt.date, ...]  # after it
    dirty: frozenset[dt.date]
    read: tuple[int, ...]
    write: tuple[int, ...]


def new_bars(spark: SparkSession, base: str, gap: DataFrame) -> DataFrame:
    """The rows of ``gap`` that the panel has no close for."""
    years = [r.year for r in gap.select(F.year("dt").alias("year")).distinct().collect()]
    there = read_years(spark, base, years).where("close is not null")
    return gap.where("close is not null").join(there.select("symbol", "dt"), ["symbol", "dt"], "left_anti")


def plan(spark: SparkSession, base: str, fresh: DataFrame, years: tuple[int, ...] = ()) -> Plan:
    """The plan for ``fresh`` bars and for ``years`` to be ranked again anyway. A calendar and the years a symbol
    has are what comes to the driver: a row a date, a row a year."""
    calendar = spark.read.schema(CALENDAR).parquet(f"{base}/calendar")
    there = {r.dt for r in calendar.select("dt").distinct().collect()}
    late = {r.dt for r in fresh.select("dt").distinct().collect()}
    dates = sorted(there | late)
    history = spark.read.schema(HISTORY).parquet(f"{base}/history")
    before = history.groupBy("symbol").agg(F.sum("closes").alias("old"))
    more = fresh.groupBy("symbol").agg(F.count("*").alias("more"))
    joined = more.join(before, "symbol", "left").where((F.coalesce("old", F.lit(0)) < rs.MIN_DAYS) & (F.coalesce("old", F.lit(0)) + F.col("more") >= rs.MIN_DAYS))
    widened = {r.year for r in history.join(joined, "symbol", "left_semi").select("year").distinct().collect()}
    again = widened | set(years) | ({r.dt.year for r in joined.join(fresh, "symbol").select("dt").distinct().collect()} if widened else set())
    position = {d: i for i, d in enumerate(dates)}
    dirty: set[int] = {i for i, d in enumerate(dates) if d.year in again}
    for d in late:
        dirty |= set(range(position[d], min(position[d] + LOOKBACK + 1, len(dates))))
    needed = {dates[j].year for i in dirty for j in (i, *(i - n for n in rs.LEGS)) if j >= 0}
    chosen = frozenset(dates[i] for i in dirty)
    return Plan(tuple(dates), chosen, tuple(sorted(needed)), tuple(sorted({d.year for d in chosen})))


def scores(spark: SparkSession, base: str, bars: DataFrame, fresh: DataFrame, what: Plan) -> DataFrame:
    """(symbol, dt, rs_percentile) of the dirty dates, from the bars of the years that are read."""
    history = spark.read.schema(HISTORY).parquet(f"{base}/history").unionByName(history_of(fresh))
    enough = history.groupBy("symbol").agg(F.sum("closes").alias("n")).where(F.col("n") >= rs.MIN_DAYS).select("symbol")
    dates = spark.createDataFrame([(d, i, d in what.dirty) for i, d in enumerate(what.calendar)], "dt date, pos int, dirty boolean")
    rows = panel.positioned(bars.select("symbol", "dt", "close").join(enough, "symbol", "left_semi"), dates)
    raw = sum(panel.pct_change("close", n) * w for n, w in rs.LEGS.items())
    scored = rows.select("symbol", "dt", "dirty", raw.alias("rs_raw")).where("dirty and rs_raw is not null")
    return percentile(scored, "rs_raw", ["dt"], "rs_percentile").select("symbol", "dt", "rs_percentile")


def backfill(spark: SparkSession, base: str, gap: DataFrame, *, keep: bool = True, years: tuple[int, ...] = ()) -> DataFrame:
    """The rows of the years that change, after the backfill: symbol, dt, bar, ``rs_percentile`` and ``changed``
    (new, or with another score). ``gap`` has symbol, dt and the bar; of a symbol's date one row."""
    gap = staged(gap.select(F.col("symbol").cast("string").alias("symbol"), "dt", *[F.col(c).cast("long" if c == "volume" else "double").alias(c) for c in BARS]), "gap")
    fresh = staged(new_bars(spark, base, gap), "fresh")
    what = plan(spark, base, fresh, years)
    old = read_years(spark, base, list(what.read))
    offered = gap.where(F.year("dt").isin(list(what.read)) if what.read else F.lit(False))
    merged = merge.fill(old.drop("rs_percentile"), offered, ["symbol", "dt"], ["close"]).drop("changed")
    told = scores(spark, base, merged, fresh, what).withColumnRenamed("rs_percentile", "_new")

    written = F.year("dt").isin(list(what.write)) if what.write else F.lit(False)
    bars = merge.fill(old.where(written), offered.where(written).withColumn("rs_percentile", F.lit(None).cast("double")), ["symbol", "dt"])
    both = bars.withColumnRenamed("changed", "_added").join(told, ["symbol", "dt"], "left")
    dirty = spark.createDataFrame([(d,) for d in sorted(what.dirty)], "dt date").withColumn("_dirty", F.lit(True))
    both = both.join(F.broadcast(dirty), "dt", "left")
    score = F.coalesce("rs_percentile", "_new") if keep else F.when(F.col("_dirty"), F.col("_new")).otherwise(F.col("rs_percentile"))
    changed = F.col("_added") | ~F.col("rs_percentile").eqNullSafe(score)
    return both.select("symbol", "dt", *BARS, score.alias("rs_percentile"), changed.alias("changed"))


def apply(spark: SparkSession, base: str, gap: DataFrame, dim: DataFrame, **options) -> DataFrame:
    """Backfills and writes the years in which a row changed; returns the rows as ``backfill`` does. What is written
    is staged first, for the folder it replaces is the one it was read from."""
    rows = staged(backfill(spark, base, gap, **options), "backfill")
    years = [r.year for r in rows.where("changed").select(F.year("dt").alias("year")).distinct().collect()]
    if years:
        write_panel(rows.where(F.year("dt").isin(years)).drop("changed"), dim, base)
    return rows
