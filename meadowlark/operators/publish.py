"""Documents, what may be written where, and writing it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAR = ("open", "high", "low", "close", "volume")


def core_rows(bars: DataFrame, scores: DataFrame) -> DataFrame:
    """Bars with their score, null where there is none."""
    return bars.join(scores.select("symbol", "dt", "rs_percentile"), ["symbol", "dt"], "left")


def documents(rows: DataFrame, dim: DataFrame, keys: dict[str, Column], fields: list[str], order: str = "dt") -> DataFrame:
    """One document per symbol and key (a year, a month): its metadata and its rows by date. Only symbols
    of ``dim`` have one; a document is as long as its period."""
    known = rows.join(dim, "symbol").withColumns(keys)
    ordered = F.array_sort(F.collect_list(F.struct(order, *fields)))
    return known.groupBy(*keys, "symbol", *[c for c in dim.columns if c != "symbol"]).agg(ordered.alias("data"))


def year_documents(rows: DataFrame, dim: DataFrame) -> DataFrame:
    return documents(rows, dim, {"year": F.year("dt").cast("long")}, [*BAR, "rs_percentile"])


def month_documents(bars: DataFrame, dim: DataFrame, interval: str = "5m", zone: str = "America/New_York") -> DataFrame:
    """Intraday documents by month of the zone's wall clock."""
    local = bars.withColumn("local", F.from_utc_timestamp("ts", zone))
    keys = {"year": F.year("local").cast("long"), "month": F.lpad(F.month("local").cast("string"), 2, "0")}
    out = documents(local, dim, keys, [c for c in BAR if c in bars.columns], "local")
    return out.withColumns({"interval": F.lit(interval), "timezone": F.lit(zone)})


def panel_documents(bars: DataFrame, dim: DataFrame, updated: str) -> DataFrame:
    """The whole panel as nested documents, an entry a symbol: (lastUpdated, symbols: symbol -> its metadata and
    rows). One document of all symbols would be a single row as large as the panel; read these as one map."""
    rows = bars.select(F.col("symbol").cast("string").alias("symbol"), F.struct(F.col("dt").alias("date"), *BAR[:4], F.col("volume").cast("long").alias("volume")).alias("r"))
    per = rows.groupBy("symbol").agg(F.array_sort(F.collect_list("r")).alias("data"))
    named = per.join(dim.withColumn("symbol", F.col("symbol").cast("string")), "symbol")
    return named.select(F.lit(updated).alias("lastUpdated"), F.create_map("symbol", F.struct("name", "sector", "industry", "data")).alias("symbols"))


def write_documents(docs: DataFrame, path: str, by: list[str]) -> None:
    """JSON partitioned by ``by``; only partitions with rows are replaced. Rows of a partition come together
    first, so that each has few files; adaptive execution splits a partition that most rows belong to."""
    docs.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def write_snapshot(df: DataFrame, path: str, kind: str = "parquet") -> None:
    df.write.mode("overwrite").format(kind).option("header", True).save(path)


def freeze_years(candidates: DataFrame, existing: DataFrame, year: int, future_open: bool = False, force: bool = False) -> DataFrame:
    """(key, reason) of what to write: the current year always; other years only where the key doesn't
    exist yet. ``future_open`` writes later years always too; ``force`` writes all. ``candidates`` have
    key and year; a null year counts as current."""
    y = F.coalesce("year", F.lit(year))
    always = (y >= year) if future_open else (y == year)
    return _plan(candidates, existing, always, "current", force)


def freeze_months(candidates: DataFrame, existing: DataFrame, as_of: str, days: int = 60, force: bool = False) -> DataFrame:
    """The same by months: one is closed once its last day lies more than ``days`` back."""
    end = F.last_day(F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)))
    open_ = F.coalesce(F.datediff(F.lit(as_of).cast("date"), end) <= days, F.lit(True))
    return _plan(candidates, existing, open_, "open", force)


def _plan(candidates: DataFrame, existing: DataFrame, always: Column, word: str, force: bool) -> DataFrame:
    marked = candidates.join(existing.select("key", F.lit(True).alias("_there")).distinct(), "key", "left")
    reason = F.when(always, word).when(F.col("_there").isNull(), "missing")
    reason = F.coalesce(reason, F.lit("forced")) if force else reason
    return marked.withColumn("reason", reason).where("reason is not null").drop("_there")


def missing_years(bars: DataFrame, existing: DataFrame) -> DataFrame:
    """(symbol, year) with bars but without a key."""
    return bars.select("symbol", F.year("dt").cast("long").alias("year")).distinct().join(existing, ["symbol", "year"], "left_anti")


def metadata(scores: DataFrame, retention_days: int = 1000) -> DataFrame:
    """One row: first and last date, symbols, dates."""
    days, symbols = scores.select("dt").distinct(), scores.select("symbol").distinct()
    spans = days.agg(F.min("dt").alias("start_date"), F.max("dt").alias("end_date"), F.count("dt").alias("total_days"))
    one = spans.crossJoin(symbols.agg(F.count("symbol").alias("total_symbols")))  # a row each
    return one.select("start_date", "end_date", "total_symbols", "total_days", F.lit(retention_days).cast("long").alias("retention_days"))


def deletion_plan(keys: DataFrame, prefixes: list[str], batch: int = 1000) -> DataFrame:
    """(key, batch): keys under deprecated prefixes in batches of ``batch`` (the last may have fewer), in the order of the
    keys. Deleting stays with whoever asked."""
    from meadowlark.operators.rank import numbered

    under = keys.where(starts_with_any(F.col("key"), prefixes)).select("key")
    return numbered(under, [F.asc("key")], "_n").select("key", F.floor((F.col("_n") - 1) / batch).alias("batch"))


def starts_with_any(key: Column, prefixes: list[str]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | key.startswith(p)
    return out
