"""Relative strength: of single symbols, and of groups by weighted means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meadowlark.operators import panel
from meadowlark.operators.rank import percentile

#: Lookbacks in calendar positions and their weights (fixed values).
LEGS = {63: 0.4, 126: 0.2, 189: 0.2, 252: 0.2}
MIN_DAYS = 252
NO_GROUP = ("", "N/A", "-")


def raw(bars: DataFrame, min_days: int = MIN_DAYS, calendar: str = "eligible") -> DataFrame:
    """(symbol, dt, rs_raw). ``calendar``: dates of symbols with enough history, or of all."""
    kept = panel.min_history(bars.select("symbol", "dt", "close"), min_days)
    rows = panel.positioned(kept, panel.calendar(bars if calendar == "all" else kept))
    score = sum(panel.pct_change("close", n) * w for n, w in LEGS.items())
    return rows.select("symbol", "dt", score.alias("rs_raw"))


def individual(bars: DataFrame, **options) -> DataFrame:
    """(symbol, dt, rs_percentile, rank) where there is a score."""
    scored = percentile(raw(bars, **options).where("rs_raw is not null"), "rs_raw", ["dt"], "rs_percentile", "rank")
    return scored.select("symbol", "dt", "rs_percentile", "rank")


def decorated(scores: DataFrame, dim: DataFrame) -> DataFrame:
    """Scores with name, sector and industry; symbols without metadata get defaults."""
    out = scores.join(dim.select("symbol", "name", "sector", "industry"), "symbol", "left")
    return out.withColumns({"name": F.coalesce("name", F.col("symbol").cast("string")), "sector": F.coalesce("sector", F.lit("N/A")), "industry": F.coalesce("industry", F.lit("N/A"))})


def weights(bars: DataFrame, kind: str = "last_row") -> DataFrame:
    """(symbol, weight), a close times a volume: of the last row (null: 1; ``last_row``), of the last
    known close and the last known volume (not above 0: 1; ``ffill``), or of the last row that has
    both (else 1; ``last_valid``)."""
    value = F.col("close") * F.col("volume")
    if kind == "last_row":
        return bars.groupBy("symbol").agg(F.coalesce(F.max_by(F.struct(value.alias("v")), "dt")["v"], F.lit(1.0)).alias("weight"))
    if kind == "ffill":
        filled = panel.forward_filled_latest(bars, ["close", "volume"])
        return filled.select("symbol", F.when(value > 0, value).otherwise(1.0).alias("weight"))
    if kind == "last_valid":
        return bars.groupBy("symbol").agg(F.coalesce(F.max_by(value, F.when(value.isNotNull(), F.col("dt"))), F.lit(1.0)).alias("weight"))
    raise ValueError(f"unknown weight {kind!r}")


def valid_group(group: Column) -> Column:
    return group.isNotNull() & ~group.isin(*NO_GROUP)


def group_raw(scores: DataFrame, members: DataFrame, weight: DataFrame, group: str) -> DataFrame:
    """(group, dt, group_raw): the weighted mean of its members' percentiles; null if no weight is left."""
    tied = members.where(valid_group(F.col(group))).select("symbol", group).join(weight, "symbol")
    rows = scores.join(tied, "symbol")
    there = F.when(F.col("rs_percentile").isNotNull(), F.col("weight"))
    return rows.groupBy(group, "dt").agg((F.sum(F.col("rs_percentile") * F.col("weight")) / F.nullif(F.sum(there), F.lit(0.0))).alias("group_raw"))


def member_count(members: DataFrame, group: str) -> DataFrame:
    """(group, stock_count) over the whole universe, scored or not."""
    return members.where(valid_group(F.col(group))).groupBy(group).agg(F.count("*").alias("stock_count"))


def first_sector(members: DataFrame, order: str = "symbol") -> DataFrame:
    """(industry, sector): of an industry's first member."""
    return members.where(valid_group(F.col("industry"))).groupBy("industry").agg(F.min_by("sector", order).alias("sector"))


def group(scores: DataFrame, members: DataFrame, weight: DataFrame, by: str, digits: int | None = None) -> DataFrame:
    """(group, dt, rs_percentile, rank, stock_count): groups ranked against each other. ``digits``
    rounds the means before ranking, so that the order of a sum can't decide a tie."""
    means = group_raw(scores, members, weight, by)
    means = means.withColumn("group_raw", F.round("group_raw", digits)) if digits is not None else means
    scored = percentile(means.where("group_raw is not null"), "group_raw", ["dt"], "rs_percentile", "rank")
    return scored.select(by, "dt", "rs_percentile", "rank").join(member_count(members, by), by)


def day_summary(scores: DataFrame, members: DataFrame, sectors: DataFrame, industries: DataFrame) -> DataFrame:
    """Each symbol's score by date beside its sector's and its industry's."""
    out = scores.select("symbol", "dt", "rs_percentile").join(members.select("symbol", "sector", "industry"), "symbol")
    out = out.join(sectors.select("sector", "dt", F.col("rs_percentile").alias("sector_rs")), ["sector", "dt"], "left")
    return out.join(industries.select("industry", "dt", F.col("rs_percentile").alias("industry_rs")), ["industry", "dt"], "left")
