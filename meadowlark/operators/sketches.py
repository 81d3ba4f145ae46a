"""Counts and quantiles of published scores from sketches: a row a year, kept beside the year's documents.

Distinct symbols and dates are HyperLogLog sketches, scores a KLL sketch; both merge, so totals over any years need
neither the rows nor a second pass, and a year that is written again replaces its row only. With 2^12 registers a distinct
count is within 5 % (three standard errors), with k = 400 a quantile's rank within 1 %, whatever the number of rows; least,
largest and number of rows are exact. ``publish.metadata`` and ``quality.distribution`` are the exact forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REGISTERS, K = 12, 400
#: What the estimates are within: a share of a count, a share of ranks.
COUNT_ERROR, RANK_ERROR = 0.05, 0.01


def yearly(scores: DataFrame, value: str = "rs_percentile") -> DataFrame:
    """A row of sketches a year; partial sketches are made before the shuffle."""
    symbol, day = F.col("symbol").cast("string"), F.col("dt").cast("string")
    return scores.groupBy(F.year("dt").alias("year")).agg(
        F.hll_sketch_agg(symbol, REGISTERS).alias("symbols"), F.hll_sketch_agg(day, REGISTERS).alias("dates"), F.kll_sketch_agg_double(value, K).alias("scores"),
        F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.min("dt").alias("start_date"), F.max("dt").alias("end_date"),
    )


def merged(sketches: DataFrame, by: list[str | Column] = ()) -> DataFrame:
    """Sketches of several years as one row (or one a group)."""
    return sketches.groupBy(*by).agg(
        F.hll_union_agg("symbols").alias("symbols"), F.hll_union_agg("dates").alias("dates"), F.kll_merge_agg_double("scores").alias("scores"),
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"),
    )


def told(sketches: DataFrame) -> DataFrame:
    """The estimates: total_symbols, total_days, median; and what is exact."""
    rest = [c for c in sketches.columns if c not in ("symbols", "dates", "scores")]
    return sketches.select(*rest, F.hll_sketch_estimate("symbols").alias("total_symbols"), F.hll_sketch_estimate("dates").alias("total_days"), F.kll_sketch_get_quantile_double("scores", F.lit(0.5)).alias("median"))


def rank_of(sketch: str, value: Column) -> Column:
    """The share of scores at or under a value."""
    return F.kll_sketch_get_rank_double(sketch, value)
