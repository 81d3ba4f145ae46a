"""Quarterly facts: join of statements, as-of announcements, ratios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOLERANCE = 120


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key; of repeats the last."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def merged(sources: list[DataFrame], keys: list[str], start: str | None = None, by: str = "date") -> DataFrame:
    """Inner join of all sources on their keys: what one lacks is dropped. All share one partitioning by key."""
    out = reduce(lambda a, b: a.join(b, keys), sources)
    return out.where(F.col(by) >= F.lit(start).cast("date")) if start else out


def next_announcement(periods: DataFrame, events: DataFrame, key: str, tolerance: int = TOLERANCE) -> DataFrame:
    """Each period with the first event strictly after its end and at most ``tolerance`` days later, or
    nulls. ``events``: key, announced, idx and any fields; of one day's events the lowest idx counts.

    Periods and events of a key lie in one stream by date: the next event is the first that follows, so
    there is no range join whose pairs grow with the square of a key's rows."""
    fields = [c for c in events.columns if c != key]
    both = periods.select("*", F.col("period_end").alias("_d"), F.lit(1).alias("_p"), F.lit(None).cast(events.select(F.struct(*fields).alias("e")).schema["e"].dataType).alias("_e")).unionByName(
        events.select(key, F.col("announced").alias("_d"), F.lit(0).alias("_p"), F.struct(*fields).alias("_e")), allowMissingColumns=True
    )
    ahead = Window.partitionBy(key).orderBy(F.datediff("_d", F.lit("1970-01-01").cast("date"))).rangeBetween(1, tolerance)
    first = F.min(F.when(F.col("_p") == 0, F.struct(F.col("_e.announced").alias("a"), F.col("_e.idx").alias("i"), F.col("_e").alias("e")))).over(ahead)
    return both.withColumn("_next", first).where("_p = 1").select(*periods.columns, *[F.col(f"_next.e.{f}").alias(f) for f in fields])


def next_announcement_sliced(periods: DataFrame, events: DataFrame, key: str, tolerance: int = TOLERANCE, days: int = 30) -> DataFrame:
    """``next_announcement`` for keys of any size: each key's stream is cut into slices of ``days`` days, and a slice
    gets one carry row, the first event of those after it. A task holds a key's slice; the carry rows are found from
    one row a slice. Events that lie further off than ``tolerance`` don't count, wherever they come from."""
    fields = [c for c in events.columns if c != key]
    slice_of = lambda d: F.floor(F.unix_date(d) / days)
    found = events.select(F.col(key).alias("_k"), slice_of(F.col("announced")).alias("_s"), F.struct(F.col("announced").alias("_a"), F.col("idx").alias("_i"), F.struct(*fields).alias("_e")).alias("_first"))
    asked = periods.select("*", slice_of(F.col("period_end")).alias("_s"), F.monotonically_increasing_id().alias("_row"))

    # the first event of the slices after each slice that has a period or an event
    heads = found.groupBy("_k", "_s").agg(F.min_by("_first", F.struct("_first._a", "_first._i")).alias("_first"))
    marks = heads.unionByName(asked.select(F.col(key).alias("_k"), "_s").distinct(), allowMissingColumns=True)
    later = Window.partitionBy("_k").orderBy("_s").rangeBetween(1, Window.unboundedFollowing)
    carry = marks.withColumn("_next", F.min(F.when(F.col("_first").isNotNull(), F.struct(F.col("_first._a").alias("a"), F.col("_first._i").alias("i"), F.col("_first._e").alias("e")))).over(later))
    carry = carry.where("_next is not null").select("_k", "_s", F.col("_next").alias("_ev")).distinct()

    plain = found.select("_k", "_s", F.struct(F.col("_first._a").alias("a"), F.col("_first._i").alias("i"), F.col("_first._e").alias("e")).alias("_ev"))
    stream = plain.unionByName(carry).withColumn("_d", F.unix_date("_ev.a"))
    both = stream.unionByName(asked.select(F.col(key).alias("_k"), "_s", F.unix_date("period_end").alias("_d"), F.struct(*periods.columns).alias("_p")), allowMissingColumns=True)
    ahead = Window.partitionBy("_k", "_s").orderBy("_d").rangeBetween(1, tolerance)
    out = both.withColumn("_next", F.min("_ev").over(ahead)).where("_p is not null")
    return out.select(*[F.col("_p")[c].alias(c) for c in periods.columns], *[F.col("_next.e")[f].alias(f) for f in fields])


def roe_quarterly(income: Column, equity: Column) -> Column:
    return income / F.nullif(equity, F.lit(0.0)) * 100


def surprise_pct(actual: Column, estimate: Column) -> Column:
    """Percent by which the actual value beat the estimate's size, not rounded; null without either or for 0."""
    return (actual - estimate) / F.abs(F.nullif(estimate, F.lit(0.0))) * 100


def with_ratios(facts: DataFrame) -> DataFrame:
    """Quarterly and annualised returns on equity and on invested capital."""
    roe, roic = roe_quarterly(F.col("netIncome"), F.col("stockholdersEquity")), F.col("roic_raw") * 100
    return facts.withColumns({"roe_quarterly": roe, "roe": roe * 4, "roic_quarterly": roic, "roic": roic * 4})


def known_at(facts: DataFrame, as_of: str, announced: str = "announced") -> DataFrame:
    """Facts that were public by a date."""
    return facts.where(F.col(announced) <= F.lit(as_of).cast("date"))


def trailing_sum(df: DataFrame, key: str, order: str, value: str, n: int, out: str) -> DataFrame:
    """Adds the sum of the last n rows; null unless all n are there."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, F.when(F.count(value).over(w) == n, F.sum(value).over(w)))
