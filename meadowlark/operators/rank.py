"""Cross-sectional ranks.

``percentile`` ranks each group in one task; ``percentile_spread`` and ``numbered`` deal the order itself out in
ranges, so that one group may hold all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meadowlark.sources.scratch import staged


def percentile(df: DataFrame, value: str, by: list[str], out: str, rank: str | None = None) -> DataFrame:
    """Adds ``out``: rank (ties share their average) over the count of values, times 98, plus 1; and, if
    named, ``rank``: 1 + how many values are larger. Nulls get null and don't count.

    One sort serves all: with peers in the frame, the running count is the last rank among equals."""
    order = Window.partitionBy(*by).orderBy(F.col(value).asc_nulls_last())
    n = F.count(value).over(Window.partitionBy(*by))
    ranked = df.withColumns({"_low": F.rank().over(order), "_high": F.count(value).over(order.rangeBetween(Window.unboundedPreceding, 0)), "_n": n})
    known = F.col(value).isNotNull()
    new = {out: F.when(known, (F.col("_low") + F.col("_high")) / 2 / F.col("_n") * 98 + 1)}
    if rank:
        new[rank] = F.when(known, F.col("_n") - F.col("_high") + 1)
    return ranked.withColumns(new).drop("_low", "_high", "_n")


def competition_rank(value: str, by: list[str]) -> Column:
    """1 + how many values are larger; null for null."""
    rank = F.rank().over(Window.partitionBy(*by).orderBy(F.col(value).desc_nulls_last()))
    return F.when(F.col(value).isNotNull(), rank.cast("long"))


def top(df: DataFrame, k: int, by: list[str], order: list[Column]) -> DataFrame:
    """The first k rows of each group."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_n", n).where(F.col("_n") <= k).drop("_n")


def _ranges(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows dealt out in ranges of ``order`` and written, with ``_part``, the number of their range."""
    return staged(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)


def numbered(df: DataFrame, order: list[Column], out: str = "n") -> DataFrame:
    """Adds ``out``: 1, 2, 3, ... over all rows in ``order``. A range numbers its own rows from the count of those
    before it (a row a range). The order should be total, for rows that are equal in it lie in one range."""
    ranged = _ranges(df, order, "numbered")
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranged.groupBy("_part").agg(F.count("*").alias("_rows")).select("_part", before.alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_own", own).join(F.broadcast(starts), "_part").withColumn(out, F.col("_before") + F.col("_own")).drop("_part", "_own", "_before")


def percentile_spread(df: DataFrame, value: str, by: list[str], out: str, rank: str | None = None) -> DataFrame:
    """``percentile`` for groups of any size. Equal values are counted first, so ties are one row however many
    they are; the values lie in ranges over (group, value), each knows how many rows of the group come in the
    ranges before it, and the rows fetch their value's place."""
    known = df.where(F.col(value).isNotNull())
    ranged = _ranges(known.groupBy(*by, value).agg(F.count("*").alias("_same")), [*map(F.col, by), F.col(value)], "values")
    named = [f"_b{i}" for i in range(len(by))]
    same = [F.col(b).eqNullSafe(F.col(n)) for b, n in zip(by, named, strict=True)]
    ahead = Window.partitionBy(*named).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(*[F.col(b).alias(n) for b, n in zip(by, named, strict=True)], F.col("_part").alias("_of")).agg(F.sum("_same").alias("_rows"))
    parts = parts.withColumns({"_before": F.coalesce(F.sum("_rows").over(ahead), F.lit(0)), "_n": F.sum("_rows").over(Window.partitionBy(*named))}).drop("_rows")
    within = Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    places = ranged.withColumn("_upto", F.sum("_same").over(within)).join(parts, [F.col("_part") == F.col("_of"), *same])
    high = F.col("_before") + F.col("_upto")
    new = {out: (2 * high - F.col("_same") + 1) / 2 / F.col("_n") * 98 + 1}
    if rank:
        new[rank] = F.col("_n") - high + 1
    told = places.select(*[F.col(b).alias(n) for b, n in zip(by, named, strict=True)], F.col(value).alias("_v"), *[c.alias(n) for n, c in new.items()])
    met = known.join(told, [F.col(value) == F.col("_v"), *same]).select(*df.columns, *new)
    rest = df.where(F.col(value).isNull()).select(*df.columns, *[F.lit(None).cast(told.schema[n].dataType).alias(n) for n in new])
    return met.unionByName(rest)
