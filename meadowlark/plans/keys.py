"""Queries over keys of published documents: what to write, what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meadowlark.functions import scalars
from meadowlark.operators import publish, quality
from meadowlark.plans import sql
from meadowlark.plans.prices import bars_of
from meadowlark.plans.registry import query
from meadowlark.sources import derived, readers

YEAR, AS_OF = 1997, "1998-06-29"


def all_keys(spark, sf) -> DataFrame:
    core = derived.core_keys(bars_of(spark, sf))
    files = core.groupBy("year").agg(F.sum("size").alias("size")).select(F.concat(F.lit("scores/RS_scores/sector/"), "year", F.lit(".json")).alias("key"), "size", (F.col("year") < 1998).alias("there"))
    return core.select("key", "size", (F.col("symbol") % 4 != 0).alias("there")).unionByName(files)


def existing(keys: DataFrame) -> DataFrame:
    return keys.where("there").select("key", "size")


_YEAR = "CAST(regexp_extract(key, '(?:^|/)([0-9]{4})(?:/|[.]json$)', 1) AS BIGINT)"


def _year_sql(always: str) -> str:
    return f"WITH {sql.KEYS}, y AS (SELECT key, {_YEAR} AS year FROM keys) SELECT key, year, CASE WHEN {always} THEN 'current' ELSE 'missing' END AS reason FROM y WHERE {always} OR key NOT IN (SELECT key FROM existing)"


@query("freeze_plan_year", _year_sql(f"year = {YEAR}"))
def freeze_plan_year(spark, sf):
    keys = all_keys(spark, sf)
    return publish.freeze_years(keys.select("key", scalars.year_of_key(F.col("key")).alias("year")), existing(keys), YEAR)


@query("freeze_plan_year_future", _year_sql(f"year >= {YEAR}"))
def freeze_plan_year_future(spark, sf):
    keys = all_keys(spark, sf)
    return publish.freeze_years(keys.select("key", scalars.year_of_key(F.col("key")).alias("year")), existing(keys), YEAR, future_open=True)


@query("freeze_plan_forced", f"WITH {sql.KEYS}, y AS (SELECT key, {_YEAR} AS year FROM keys) SELECT key, year, CASE WHEN year = {YEAR} THEN 'current' WHEN key NOT IN (SELECT key FROM existing) THEN 'missing' ELSE 'forced' END AS reason FROM y")
def freeze_plan_forced(spark, sf):
    """A dry run with the override: all keys, and why each would be written."""
    keys = all_keys(spark, sf)
    return publish.freeze_years(keys.select("key", scalars.year_of_key(F.col("key")).alias("year")), existing(keys), YEAR, force=True)


@query("deletion_plan", f"WITH {sql.KEYS} SELECT key, (row_number() OVER (ORDER BY key) - 1) // 10 AS batch FROM keys WHERE key LIKE 'scores/RS_scores/%' OR key LIKE 'stocks/daily/core/1996/%'")
def deletion_plan(spark, sf):
    return publish.deletion_plan(all_keys(spark, sf), [*quality.DEPRECATED, "scores/RS_scores/", "stocks/daily/core/1996/"], 10)


_MONTHS = f"""{sql.BARS}, k AS (SELECT DISTINCT symbol, year(dt) AS year, month(dt) AS month, 'stocks/intraday/5min/' || year(dt) || '/' || lpad(month(dt)::VARCHAR, 2, '0') || '/' || symbol || '.json' AS key FROM bars),
s AS (SELECT *, date_diff('day', last_day(make_date(year, month, 1)), DATE '{AS_OF}') <= 60 AS o FROM k)"""


@query("freeze_plan_month", f"WITH {_MONTHS} SELECT key, year, month, CASE WHEN o THEN 'open' ELSE 'missing' END AS reason FROM s WHERE o OR symbol % 4 = 0")
def freeze_plan_month(spark, sf):
    rows = bars_of(spark, sf).select("symbol", F.year("dt").alias("y"), F.month("dt").alias("m")).distinct()
    keys = rows.select("symbol", F.concat(F.lit("stocks/intraday/5min/"), "y", F.lit("/"), F.lpad(F.col("m").cast("string"), 2, "0"), F.lit("/"), "symbol", F.lit(".json")).alias("key"))
    there = keys.where("symbol % 4 <> 0")
    parts = keys.select("key", scalars.year_of_key(F.col("key")).alias("year"), scalars.month_of_key(F.col("key")).alias("month"))
    return publish.freeze_months(parts, there, AS_OF)


@query("write_missing_years", f"WITH {sql.BARS} SELECT DISTINCT symbol, year(dt) AS year FROM bars WHERE symbol % 4 = 0 OR year(dt) = 1995")
def write_missing_years(spark, sf):
    bars = bars_of(spark, sf)
    there = bars.select("symbol", F.year("dt").cast("long").alias("year")).distinct().where("symbol % 4 <> 0 and year <> 1995")
    return publish.missing_years(bars, there)


@query("years_per_symbol", f"WITH {sql.BARS} SELECT symbol, count(DISTINCT year(dt)) AS n_years, min(year(dt)) AS first_year FROM bars GROUP BY 1")
def years_per_symbol(spark, sf):
    keys = derived.core_keys(bars_of(spark, sf))
    sets = readers.years_by_symbol(keys)
    return sets.select(F.col("symbol").cast("long").alias("symbol"), F.size("years").cast("long").alias("n_years"), F.array_min("years").alias("first_year"))


_SIZE = "CASE WHEN bytes < 1024 THEN printf('%.2f B', bytes::DOUBLE) WHEN bytes < 1048576 THEN printf('%.2f KB', bytes / 1024.0e0) WHEN bytes < 1073741824 THEN printf('%.2f MB', bytes / 1048576.0e0) ELSE printf('%.2f GB', bytes / 1073741824.0e0) END"


@query("key_inventory", f"WITH {sql.KEYS}, g AS (SELECT CASE WHEN key LIKE 'stocks/%' THEN 'stocks/daily/core' ELSE 'scores/RS_scores/sector' END AS prefix, count(*) AS files, sum(size)::BIGINT AS bytes FROM keys GROUP BY 1) SELECT prefix, files, bytes, {_SIZE} AS human FROM g")
def key_inventory(spark, sf):
    return quality.inventory(all_keys(spark, sf)).withColumn("human", scalars.human_size(F.col("bytes")))


@query("deprecated_keys", f"WITH {sql.KEYS} SELECT 'scores/RS_scores/' AS prefix, count(*) AS files FROM keys WHERE key LIKE 'scores/RS_scores/%'")
def deprecated_keys(spark, sf):
    return quality.deprecated(all_keys(spark, sf), [*quality.DEPRECATED, "scores/RS_scores/"])
