"""Queries over macro series, intraday bars and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meadowlark.operators import market, merge, publish, quality
from meadowlark.plans import sql
from meadowlark.plans.prices import bars_of, rounded
from meadowlark.plans.registry import query
from meadowlark.sources import derived, readers

def settled(df: DataFrame, column: str) -> DataFrame:
    """A column to six places. These means end in decimal ties, which plain rounding would decide by noise in
    the last bit: so what is cut off starts at an odd place, where no short decimal lies."""
    return df.withColumn(column, (F.floor(F.col(column) * 1e6 + 0.3141592653589) / 1e6).cast("double"))


def settled_sql(value: str) -> str:
    return f"CAST(floor(({value}) * 1e6 + 0.3141592653589e0) / 1e6 AS DOUBLE)"


def sectors(spark, sf) -> DataFrame:
    return derived.sector_series(bars_of(spark, sf), derived.dim(spark, sf))


@query(
    "yield_unpivot",
    f"""WITH r AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS dt, {settled_sql("avg(l_discount)")} AS y2, {settled_sql("avg(l_tax)")} AS y10, {settled_sql("avg(l_extendedprice)")} AS y30 FROM lineitem GROUP BY 1),
u AS (SELECT dt, 'Y2' AS ticker, y2 AS y FROM r UNION ALL SELECT dt, 'Y10', y10 FROM r UNION ALL SELECT dt, 'Y30', y30 FROM r)
SELECT dt, ticker, y AS open, y AS high, y AS low, y AS close, CAST(NULL AS BIGINT) AS volume FROM u WHERE y IS NOT NULL""",
)
def yield_unpivot(spark, sf):
    rates = derived.table(spark, sf, "lineitem").groupBy(F.trunc("l_shipdate", "week").alias("dt")).agg(F.avg("l_discount").alias("year2"), F.avg("l_tax").alias("year10"), F.avg("l_extendedprice").alias("year30"))
    rates = settled(settled(settled(rates, "year2"), "year10"), "year30")
    return market.yields_as_bars(rates, {"year2": "Y2", "year10": "Y10", "year30": "Y30"})


_ERA = "CASE o_orderkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'R' WHEN 2 THEN 'X' ELSE 'H' END"


@query(
    "era_date",
    f"""WITH e AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, {_ERA} AS era, CASE o_orderkey % 5 WHEN 0 THEN 1925 WHEN 1 THEN 1990 ELSE 1988 END AS zero, CASE WHEN o_orderkey % 7 = 0 THEN 12 ELSE 0 END AS more FROM orders)
    SELECT o_orderkey, era || (year(d) - zero) || '.' || (month(d) + more) || '.' || day(d) AS era, CASE WHEN era <> 'X' AND more = 0 THEN CASE WHEN era <> 'R' THEN d ELSE try_cast((year(d) + 28) || '-' || month(d) || '-' || day(d) AS DATE) END END AS dt FROM e""",
)
def era_date(spark, sf):
    """Order dates as an era's: two eras' own years, one 28 years later (a 29 February may not exist then), a letter that is
    none, months beyond 12."""
    k, d = F.col("o_orderkey") % 5, F.to_date("o_orderdate")
    letter = F.when(k == 0, "S").when(k == 1, "R").when(k == 2, "X").otherwise("H")
    year = F.year(d) - F.when(k == 0, 1925).when(k == 1, 1990).otherwise(1988)
    month = F.month(d) + F.when(F.col("o_orderkey") % 7 == 0, 12).otherwise(0)
    era = F.concat(letter, year.cast("string"), F.lit("."), month.cast("string"), F.lit("."), F.dayofmonth(d).cast("string"))
    return derived.table(spark, sf, "orders").select("o_orderkey", era.alias("era")).withColumn("dt", readers.era_date(F.col("era")))


@query("market_transpose", f"WITH {sql.SERIES} SELECT year(dt) AS year, dt, ticker, {settled_sql("close")} AS close, volume FROM series")
def market_transpose(spark, sf):
    days = market.by_date(sectors(spark, sf), ["close", "volume"])
    rows = days.select("year", "dt", F.explode("bars").alias("ticker", "bar"))
    return settled(rows.select("year", "dt", "ticker", "bar.close", "bar.volume"), "close")


@query("market_year_documents", f"WITH {sql.SERIES} SELECT year(dt) AS year, count(DISTINCT ticker) AS tickers, count(DISTINCT dt) AS dates, count(*) AS bars FROM series GROUP BY 1")
def market_year_documents(spark, sf):
    docs = market.year_documents(sectors(spark, sf), ["close", "volume"])
    bars = F.aggregate(F.map_values("data"), F.lit(0), lambda n, m: n + F.size(m))
    return docs.select("year", F.size("tickers").cast("long").alias("tickers"), F.size("data").cast("long").alias("dates"), bars.cast("long").alias("bars"))


@query("series_ratio", f"WITH {sql.SERIES} SELECT a.dt, round(a.close / nullif(b.close, 0), 6) AS value FROM series a JOIN series b USING (dt) WHERE a.ticker = 'ASIA' AND b.ticker = 'EUROPE' AND a.close IS NOT NULL AND b.close IS NOT NULL")
def series_ratio(spark, sf):
    return rounded(market.ratio(sectors(spark, sf), "ASIA", "EUROPE"), "value")


@query("series_spread", f"WITH {sql.SERIES} SELECT a.dt, {settled_sql("a.close - b.close")} AS value FROM series a JOIN series b USING (dt) WHERE a.ticker = 'ASIA' AND b.ticker = 'AMERICA'")
def series_spread(spark, sf):
    return settled(market.ratio(sectors(spark, sf), "ASIA", "AMERICA", difference=True), "value")


_LISTED = "listed AS (SELECT DISTINCT r_name AS ticker FROM region UNION ALL SELECT 'NOWHERE')"


def _listed(spark, sf) -> DataFrame:
    return derived.table(spark, sf, "region").select(F.col("r_name").alias("ticker")).distinct().unionByName(spark.createDataFrame([("NOWHERE",)], "ticker string"))


@query("series_coverage", f"WITH {sql.SERIES}, {_LISTED} SELECT ticker, min(dt) AS first, max(dt) AS last, count(dt) AS rows FROM listed LEFT JOIN series USING (ticker) GROUP BY 1")
def series_coverage(spark, sf):
    return quality.series_coverage(sectors(spark, sf), _listed(spark, sf))


@query("degraded_series", f"WITH {sql.SERIES}, {_LISTED} SELECT ticker, count(dt) AS rows FROM listed LEFT JOIN series USING (ticker) GROUP BY 1 HAVING count(dt) < 100")
def degraded_series(spark, sf):
    return quality.degraded(sectors(spark, sf), _listed(spark, sf))


_MERGE = f"""{sql.BARS}, old AS (SELECT symbol, dt, CASE WHEN day(dt) > 5 THEN close END AS close, volume FROM bars WHERE symbol % 3 <> 0),
new AS (SELECT symbol, dt, close * 1.01e0 AS close, volume FROM bars WHERE symbol % 2 = 0)"""


def _sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    bars = bars_of(spark, sf).select("symbol", "dt", "close", "volume")
    old = bars.where("symbol % 3 <> 0").withColumn("close", F.when(F.dayofmonth("dt") > 5, F.col("close")))
    return old, bars.where("symbol % 2 = 0").withColumn("close", F.col("close") * F.lit(1.01))


@query("market_upsert", f"WITH {_MERGE} SELECT symbol, dt, close, volume FROM new UNION ALL SELECT symbol, dt, close, volume FROM old ANTI JOIN new USING (symbol, dt)")
def market_upsert(spark, sf):
    return merge.upsert(*_sides(spark, sf), ["symbol", "dt"])


@query(
    "fill_only_merge",
    f"""WITH {_MERGE} SELECT symbol, dt, coalesce(o.close, n.close) AS close, coalesce(o.volume, n.volume) AS volume,
    o.volume IS NULL OR (o.close IS NULL AND n.close IS NOT NULL) AS changed FROM old o FULL JOIN new n USING (symbol, dt)""",
)
def fill_only_merge(spark, sf):
    return merge.fill(*_sides(spark, sf), ["symbol", "dt"], ["close"])


@query(
    "date_anti_merge",
    f"WITH {sql.BARS}, old AS (SELECT symbol, dt, volume FROM bars WHERE year(dt) < 1996), new AS (SELECT symbol, dt, volume FROM bars WHERE symbol % 2 = 0) SELECT * FROM old UNION ALL SELECT * FROM new WHERE dt NOT IN (SELECT dt FROM old)",
)
def date_anti_merge(spark, sf):
    bars = bars_of(spark, sf).select("symbol", "dt", "volume")
    return merge.add_missing_dates(bars.where(F.year("dt") < 1996), bars.where("symbol % 2 = 0"))


@query("date_replace_merge", f"WITH {sql.BARS}, old AS (SELECT symbol, dt, volume FROM bars), new AS (SELECT symbol, dt, volume + 1 AS volume FROM bars WHERE year(dt) = 1996) SELECT * FROM new UNION ALL SELECT * FROM old WHERE year(dt) <> 1996")
def date_replace_merge(spark, sf):
    bars = bars_of(spark, sf).select("symbol", "dt", "volume")
    return merge.replace_dates(bars, bars.where(F.year("dt") == 1996).withColumn("volume", F.col("volume") + 1))


@query("fill_counts", f"WITH {_MERGE} SELECT 'before' AS state, count(*) AS records, count(close) AS filled FROM old UNION ALL SELECT 'after', count(*), count(coalesce(o.close, n.close)) FROM old o FULL JOIN new n USING (symbol, dt)")
def fill_counts(spark, sf):
    old, new = _sides(spark, sf)
    return quality.fill_counts(old, merge.fill(old, new, ["symbol", "dt"], ["close"]), "close")


_FIVE = """five AS (
  SELECT event_type AS symbol, time_bucket(INTERVAL 5 MINUTE, ts) AS ts, first(value ORDER BY ts, event_id, value) AS open, max(value) AS high, min(value) AS low, last(value ORDER BY ts, event_id, value) AS close, count(*) AS n
  FROM events WHERE value IS NOT NULL GROUP BY 1, 2)"""


@query("bars_5min", f"WITH {_FIVE} SELECT * FROM five")
def bars_5min(spark, sf):
    return derived.bars_5min(derived.table(spark, sf, "events"))


@query(
    "intraday_month",
    f"WITH {_FIVE}, l AS (SELECT symbol, timezone('America/New_York', timezone('UTC', ts)) AS t, n FROM five) SELECT symbol, year(t) AS year, lpad(month(t)::VARCHAR, 2, '0') AS month, count(*) AS bars, sum(n)::BIGINT AS events, strftime(min(t), '%Y-%m-%dT%H:%M:%S') AS first FROM l GROUP BY 1, 2, 3",
)
def intraday_month(spark, sf):
    bars = derived.bars_5min(derived.table(spark, sf, "events")).withColumn("ts", F.col("ts").cast("timestamp")).withColumnRenamed("n", "volume")
    docs = publish.month_documents(bars, bars.select("symbol").distinct())
    events = F.aggregate("data", F.lit(0).cast("long"), lambda n, r: n + r["volume"])
    return docs.select("symbol", "year", "month", F.size("data").cast("long").alias("bars"), events.alias("events"), F.date_format(F.col("data")[0]["local"], "yyyy-MM-dd'T'HH:mm:ss").alias("first"))


@query("field_type_check", "SELECT json_field AS field, CASE WHEN v IS NULL THEN 'null' WHEN regexp_matches(v, '^-?[0-9]+$') THEN 'integer' ELSE 'string' END AS type, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS json_field, unnest(list_transform(json_keys(props), lambda k: json_extract_string(props, k))) AS v FROM events) GROUP BY 1, 2")
def field_type_check(spark, sf):
    rows = derived.table(spark, sf, "events").select(F.explode(F.from_json("props", "map<string,string>")).alias("field", "v"))
    return quality.field_types(rows, "v", ["field"])
