"""Queries over files: what the writers wrote, read back by the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meadowlark import schemas
from meadowlark.functions import scalars
from meadowlark.operators import market, panel, publish, rank, universe
from meadowlark.plans import sql
from meadowlark.plans.prices import bars_of, rounded, scores_of
from meadowlark.plans.registry import query
from meadowlark.plans.series import sectors, settled, settled_sql
from meadowlark.sources import derived, readers
from meadowlark.sources.derived import table
from meadowlark.sources.scratch import fresh_path


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """Rows as files whose names and lines have an order, written in parallel: readers take lines as they lie."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


# ---- universes ----------------------------------------------------------------------------------

_BRAND = "p_brand AS \"Symbol\", CASE WHEN p_size % 10 <> 0 THEN p_name END AS name, CASE WHEN p_size % 9 <> 0 THEN p_type ELSE 'N/A' END AS sector"


def _listing(spark, sf) -> DataFrame:
    sector = F.when(F.col("p_size") % 9 != 0, F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("Symbol"), F.when(F.col("p_size") % 10 != 0, F.col("p_name")).alias("Company Name"), sector.alias("Sector"), F.lit("NA").alias("Industry"))


@query("universe_csv", f"SELECT \"Symbol\" AS symbol, coalesce(name, \"Symbol\") AS name, sector, 'NA' AS industry FROM (SELECT p_partkey, {_BRAND} FROM part) QUALIFY row_number() OVER (PARTITION BY \"Symbol\" ORDER BY p_partkey DESC) = 1")
def universe_csv(spark, sf):
    path = fresh_path(spark, "universe")
    in_order(_listing(spark, sf), "p_partkey").drop("p_partkey").write.option("header", True).csv(path)
    return readers.universe(spark, path)


def _jp(spark, sf) -> str:
    path = fresh_path(spark, "universe-jp")
    rows = _listing(spark, sf).withColumn("Symbol", F.when(F.col("p_partkey") % 7 == 0, " ").otherwise(F.concat(F.lit(" "), "Symbol", F.lit("  ")))).withColumn("Market", F.lit("Prime"))
    out = in_order(rows, "p_partkey").drop("p_partkey").write.option("header", True)
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@query("universe_jp_csv", f"SELECT \"Symbol\" AS symbol, coalesce(name, ' ' || \"Symbol\" || '  ') AS name, sector, 'NA' AS industry FROM (SELECT p_partkey, {_BRAND} FROM part WHERE p_partkey % 7 <> 0) QUALIFY row_number() OVER (PARTITION BY \"Symbol\" ORDER BY p_partkey) = 1")
def universe_jp_csv(spark, sf):
    return readers.universe_jp(spark, _jp(spark, sf)).select("symbol", "name", "sector", "industry")


@query("universe_jp_all", "SELECT p_brand AS symbol, count(*) AS n FROM part WHERE p_partkey % 7 <> 0 GROUP BY 1")
def universe_jp_all(spark, sf):
    return readers.universe_jp(spark, _jp(spark, sf), dedup=False).groupBy("symbol").agg(F.count("*").alias("n"))


_LETTERS = "'0123456789', 'ABUWRXCDEF'"
_ALWAYS = ("QB", "QUA")
_NOT = " AND ".join(f"NOT contains(upper(name), '{w}')" for w in universe.NOT_COMMON)
_GONE = "|".join(universe.DELISTED)


UNIVERSE_SQL = f"""WITH p AS (SELECT *, 'Q' || translate(p_partkey::VARCHAR, {_LETTERS}) AS symbol, p_name || CASE p_size % 11 WHEN 0 THEN ' Trust' WHEN 1 THEN ' (old)' ELSE '' END AS name,
  CASE WHEN p_size % 8 <> 0 THEN p_retailprice ELSE 0 END AS price, CASE WHEN p_size % 5 <> 0 THEN p_size % 7 <> 0 END AS active,
  CASE p_size % 3 WHEN 0 THEN 'OTC' WHEN 1 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange, CAST(DATE '1990-01-01' + CAST(p_partkey * 37 % 4000 AS INTEGER) AS DATE) AS ipo FROM part),
k AS (SELECT *, symbol IN {_ALWAYS} AS always FROM p)
SELECT symbol, name, p_type AS sector, p_brand AS industry, price, coalesce(CASE WHEN p_size % 4 <> 0 THEN p_size * 1e6 END, 0) AS market_cap, CAST(ipo AS VARCHAR) AS ipo_date, exchange FROM k
WHERE price > 0 AND coalesce(active, TRUE) AND exchange <> 'OTC' AND NOT regexp_matches(upper(name), '\\b({_GONE})\\b')
  AND (always OR (length(symbol) <= 5 AND NOT (length(symbol) = 5 AND regexp_matches(symbol, '[UWRX]$')) AND {_NOT} AND ipo <= DATE '1998-01-01' - 730))"""


def universe_sources(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The screener's rows and the profiles."""
    part, size = table(spark, sf, "part"), F.col("p_size")
    symbol = F.concat(F.lit("Q"), F.translate(F.col("p_partkey").cast("string"), "0123456789", "ABUWRXCDEF"))
    name = F.concat("p_name", F.when(size % 11 == 0, " Trust").when(size % 11 == 1, " (old)").otherwise(""))
    exchange = F.when(size % 3 == 0, "OTC").when(size % 3 == 1, "NYSE").otherwise("NASDAQ")
    ipo = F.date_add(F.lit("1990-01-01").cast("date"), (F.col("p_partkey") * 37 % 4000).cast("int")).cast("string")
    stocks = part.select(symbol.alias("symbol"), name.alias("name"), exchange.alias("exchangeShortName"), F.when(size % 8 != 0, F.col("p_retailprice")).otherwise(0.0).alias("price"))
    profiles = part.select(
        symbol.alias("symbol"), F.when(size % 5 != 0, size % 7 != 0).alias("isActivelyTrading"), name.alias("companyName"), exchange.alias("exchange"), ipo.alias("ipoDate"), F.col("p_type").alias("sector"), F.col("p_brand").alias("industry"), F.when(size % 4 != 0, size * 1e6).alias("marketCap")
    )
    return stocks, profiles


@query("universe_select", UNIVERSE_SQL)
def universe_select(spark, sf):
    return universe.select(*universe_sources(spark, sf), "1998-01-01", _ALWAYS)


_SEGMENT = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(universe.SEGMENTS))
_SHORT = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in universe.SEGMENTS.items())


@query(
    "segment_filter",
    f"WITH c AS (SELECT c_nationkey AS symbol, c_custkey AS line, CASE c_custkey % 5 {_SEGMENT} ELSE 'ETF' END AS segment, CASE WHEN c_custkey % 3 = 0 THEN '-' ELSE c_mktsegment END AS sector, CASE WHEN c_custkey % 7 = 0 THEN '-' ELSE 'x' END AS industry FROM customer) "
    f"SELECT symbol, line, CASE segment {_SHORT} END AS market, sector FROM c WHERE segment <> 'ETF' AND sector <> '-' AND industry <> '-' QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY line) = 1",
)
def segment_filter(spark, sf):
    k = F.col("c_custkey")
    segment = F.coalesce(*[F.when(k % 5 == i, s) for i, s in enumerate(universe.SEGMENTS)], F.lit("ETF"))
    listing = table(spark, sf, "customer").select(F.col("c_nationkey").alias("symbol"), k.alias("line"), segment.alias("segment"), F.when(k % 3 == 0, "-").otherwise(F.col("c_mktsegment")).alias("sector"), F.when(k % 7 == 0, "-").otherwise("x").alias("industry"))
    return universe.classified(listing).select("symbol", "line", "market", "sector")


@query("excluded_symbols", "SELECT c_custkey AS symbol FROM customer WHERE c_custkey NOT IN (1, 2, 3)")
def excluded_symbols(spark, sf):
    return universe.without(table(spark, sf, "customer").select(F.col("c_custkey").alias("symbol")), [1, 2, 3])


# ---- landed records -----------------------------------------------------------------------------


@query(
    "estimates_projection",
    "SELECT c_mktsegment AS symbol, year(o_orderdate) AS year, round(min(o_totalprice), 6) AS revenueLow, round(max(o_totalprice), 6) AS revenueHigh, round(avg(o_totalprice), 6) AS revenueAvg, count(*) AS numAnalystsRevenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
)
def estimates_projection(spark, sf):
    """Estimates land with fields that nobody asked for; the schema leaves them in the file."""
    o, c, t = table(spark, sf, "orders"), table(spark, sf, "customer"), F.col("o_totalprice")
    landed = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_mktsegment").alias("symbol"), F.trunc("o_orderdate", "year").alias("date")).agg(
        F.min(t).alias("revenueLow"), F.max(t).alias("revenueHigh"), F.avg(t).alias("revenueAvg"), F.count("*").alias("numAnalystsRevenue"), F.max("c_name").alias("vendor")
    )
    path = fresh_path(spark, "estimates")
    landed.write.json(path)
    rows = readers.json_table(spark, path, schemas.ESTIMATES)
    return rounded(rows.select("symbol", F.year("date").cast("long").alias("year"), "revenueLow", "revenueHigh", "revenueAvg", "numAnalystsRevenue"), "revenueLow", "revenueHigh", "revenueAvg")


@query("float_snapshot", "SELECT n_name AS ticker, c_acctbal AS freeFloat, c_name AS source FROM customer JOIN nation ON c_nationkey = n_nationkey QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_name) = 1")
def float_snapshot(spark, sf):
    """A file a nation, an array of the three customers with the largest balances, the largest first."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    known = c.join(n, c.c_nationkey == n.n_nationkey).select("n_nationkey", F.col("n_name").alias("ticker"), F.col("c_acctbal").alias("freeFloat"), F.col("c_name").alias("source"))
    some = rank.top(known, 3, ["n_nationkey"], [F.desc("freeFloat"), F.asc("source")])
    order = F.struct((-F.col("freeFloat")).alias("o"), "source", "ticker", "freeFloat")
    files = some.groupBy("n_nationkey").agg(F.to_json(F.array_sort(F.collect_list(order))).alias("value"))
    path = fresh_path(spark, "float")
    files.repartition("n_nationkey").write.partitionBy("n_nationkey").text(path)
    return readers.shares_float(spark, path).select("ticker", "freeFloat", "source")


@query("government_bonds", "SELECT CAST(o_orderdate AS DATE) AS dt, round(avg(o_totalprice) / 10000, 3) AS yield FROM orders WHERE o_orderdate >= DATE '1995-01-01' AND o_orderdate < DATE '1996-01-01' AND month(o_orderdate) <> 2 GROUP BY 1")
def government_bonds(spark, sf):
    """A year of the ministry's file: Shift-JIS, title, header, era dates, a missing February. It is one file, as it lands:
    a line a day of the year."""
    days = table(spark, sf, "orders").where("o_orderdate >= date'1995-01-01' and o_orderdate < date'1996-01-01'").groupBy(F.to_date("o_orderdate").alias("dt")).agg(F.round(F.avg("o_totalprice") / 10000, 3).alias("y"))
    cell = F.when(F.month("dt") == 2, "-").otherwise(F.col("y").cast("string"))
    era = F.concat(F.lit("H7."), F.month("dt").cast("string"), F.lit("."), F.dayofmonth("dt").cast("string"))
    lines = days.select(F.concat_ws(",", era, F.lit("-"), cell).alias("line"), F.unix_date("dt").alias("at"))
    heads = spark.createDataFrame([("国債金利情報,,(単位 : %)", -2), ("基準日,1年,10年", -1)], "line string, at int")
    path = fresh_path(spark, "bonds")
    with readers.any_charset(spark):
        lines.unionByName(heads).coalesce(1).sortWithinPartitions("at").select("line").write.option("encoding", "windows-31j").option("sep", "\t").option("quote", "\0").option("escapeQuotes", False).csv(path)
    return readers.government_bonds(spark, path)


@query("unique_bars", "SELECT event_type AS symbol, date_trunc('hour', ts) AS ts, first(event_id ORDER BY event_id) AS line FROM events GROUP BY 1, 2")
def unique_bars(spark, sf):
    rows = table(spark, sf, "events").select(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("ts"), F.col("event_id").alias("line"))
    return readers.unique_bars(rows, "line")


# ---- documents ----------------------------------------------------------------------------------


def core_documents(spark, bars: DataFrame, scores: DataFrame, dim: DataFrame) -> DataFrame:
    """Year documents in the published form: ticker, and rows with ``date``."""
    docs = publish.year_documents(publish.core_rows(bars, scores), dim)
    form = schemas.CORE_DOC.split("data ", 1)[1]
    return docs.select("year", F.col("symbol").cast("string").alias("ticker"), "name", "sector", "industry", F.col("data").cast(form).alias("data"))


_YEARS = (1995, 1996)


@query("core_documents_read", f"WITH {sql.RS} SELECT year(b.dt) AS year, b.symbol::VARCHAR AS symbol, name, b.dt, close, volume::BIGINT AS volume, round(rs_percentile, 6) AS rs_percentile FROM bars b JOIN dim USING (symbol) LEFT JOIN rs ON rs.symbol = b.symbol AND rs.dt = b.dt WHERE year(b.dt) IN {_YEARS}")
def core_documents_read(spark, sf):
    bars, path = bars_of(spark, sf), fresh_path(spark, "core")
    publish.write_documents(core_documents(spark, bars, scores_of(spark, sf), derived.dim(spark, sf)), path, ["year"])
    rows = readers.core_docs(spark, path, list(_YEARS))
    return rounded(rows.select(F.col("year").cast("long").alias("year"), "symbol", "name", "dt", "close", "volume", "rs_percentile"), "rs_percentile")


@query("overwritten_years", f"WITH {sql.BARS}, {sql.DIM} SELECT year(dt) AS year, symbol::VARCHAR AS symbol, dt, CASE WHEN year(dt) = 1995 THEN close + 1 ELSE close END AS close FROM bars JOIN dim USING (symbol) WHERE year(dt) >= 1994 AND (year(dt) <> 1995 OR symbol % 2 = 0)")
def overwritten_years(spark, sf):
    """A year written over replaces that year's documents and no other's."""
    dim, path = derived.dim(spark, sf), fresh_path(spark, "core")
    bars = bars_of(spark, sf).where(F.year("dt") >= 1994)
    none = bars.select("symbol", "dt", F.lit(None).cast("double").alias("rs_percentile")).limit(0)
    publish.write_documents(core_documents(spark, bars, none, dim), path, ["year"])
    again = bars.where((F.year("dt") == 1995) & (F.col("symbol") % 2 == 0)).withColumn("close", F.col("close") + 1)
    publish.write_documents(core_documents(spark, again, none, dim), path, ["year"])
    return readers.core_docs(spark, path).select(F.col("year").cast("long").alias("year"), "symbol", "dt", "close")


@query("scores_by_year", f"WITH {sql.RS} SELECT year(dt) AS year, dt AS date, symbol::VARCHAR AS ticker, sector, round(rs_percentile, 6) AS rs_percentile, rank FROM rs JOIN dim USING (symbol) WHERE year(dt) = 1996")
def scores_by_year(spark, sf):
    from meadowlark.operators import rs

    scores, path = rs.decorated(scores_of(spark, sf), derived.dim(spark, sf)), fresh_path(spark, "scores")
    rows = scores.select(F.year("dt").cast("long").alias("year"), F.col("dt").alias("date"), F.col("symbol").cast("string").alias("ticker"), "name", "sector", "industry", "rs_percentile", "rank")
    publish.write_documents(rows, path, ["year"])
    back = readers.json_table(spark, path, schemas.SCORES + ", year long").where("year = 1996")
    return rounded(back.select("year", "date", "ticker", "sector", "rs_percentile", "rank"), "rs_percentile")


@query("nested_panel", f"WITH {sql.BARS}, {sql.DIM} SELECT symbol::VARCHAR AS symbol, name, sector, dt, open, high, low, close, volume::BIGINT AS volume FROM bars JOIN dim USING (symbol)")
def nested_panel(spark, sf):
    path = fresh_path(spark, "panel")
    publish.panel_documents(bars_of(spark, sf), derived.dim(spark, sf), "1998-12-31").write.json(path)
    return readers.nested_panel(spark, path, lines=True).select("symbol", "name", "sector", "dt", "open", "high", "low", "close", "volume")


@query("market_year_read", f"WITH {sql.SERIES} SELECT year(dt) AS year, ticker, dt, {settled_sql('close')} AS close, volume::BIGINT AS volume FROM series")
def market_year_read(spark, sf):
    path, bar = fresh_path(spark, "market"), ["open", "high", "low", "close", "volume"]
    full = sectors(spark, sf).select("ticker", "dt", *[F.col("close").alias(c) for c in bar[:4]], F.col("volume").cast("long").alias("volume"))
    market.year_documents(full, bar).repartition("year").write.partitionBy("year").json(path)
    rows = readers.market_year(spark, path)
    return settled(rows.select(F.col("year").cast("long").alias("year"), "ticker", "dt", "close", "volume"), "close")


@query("listed_years", "SELECT 'year=' || year(o_orderdate) AS child, count(*) > 0 AS has_files FROM orders GROUP BY 1")
def listed_years(spark, sf):
    """What lies under a folder of documents, from a listing of keys and sizes alone."""
    path = fresh_path(spark, "listed")
    publish.write_documents(table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_orderkey"), f"{path}/core", ["year"])
    keys = readers.keys(spark, path).where(~F.col("key").contains("_SUCCESS") & ~F.col("key").endswith(".crc") & (F.col("size") > 0))
    return readers.children(keys, "core/").withColumn("has_files", F.lit(True))


# ---- functions ----------------------------------------------------------------------------------


@query("drop_empty", f"WITH {sql.BARS} SELECT symbol, dt FROM bars WHERE day(dt) > 5")
def drop_empty(spark, sf):
    some = F.dayofmonth("dt") > 5
    holed = bars_of(spark, sf).select("symbol", "dt", *[F.when(some, F.col(c)).alias(c) for c in ("open", "close", "volume")])
    return panel.drop_empty(holed).select("symbol", "dt")


@query("rounding_modes", "SELECT n AS n, CASE WHEN n % 2 = 0 THEN n // 2 ELSE (n + 1) // 2 END AS up, CASE WHEN n % 2 = 0 THEN n // 2 WHEN (n // 2) % 2 = 0 THEN n // 2 ELSE n // 2 + 1 END AS even, CASE WHEN n % 3 <> 0 THEN n * 1.0e0 END AS present FROM (SELECT CAST(p_size AS BIGINT) AS n FROM part)")
def rounding_modes(spark, sf):
    n = F.col("p_size").cast("long")
    half = (n / 2).cast("double")
    value = F.when(n % 3 != 0, n.cast("double")).otherwise(float("nan"))
    return table(spark, sf, "part").select(n.alias("n"), scalars.rounded(half, 0).cast("long").alias("up"), scalars.rounded(half, 0, "even").cast("long").alias("even"), scalars.present(value).alias("present"))


@query("json_round_trip", "SELECT n_nationkey, n_name AS name, n_regionkey AS region, n_name || '\"' AS quoted FROM nation")
def json_round_trip(spark, sf):
    doc = F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"), F.concat("n_name", F.lit('"')).alias("quoted")))
    back = F.from_json(doc, "name string, region int, quoted string")
    return table(spark, sf, "nation").select("n_nationkey", back.alias("r")).select("n_nationkey", "r.*")
