"""Queries over the weekly price panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meadowlark.functions import indicators
from meadowlark.operators import panel, publish, quality, rank, rs
from meadowlark.plans import sql
from meadowlark.plans.registry import query
from meadowlark.sources import derived


def bars_of(spark: SparkSession, sf: str) -> DataFrame:
    return derived.bars_weekly(spark, sf)


def scores_of(spark: SparkSession, sf: str) -> DataFrame:
    return rs.individual(bars_of(spark, sf))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("bars_weekly", f"WITH {sql.BARS} SELECT symbol, dt, open, high, low, close, volume FROM bars")
def bars_weekly(spark, sf):
    return bars_of(spark, sf)


@query("rs_individual", f"WITH {sql.RS} SELECT symbol, dt, round(rs_percentile, 6) AS rs_percentile, rank, name, sector, industry FROM rs JOIN dim USING (symbol)")
def rs_individual(spark, sf):
    return rounded(rs.decorated(scores_of(spark, sf), derived.dim(spark, sf)), "rs_percentile").select("symbol", "dt", "rs_percentile", "rank", "name", "sector", "industry")


def _group(by: str, weight: str):
    def build(spark, sf):
        bars = bars_of(spark, sf)
        out = rs.group(rs.individual(bars), derived.dim(spark, sf), rs.weights(bars, weight), by, 6)
        if by == "industry":
            out = out.join(rs.first_sector(derived.dim(spark, sf)), "industry")
        return rounded(out, "rs_percentile")

    return build


def _group_sql(by: str, weight: str) -> str:
    extra = ", (SELECT first(sector ORDER BY symbol) FROM dim d WHERE d.industry = r.industry) AS sector" if by == "industry" else ""
    return f"WITH {sql.RS}, {sql.group(by, weight)} SELECT {by}, dt, round(rs_percentile, 6) AS rs_percentile, rank, (SELECT count(*) FROM dim d WHERE d.{by} = r.{by}) AS stock_count{extra} FROM ranked r"


for _name, _by, _weight in (("rs_sector", "sector", "last_row"), ("rs_industry", "industry", "last_row"), ("rs_sector_ffill_weight", "sector", "ffill"), ("rs_industry_valid_weight", "industry", "last_valid")):
    query(_name, _group_sql(_by, _weight))(_group(_by, _weight))


@query("rs_latest_topk", f"WITH {sql.RS} SELECT symbol, dt, round(rs_percentile, 6) AS rs_percentile, rank FROM rs WHERE dt = (SELECT max(dt) FROM rs) ORDER BY rank, symbol LIMIT 10")
def rs_latest_topk(spark, sf):
    scores = scores_of(spark, sf)
    last = scores.join(F.broadcast(scores.agg(F.max("dt").alias("dt"))), "dt", "left_semi")
    return rounded(last.orderBy("rank", "symbol").limit(10), "rs_percentile")


@query(
    "sector_ranking_latest",
    f"WITH {sql.RS}, {sql.group('sector', 'last_row')} SELECT sector, dt, round(rs_percentile, 6) AS rs_percentile, rank FROM ranked WHERE dt = (SELECT max(dt) FROM ranked)",
)
def sector_ranking_latest(spark, sf):
    bars = bars_of(spark, sf)
    groups = rs.group(rs.individual(bars), derived.dim(spark, sf), rs.weights(bars), "sector", 6).drop("stock_count")
    return rounded(groups.join(F.broadcast(groups.agg(F.max("dt").alias("dt"))), "dt", "left_semi"), "rs_percentile")


@query("rs_topk_by_date", f"WITH {sql.RS} SELECT symbol, dt, rank FROM rs QUALIFY row_number() OVER (PARTITION BY dt ORDER BY rank, symbol) <= 3")
def rs_topk_by_date(spark, sf):
    return rank.top(scores_of(spark, sf), 3, ["dt"], [F.asc("rank"), F.asc("symbol")]).select("symbol", "dt", "rank")


@query("rs_tail_window", f"WITH {sql.RS} SELECT symbol, dt, round(rs_percentile, 6) AS rs_percentile FROM rs WHERE dt IN (SELECT dt FROM cal ORDER BY dt DESC LIMIT 20)")
def rs_tail_window(spark, sf):
    bars = bars_of(spark, sf)
    dates = panel.calendar(panel.min_history(bars, rs.MIN_DAYS))
    return rounded(panel.tail_dates(rs.individual(bars), 20, dates), "rs_percentile").select("symbol", "dt", "rs_percentile")


@query("group_member_count", f"WITH {sql.DIM} SELECT industry, count(*) AS stock_count FROM dim GROUP BY 1")
def group_member_count(spark, sf):
    return rs.member_count(derived.dim(spark, sf), "industry")


@query("industry_sector_first", f"WITH {sql.DIM} SELECT industry, first(sector ORDER BY symbol) AS sector FROM dim GROUP BY 1")
def industry_sector_first(spark, sf):
    return rs.first_sector(derived.dim(spark, sf))


@query("core_rows", f"WITH {sql.RS} SELECT b.symbol, b.dt, b.close, b.volume, round(rs_percentile, 6) AS rs_percentile FROM bars b LEFT JOIN rs USING (symbol, dt)")
def core_rows(spark, sf):
    bars = bars_of(spark, sf)
    return rounded(publish.core_rows(bars, rs.individual(bars)), "rs_percentile").select("symbol", "dt", "close", "volume", "rs_percentile")


@query("core_documents", f"WITH {sql.RS} SELECT year(b.dt) AS year, b.symbol, name, sector, industry, b.dt, b.close, round(rs_percentile, 6) AS rs_percentile FROM bars b JOIN dim USING (symbol) LEFT JOIN rs ON rs.symbol = b.symbol AND rs.dt = b.dt")
def core_documents(spark, sf):
    bars = bars_of(spark, sf)
    docs = publish.year_documents(publish.core_rows(bars, rs.individual(bars)), derived.dim(spark, sf))
    rows = docs.select("year", "symbol", "name", "sector", "industry", F.explode("data").alias("r"))
    return rounded(rows.select("year", "symbol", "name", "sector", "industry", "r.dt", "r.close", "r.rs_percentile"), "rs_percentile")


@query("min_history", f"WITH {sql.BARS} SELECT symbol, count(close) AS n FROM bars GROUP BY 1 HAVING count(close) >= 290")
def min_history(spark, sf):
    return panel.min_history(bars_of(spark, sf), 290).groupBy("symbol").agg(F.count("close").alias("n"))


@query("union_calendar", f"WITH {sql.BARS} SELECT s.symbol, d.dt, b.close FROM (SELECT DISTINCT symbol FROM bars) s CROSS JOIN (SELECT DISTINCT dt FROM bars) d LEFT JOIN bars b ON b.symbol = s.symbol AND b.dt = d.dt")
def union_calendar(spark, sf):
    return panel.dense(bars_of(spark, sf).select("symbol", "dt", "close"))


@query(
    "pct_change_multi",
    f"WITH {sql.RS} SELECT symbol, dt, round((close / nullif(lag(close, 63) OVER w, 0) - 1) * 100, 6) AS r63, round((close / nullif(lag(close, 252) OVER w, 0) - 1) * 100, 6) AS r252 FROM grid WINDOW w AS (PARTITION BY symbol ORDER BY dt) QUALIFY close IS NOT NULL",
)
def pct_change_multi(spark, sf):
    rows = panel.positioned(panel.min_history(bars_of(spark, sf), rs.MIN_DAYS))
    return rounded(rows.select("symbol", "dt", panel.pct_change("close", 63).alias("r63"), panel.pct_change("close", 252).alias("r252")), "r63", "r252")


@query("latest_bar", f"WITH {sql.BARS} SELECT symbol, dt, close, volume FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY dt DESC) = 1")
def latest_bar(spark, sf):
    return panel.latest(bars_of(spark, sf)).select("symbol", "dt", "close", "volume")


@query(
    "ffill_latest",
    f"WITH {sql.BARS}, holed AS (SELECT symbol, dt, CASE WHEN day(dt) > 7 THEN close END AS close, CASE WHEN month(dt) < 10 THEN volume END AS volume FROM bars) SELECT symbol, last(close ORDER BY dt) FILTER (close IS NOT NULL) AS close, last(volume ORDER BY dt) FILTER (volume IS NOT NULL) AS volume FROM holed GROUP BY 1",
)
def ffill_latest(spark, sf):
    holed = bars_of(spark, sf).select("symbol", "dt", F.when(F.dayofmonth("dt") > 7, F.col("close")).alias("close"), F.when(F.month("dt") < 10, F.col("volume")).alias("volume"))
    return panel.forward_filled_latest(holed, ["close", "volume"])


_W = "OVER (PARTITION BY symbol ORDER BY dt ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"


def _full(f: str, x: str, n: int) -> str:
    w = _W.format(n - 1)
    return f"CASE WHEN count({x}) {w} = {n} THEN {f}({x}) {w} END"


@query("sma", f"WITH {sql.BARS} SELECT symbol, dt, " + ", ".join(f"round({_full('avg', 'close', n)}, 6) AS sma{n}" for n in (20, 50, 200)) + " FROM bars")
def sma(spark, sf):
    out = indicators.with_smas(bars_of(spark, sf))
    return rounded(out.select("symbol", "dt", "sma20", "sma50", "sma200"), "sma20", "sma50", "sma200")


@query(
    "ema",
    f"WITH {sql.BARS}, n AS (SELECT symbol, dt, close, row_number() OVER (PARTITION BY symbol ORDER BY dt) - 1 AS i FROM bars WHERE close IS NOT NULL), "
    "s AS (SELECT *, sum(CASE WHEN i = 0 THEN close ELSE close * (2.0e0 / 22) * power(20.0e0 / 22, -i) END) OVER (PARTITION BY symbol ORDER BY i) AS t FROM n) SELECT symbol, dt, round(t * power(20.0e0 / 22, i), 6) AS ema FROM s",
)
def ema(spark, sf):
    return rounded(indicators.ema(bars_of(spark, sf)).select("symbol", "dt", "ema"), "ema")


@query(
    "rsi",
    f"WITH {sql.BARS}, d AS (SELECT symbol, dt, close - lag(close) OVER (PARTITION BY symbol ORDER BY dt) AS d FROM bars), "
    f"u AS (SELECT symbol, dt, CASE WHEN d > 0 THEN d WHEN d IS NOT NULL THEN 0 END AS up, CASE WHEN d < 0 THEN -d WHEN d IS NOT NULL THEN 0 END AS down FROM d), "
    f"m AS (SELECT symbol, dt, {_full('avg', 'up', 14)} AS g, {_full('avg', 'down', 14)} AS l FROM u) SELECT symbol, dt, round(CASE WHEN g IS NULL THEN NULL WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END, 6) AS rsi FROM m",
)
def rsi(spark, sf):
    return rounded(indicators.rsi(bars_of(spark, sf)).select("symbol", "dt", "rsi"), "rsi")


_TR = f"""{sql.BARS}, p AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY dt) AS pc FROM bars),
t AS (SELECT *, close - pc AS d, greatest(high - low, coalesce(abs(high - pc), 0), coalesce(abs(low - pc), 0)) AS tr FROM p),
a AS (SELECT *, {_full("avg", "tr", 14)} AS atr FROM t)"""


@query("atr", f"WITH {_TR} SELECT symbol, dt, tr, round(atr, 6) AS atr FROM a")
def atr(spark, sf):
    return rounded(indicators.with_atr(bars_of(spark, sf)).select("symbol", "dt", "tr", "atr"), "atr")


@query("atr_extension", f"WITH {_TR} SELECT symbol, dt, round((close - {_full('avg', 'close', 200)}) / nullif(atr, 0), 6) AS atr_extension FROM a")
def atr_extension(spark, sf):
    return rounded(indicators.with_atr_extension(bars_of(spark, sf)).select("symbol", "dt", "atr_extension"), "atr_extension")


@query("vwap", f"WITH {sql.BARS} SELECT symbol, dt, round(sum((high + low + close) / 3 * volume) OVER w / sum(volume) OVER w, 6) AS vwap FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY dt ROWS UNBOUNDED PRECEDING)")
def vwap(spark, sf):
    return rounded(indicators.vwap(bars_of(spark, sf)).select("symbol", "dt", "vwap"), "vwap")


_B_TR = "greatest(high - low, coalesce(abs(high - lag(close) OVER (ORDER BY dt)), 0), coalesce(abs(low - lag(close) OVER (ORDER BY dt)), 0))"


@query(
    "rrs",
    f"WITH {_TR}, ix AS (SELECT dt, avg(high) AS high, avg(low) AS low, avg(close) AS close FROM bars GROUP BY 1), "
    f"ib AS (SELECT dt, close - lag(close) OVER (ORDER BY dt) AS bd, {_B_TR} AS btr FROM ix), "
    "im AS (SELECT dt, bd, CASE WHEN count(btr) OVER w = 14 THEN avg(btr) OVER w END AS batr FROM ib WINDOW w AS (ORDER BY dt ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)), "
    "x AS (SELECT symbol, a.dt, (d - bd * atr / nullif(batr, 0)) / nullif(atr, 0) AS x FROM a JOIN im ON im.dt = a.dt), "
    f"s AS (SELECT symbol, dt, round({_full('sum', 'x', 12)}, 6) AS rrs FROM x) "
    "SELECT symbol, dt, rrs, round((rank() OVER (PARTITION BY dt ORDER BY rrs) + (count(*) OVER (PARTITION BY dt, rrs) - 1) / 2.0e0) / count(*) OVER (PARTITION BY dt) * 98 + 1, 6) AS rrs_percentile FROM s WHERE rrs IS NOT NULL",
)
def rrs(spark, sf):
    bars = bars_of(spark, sf)
    return rounded(indicators.rrs(bars, indicators.benchmark(bars), digits=6), "rrs_percentile")


@query(
    "buying_pressure",
    f"WITH {_TR}, m AS (SELECT symbol, dt, CASE WHEN abs(d) >= atr * 0.3e0 AND d > 0 THEN close * volume ELSE 0 END AS up, CASE WHEN abs(d) >= atr * 0.3e0 AND d < 0 THEN close * volume ELSE 0 END AS down FROM a), "
    f"s AS (SELECT symbol, dt, {_full('sum', 'up', 20)} AS u, {_full('sum', 'down', 20)} AS w FROM m) SELECT symbol, dt, round(CASE WHEN u + w > 0 THEN u / (u + w) END, 6) AS buying_pressure FROM s",
)
def buying_pressure(spark, sf):
    return rounded(indicators.buying_pressure(bars_of(spark, sf)).select("symbol", "dt", "buying_pressure"), "buying_pressure")


@query(
    "day_summary",
    f"WITH {sql.RS}, {sql.group('sector', 'last_row')}, "
    + sql.group("industry", "last_row").replace("weights AS", "w2 AS").replace("JOIN weights", "JOIN w2").replace("means AS", "m2 AS").replace("FROM means", "FROM m2").replace("ranked AS", "r2 AS")
    + " SELECT symbol, rs.dt, sector, industry, round(rs.rs_percentile, 6) AS rs_percentile, round(ranked.rs_percentile, 6) AS sector_rs, round(r2.rs_percentile, 6) AS industry_rs FROM rs JOIN dim USING (symbol) LEFT JOIN ranked USING (sector, dt) LEFT JOIN r2 USING (industry, dt)",
)
def day_summary(spark, sf):
    bars, dim = bars_of(spark, sf), derived.dim(spark, sf)
    scores, weight = rs.individual(bars), rs.weights(bars)
    out = rs.day_summary(scores, dim, rs.group(scores, dim, weight, "sector", 6), rs.group(scores, dim, weight, "industry", 6))
    return rounded(out.select("symbol", "dt", "sector", "industry", "rs_percentile", "sector_rs", "industry_rs"), "rs_percentile", "sector_rs", "industry_rs")


_COVER = f"{sql.RS}, c AS (SELECT b.symbol, year(b.dt) AS year, count(*) AS records, min(b.dt) AS first, max(b.dt) AS last, count(rs_percentile) AS rs_filled, count(volume) AS vol_filled, count(*) < 0.9e0 * 52 AS low FROM bars b LEFT JOIN rs USING (symbol, dt) GROUP BY 1, 2)"


def _covered(spark, sf):
    bars = bars_of(spark, sf)
    return quality.coverage(publish.core_rows(bars, rs.individual(bars)), 52)


@query("coverage_symbol_year", f"WITH {_COVER} SELECT * FROM c")
def coverage_symbol_year(spark, sf):
    return _covered(spark, sf)


@query("coverage_year_avg", f"WITH {_COVER} SELECT year, count(*) AS symbols, round(avg(records), 6) AS avg_records, round(avg(rs_filled), 6) AS avg_rs_filled, count(*) FILTER (low) AS low_symbols FROM c GROUP BY 1")
def coverage_year_avg(spark, sf):
    return rounded(quality.average_coverage(_covered(spark, sf)), "avg_records", "avg_rs_filled")


@query(
    "score_distribution",
    f"WITH {sql.RS} SELECT year(dt) || 'H' || CASE WHEN month(dt) <= 6 THEN 1 ELSE 2 END AS half, round(min(rs_percentile), 6) AS min, round(median(rs_percentile), 6) AS median, round(max(rs_percentile), 6) AS max, count(*) FILTER (rs_percentile NOT BETWEEN 1 AND 99) AS out_of_range FROM rs GROUP BY 1",
)
def score_distribution(spark, sf):
    return rounded(quality.distribution(scores_of(spark, sf)), "min", "median", "max")


@query("metadata_row", f"WITH {sql.RS} SELECT min(dt) AS start_date, max(dt) AS end_date, count(DISTINCT symbol) AS total_symbols, count(DISTINCT dt) AS total_days, 1000::BIGINT AS retention_days FROM rs")
def metadata_row(spark, sf):
    return publish.metadata(scores_of(spark, sf))


@query("failed_symbols", f"WITH {sql.BARS} SELECT s_suppkey AS symbol FROM supplier WHERE s_suppkey NOT IN (SELECT symbol FROM bars WHERE symbol % 5 <> 0)")
def failed_symbols(spark, sf):
    return panel.missing_symbols(derived.dim(spark, sf), bars_of(spark, sf).where("symbol % 5 <> 0"))
