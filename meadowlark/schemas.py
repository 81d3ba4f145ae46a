"""Explicit schemas; a field that a source lacks reads as null."""

from __future__ import annotations

OHLC = "open double, high double, low double, close double"
UNIVERSE = "`Symbol` string, `Company Name` string, `Sector` string, `Industry` string, `Price` double, `Market_Cap` double, `IPO_Date` string, `Exchange` string"
UNIVERSE_JP = "`Symbol` string, `Company Name` string, `Sector` string, `Industry` string, `Market` string, `Size` string, `Exchange` string"
SCREENER = "symbol string, name string, exchangeShortName string, price double"
PROFILE = "symbol string, isActivelyTrading boolean, companyName string, exchange string, ipoDate string, sector string, industry string, marketCap double"
BARS = f"symbol string, dt date, {OHLC}, volume long"
BARS_INTRADAY = f"symbol string, ts timestamp, {OHLC}, volume long"
INCOME = "symbol string, date date, eps double, epsDiluted double, revenue double, netIncome double"
CASH_FLOW = "symbol string, date date, freeCashFlow double, operatingCashFlow double"
BALANCE = "symbol string, date date, stockholdersEquity double"
METRICS = "symbol string, date date, roic double"
RATIOS = "symbol string, date date, bookValuePerShare double"
EARNINGS = "symbol string, date date, epsActual double, epsEstimated double, revenueActual double, revenueEstimated double"
ESTIMATE_FIELDS = [f"{m}{b}" for m in ("revenue", "ebitda", "netIncome", "eps") for b in ("Low", "High", "Avg")]
ESTIMATES = "symbol string, date date, " + ", ".join(f"{f} double" for f in ESTIMATE_FIELDS) + ", numAnalystsRevenue long, numAnalystsEps long"
FLOAT = "ticker string, date string, freeFloat double, floatShares double, outstandingShares double, source string, lastUpdated string"
RATES = "date date, year2 double, year10 double, year30 double"
KEYS = "key string, size long"

_ROW = f"date: date, {OHLC.replace(' double', ': double')}, volume: bigint"
CORE_DOC = f"ticker string, name string, sector string, industry string, data array<struct<{_ROW}, rs_percentile: double>>"
NESTED_PANEL = f"lastUpdated string, symbols map<string, struct<name: string, sector: string, industry: string, data: array<struct<{_ROW}>>>>"
_BAR = f"struct<{OHLC.replace(' double', ': double')}, volume: bigint>"
MARKET_YEAR = f"year int, adjust string, tickers array<string>, data map<string, map<string, {_BAR}>>"
MARKET_SERIES = f"series map<string, struct<name: string, use: string, source: string>>, data map<string, map<string, {_BAR}>>"
SCORES = "date date, ticker string, name string, sector string, industry string, rs_percentile double, rank long"
