"""Which symbols count: predicates on names and listings, and rows that are always in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of names that mark what isn't common stock, words of delisted names, exchanges.
NOT_COMMON = ["ETF", "FUND", "TRUST", "INDEX", "REIT", "UNIT", "WARRANT", "RIGHT", "ACQUISITION", "SPAC", "PREFERRED", "NOTE", "BOND", "BULL", "BEAR", "2X", "3X", "LEVERAGE", "DIREXION", "PROSHARES", "ULTRA", "INVERSE"]
DELISTED = ["OLD", "DELISTED", "DEFUNCT", "BANKRUPTCY", "LIQUIDATION"]
EXCHANGES = ["NYSE", "NASDAQ"]
#: Segments of domestic shares and their short names.
SEGMENTS = {"プライム（内国株式）": "Prime", "スタンダード（内国株式）": "Standard", "グロース（内国株式）": "Growth"}
IPO_DAYS = 730

#: Symbols that are always in, with names; their sector and industry are N/A.
GUARANTEED = {
    "^GSPC": "S&P 500",
    "^IXIC": "NASDAQ Composite",
    "^DJI": "Dow Jones Industrial Average",
    "^RUT": "Russell 2000",
    "SPY": "SPDR S&P 500 ETF",
    "QQQ": "Invesco QQQ Trust (NASDAQ100)",
    "DIA": "SPDR Dow Jones Industrial Average ETF",
    "IWM": "iShares Russell 2000 ETF",
    "SMH": "VanEck Semiconductor ETF",
    "SOXX": "iShares Semiconductor ETF",
    "XLK": "Technology Select Sector SPDR",
    "XLF": "Financial Select Sector SPDR",
    "XLV": "Health Care Select Sector SPDR",
    "XLE": "Energy Select Sector SPDR",
    "XLI": "Industrial Select Sector SPDR",
    "XLY": "Consumer Discretionary Select Sector SPDR",
    "XLP": "Consumer Staples Select Sector SPDR",
    "XLU": "Utilities Select Sector SPDR",
    "XLB": "Materials Select Sector SPDR",
    "XLRE": "Real Estate Select Sector SPDR",
    "XLC": "Communication Services Select Sector SPDR",
}
GUARANTEED_JP = {"1306": "NEXT FUNDS TOPIX Exchange Traded Fund", "^N225": "Nikkei 225"}


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | text.contains(p)
    return out


def common_stock(symbol: Column, name: Column, excluded: Sequence[str] = NOT_COMMON) -> Column:
    """One to five letters, no digit, dot, dash, slash or space; of five letters not ending in U, W, R or
    X; no excluded part anywhere in the name (BRIGHT has RIGHT)."""
    s = F.upper(symbol)
    plain = F.length(s).between(1, 5) & ~s.rlike(r"[.\-/ \p{Nd}]")
    return F.coalesce(plain & ~((F.length(s) == 5) & s.rlike("[UWRX]$")) & ~contains_any(F.upper(F.coalesce(name, F.lit(""))), excluded), F.lit(False))


def old_ipo(ipo: Column, as_of: Column, days: int = IPO_DAYS) -> Column:
    """Listed at least ``days`` before; false where the date is missing or isn't one."""
    date = ipo if not isinstance(ipo, str) else F.col(ipo)
    return F.coalesce(F.try_to_date(date.cast("string"), "yyyy-MM-dd") <= F.date_sub(as_of, days), F.lit(False))


def has_price(price: Column) -> Column:
    return F.coalesce(price > 0, F.lit(False))


def not_delisted(name: Column, words: Sequence[str] = DELISTED) -> Column:
    return ~F.upper(F.coalesce(name, F.lit(""))).rlike(rf"\b({'|'.join(words)})\b")


def active_profiles(profiles: DataFrame) -> DataFrame:
    """Profiles that trade (missing counts as trading), aren't delisted by name, and are on an allowed
    exchange."""
    return profiles.where(F.coalesce("isActivelyTrading", F.lit(True)) & not_delisted(F.col("companyName")) & F.col("exchange").isin(*EXCHANGES))


def select(stocks: DataFrame, profiles: DataFrame, as_of: str, guaranteed: Sequence[str] = tuple(GUARANTEED)) -> DataFrame:
    """The universe: screened stocks with a price and a profile, common stock listed two years ago, or
    guaranteed."""
    always = F.col("symbol").isin(*guaranteed)
    passed = stocks.where((always | common_stock(F.col("symbol"), F.col("name"))) & has_price(F.col("price")))
    both = passed.join(active_profiles(profiles), "symbol").where(always | old_ipo(F.col("ipoDate"), F.lit(as_of).cast("date")))
    return both.select("symbol", F.col("companyName").alias("name"), "sector", "industry", "price", F.coalesce("marketCap", F.lit(0.0)).alias("market_cap"), F.col("ipoDate").alias("ipo_date"), "exchange")


def guaranteed(spark: SparkSession, names: dict[str, str] = GUARANTEED) -> DataFrame:
    return spark.createDataFrame([(s, n, "N/A", "N/A") for s, n in names.items()], "symbol string, name string, sector string, industry string")


def inject(universe: DataFrame, rows: DataFrame) -> DataFrame:
    """The universe with ``rows`` in place of its own rows of the same symbols; columns that they lack are null."""
    return universe.join(rows.select("symbol"), "symbol", "left_anti").unionByName(rows, allowMissingColumns=True)


def without(universe: DataFrame, symbols: Sequence) -> DataFrame:
    """The universe without some symbols; rows without a symbol stay."""
    return universe.where(~F.coalesce(F.col("symbol").isin(*symbols), F.lit(False)))


def classified(listing: DataFrame) -> DataFrame:
    """Domestic shares of the three segments, with the segment's short name, without unclassified ones,
    one row per symbol."""
    from meadowlark.sources.readers import first_rows

    label = F.create_map(*[F.lit(x) for kv in SEGMENTS.items() for x in kv])
    kept = listing.where(F.col("segment").isin(*SEGMENTS) & (F.col("sector") != "-") & (F.col("industry") != "-"))
    return first_rows(kept.withColumn("market", label[F.col("segment")]), ["symbol"], [F.asc("line")])


def value_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values; ties by value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def known_only(all_names: Sequence[str], only: Sequence[str] | None) -> list[str]:
    """The names asked for, in their order; an unknown one is an error."""
    unknown = sorted(set(only or []) - set(all_names))
    if unknown:
        raise ValueError(f"unknown names: {', '.join(unknown)}")
    return [n for n in all_names if only is None or n in only]
