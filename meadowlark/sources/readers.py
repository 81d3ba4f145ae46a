"""Readers for files that land from vendors: CSV, JSON and listings of keys."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meadowlark import schemas

#: Era letter and what turns its years into Gregorian ones (fixed values).
ERAS = {"S": 1925, "H": 1988, "R": 2018}


def first_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (deterministic, unlike dropDuplicates)."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with a header, a possible UTF-8 mark, and no inference: ``NA`` and ``N/A`` stay text."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


def with_line(df: DataFrame) -> DataFrame:
    """Adds ``line``: the order of rows within files as they are read."""
    return df.select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("line"))


def universe(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, name, sector, industry); of rows with the same symbol the last in the file counts."""
    rows = with_line(csv(spark, path, schemas.UNIVERSE))
    named = rows.select(F.col("Symbol").alias("symbol"), F.coalesce("Company Name", "Symbol").alias("name"), F.coalesce("Sector", F.lit("N/A")).alias("sector"), F.coalesce("Industry", F.lit("N/A")).alias("industry"), "line")
    return first_rows(named.where("symbol is not null"), ["symbol"], [F.desc("line")]).drop("line")


def universe_jp(spark: SparkSession, path: str, dedup: bool = True) -> DataFrame:
    """The same of the Japanese list: symbols are text, trimmed; blanks go, and of equal symbols the
    first counts (unless ``dedup`` is off)."""
    rows = with_line(csv(spark, path, schemas.UNIVERSE_JP))
    named = rows.select(F.trim("Symbol").alias("symbol"), F.coalesce("Company Name", "Symbol").alias("name"), F.coalesce("Sector", F.lit("N/A")).alias("sector"), F.coalesce("Industry", F.lit("N/A")).alias("industry"), "Market", "Size", "line")
    named = named.where("symbol <> ''")
    return first_rows(named, ["symbol"], [F.asc("line")]) if dedup else named


def symbols(universe: DataFrame, distinct: bool = True) -> DataFrame:
    """The symbols, sorted and distinct, or as they come."""
    out = universe.select("symbol").where("symbol is not null")
    return out.distinct().orderBy("symbol") if distinct else out


def nested_panel(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Bars from a document of symbols, each with an array of rows; or (``lines``) from a document a line."""
    docs = spark.read.schema(schemas.NESTED_PANEL).option("multiLine", not lines).json(path)
    per = docs.select(F.explode("symbols").alias("symbol", "doc"))
    return per.select("symbol", "doc.name", "doc.sector", "doc.industry", F.explode("doc.data").alias("r")).select("symbol", "name", "sector", "industry", F.col("r.date").alias("dt"), "r.open", "r.high", "r.low", "r.close", "r.volume")


def core_docs(spark: SparkSession, base: str, years: list[int] | None = None) -> DataFrame:
    """Rows of core documents under ``base/year=.../``; only the years asked for are listed and read,
    and years or symbols that aren't there give no rows."""
    docs = spark.read.schema(schemas.CORE_DOC + ", year int").json(base)
    docs = docs.where(F.col("year").isin(years)) if years else docs
    return docs.select("year", F.col("ticker").alias("symbol"), "name", "sector", "industry", F.explode("data").alias("r")).select("year", "symbol", "name", "sector", "industry", F.col("r.date").alias("dt"), "r.open", "r.high", "r.low", "r.close", "r.volume", "r.rs_percentile")


def json_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed JSON records (statements, estimates, profiles, screener rows) with an explicit schema."""
    return spark.read.schema(schema).json(path)


def shares_float(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: the first element of its array of records."""
    whole = spark.read.schema("value string").text(path, wholetext=True)
    rows = F.from_json("value", f"array<struct<{', '.join(f'{n}: {k}' for n, k in (x.split() for x in schemas.FLOAT.split(', ')))}>>")
    return whole.select(F.try_element_at(rows, F.lit(1)).alias("r")).where("r is not null").select("r.*")


def market_series(spark: SparkSession, path: str) -> DataFrame:
    """(ticker, dt, o, h, l, c, volume) of a document ticker -> date -> bar; a volume of 0 is missing."""
    docs = spark.read.schema(schemas.MARKET_SERIES).option("multiLine", True).json(path)
    days = docs.select(F.explode("data").alias("ticker", "days")).select("ticker", F.explode("days").alias("day", "bar"))
    return days.select("ticker", F.to_date("day").alias("dt"), "bar.open", "bar.high", "bar.low", "bar.close", F.nullif("bar.volume", F.lit(0)).alias("volume"))


def era_date(text: Column) -> Column:
    """``S49.9.24`` as a date; what isn't an era date is null."""
    part = lambda i: F.regexp_extract(text, r"^([SHR])(\d+)\.(\d+)\.(\d+)$", i)
    offset = F.create_map(*[F.lit(x) for kv in ERAS.items() for x in kv])
    number = lambda i: F.when(part(1) != "", part(i).cast("int"))
    return F.when(part(1) != "", F.try_make_timestamp(number(2) + F.try_element_at(offset, part(1)), number(3), number(4), F.lit(0), F.lit(0), F.lit(0)).cast("date"))


@contextmanager
def any_charset(spark: SparkSession) -> Iterator[None]:
    """Lets expressions and writers made here use all of Java's charsets; Spark's own list lacks Shift-JIS."""
    name = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def government_bonds(spark: SparkSession, path: str, tenor: str = "10年") -> DataFrame:
    """(dt, yield) of one tenor from the ministry's CSV: Shift-JIS, a title line, a header, era dates,
    ``-`` for missing. Files are small and read whole, so that the header names the column."""
    with any_charset(spark):
        whole = spark.read.format("binaryFile").load(path).select(F.decode("content", "windows-31j").alias("text"))
    lines = whole.select(F.split("text", r"\r?\n").alias("lines"))
    place = F.array_position(F.split(F.col("lines")[1], ","), tenor)
    rows = lines.select(place.alias("place"), F.explode(F.slice("lines", F.lit(3), F.greatest(F.size("lines") - 2, F.lit(0)))).alias("line"))
    cells = rows.where("place > 0").select("place", F.split("line", ",").alias("cells"))
    picked = cells.select(era_date(F.trim(F.col("cells")[0])).alias("dt"), F.expr("try_cast(trim(try_element_at(cells, cast(place as int))) as double)").alias("yield"))
    return picked.where("dt is not null and `yield` is not null")


def keys(spark: SparkSession, base: str) -> DataFrame:
    """(key, size) of the files under ``base``, however deep; file contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    return found.select(F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), F.concat(F.lit("^.*"), F.lit(base.rstrip("/").rsplit("/", 1)[-1]), F.lit("/")), "").alias("key"), F.col("length").alias("size"))


def date_chunks(ranges: DataFrame, days: int = 55) -> DataFrame:
    """(chunk_start, chunk_end) beside the other columns: each row's range of dates (``start``, ``end``) cut for a source
    that serves ``days`` days at a time. A row without a range has no chunks."""
    there = ranges.where("start <= end")
    starts = there.withColumn("chunk_start", F.explode(F.expr(f"sequence(start, `end`, interval {days + 1} days)")))
    return starts.withColumn("chunk_end", F.least(F.date_add("chunk_start", days), F.col("end"))).drop("start", "end")


def market_year(spark: SparkSession, path: str) -> DataFrame:
    """(year, ticker, dt, o, h, l, c, volume) of year documents date -> ticker -> bar."""
    docs = spark.read.schema(schemas.MARKET_YEAR).option("multiLine", True).json(path)
    days = docs.select("year", F.explode("data").alias("day", "bars")).select("year", "day", F.explode("bars").alias("ticker", "bar"))
    return days.select("year", "ticker", F.to_date("day").alias("dt"), "bar.open", "bar.high", "bar.low", "bar.close", "bar.volume")


def children(keys: DataFrame, prefix: str) -> DataFrame:
    """The distinct names right under a prefix (years, say)."""
    rest = F.substr("key", F.lit(len(prefix) + 1))
    return keys.where(F.col("key").startswith(prefix)).select(F.split(rest, "/")[0].alias("child")).distinct()


def years_by_symbol(keys: DataFrame) -> DataFrame:
    """(symbol, years): which year documents each symbol has, from one pass over the keys."""
    from meadowlark.functions.scalars import year_of_key

    symbol = F.regexp_extract("key", r"([^/]+)\.json$", 1)
    return keys.select(symbol.alias("symbol"), year_of_key(F.col("key")).alias("year")).where("symbol <> '' and year is not null").groupBy("symbol").agg(F.array_sort(F.collect_set("year")).alias("years"))


def read_or_build(read, build) -> DataFrame:
    """What is there already, else what ``build`` makes of it: a stage that a rerun takes up again. Only a path or a table
    that isn't there leads to ``build``; any other error stays one."""
    from pyspark.errors import AnalysisException

    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            raise
        return build()


def unique_bars(bars: DataFrame, order: str) -> DataFrame:
    """One bar per symbol and time; of repeats the first by ``order``."""
    return first_rows(bars, ["symbol", "ts"], [F.asc(order)])
