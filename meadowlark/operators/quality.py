"""Coverage, distributions, inventories and checks of fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meadowlark.functions.scalars import prefix_of_key
from meadowlark.operators.publish import starts_with_any

#: Roots that are listed three levels deep, prefixes that should be empty, days a year.
MANAGED = ["stocks", "scores", "metadata", "fundamentals", "market"]
DEPRECATED = ["stocks/daily/indicators/", "scores/RRS_scores/", "stocks/summary/", "scores/BuyPressure/"]
EXPECTED_DAYS, LOW = 251, 0.9


def coverage(rows: DataFrame, expected: int = EXPECTED_DAYS) -> DataFrame:
    """By symbol and year: rows, first and last date, filled scores and volumes, and whether rows are
    fewer than 90 % of what is expected."""
    out = rows.groupBy("symbol", F.year("dt").cast("long").alias("year")).agg(
        F.count("*").alias("records"), F.min("dt").alias("first"), F.max("dt").alias("last"), F.count("rs_percentile").alias("rs_filled"), F.count("volume").alias("vol_filled")
    )
    return out.withColumn("low", F.col("records") < LOW * expected)


def average_coverage(covered: DataFrame) -> DataFrame:
    return covered.groupBy("year").agg(F.count("*").alias("symbols"), F.avg("records").alias("avg_records"), F.avg("rs_filled").alias("avg_rs_filled"), F.count_if("low").alias("low_symbols"))


def distribution(scores: DataFrame, value: str = "rs_percentile") -> DataFrame:
    """By half-year: least, median and largest value, and how many lie outside 1 to 99."""
    half = F.concat(F.year("dt").cast("string"), F.lit("H"), F.when(F.month("dt") <= 6, "1").otherwise("2"))
    return scores.groupBy(half.alias("half")).agg(F.min(value).alias("min"), F.median(value).alias("median"), F.max(value).alias("max"), F.count_if(~F.col(value).between(1, 99)).alias("out_of_range"))


def series_coverage(series: DataFrame, listed: DataFrame) -> DataFrame:
    """First, last and number of rows of each listed series; zero rows too."""
    got = series.groupBy("ticker").agg(F.min("dt").alias("first"), F.max("dt").alias("last"), F.count("*").alias("rows"))
    return listed.join(got, "ticker", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def degraded(series: DataFrame, listed: DataFrame, least: int = 100) -> DataFrame:
    return series_coverage(series, listed).where(F.col("rows") < least).select("ticker", "rows")


def inventory(keys: DataFrame, managed: list[str] = MANAGED) -> DataFrame:
    """Files and bytes by prefix, largest first."""
    return keys.groupBy(prefix_of_key(F.col("key"), managed).alias("prefix")).agg(F.count("*").alias("files"), F.sum("size").alias("bytes")).orderBy(F.desc("bytes"), "prefix")


def deprecated(keys: DataFrame, prefixes: list[str] = DEPRECATED) -> DataFrame:
    """Files under each prefix that should have none."""
    hits = keys.where(starts_with_any(F.col("key"), prefixes))
    which = F.coalesce(*[F.when(F.col("key").startswith(p), p) for p in prefixes])
    return hits.groupBy(which.alias("prefix")).agg(F.count("*").alias("files"))


#: JSON types by the names that Spark gives the schemas of variants (fixed values).
_KINDS = {"VOID": "null", "BOOLEAN": "boolean", "STRING": "string", "BIGINT": "integer", "DOUBLE": "double"}


def kind_of(value: Column) -> Column:
    """The JSON type of a variant: null, boolean, string, integer, double, array or object. A number without a
    fraction is an integer, however it is written (``12.0``): variants hold it as one."""
    name = F.schema_of_variant(value)
    known = F.create_map(*[F.lit(x) for kv in _KINDS.items() for x in kv])
    return F.when(value.isNull(), "null").when(name.startswith("ARRAY<"), "array").when(name.startswith("OBJECT<"), "object").when(name.startswith("DECIMAL("), F.when(name.endswith(",0)"), "integer").otherwise("double")).otherwise(known[name])


def field_types(values: DataFrame, column: str, by: list[str] = ()) -> DataFrame:
    """How often each JSON type occurs in a column of JSON texts; what isn't JSON is ``invalid``. A quoted number is a
    string."""
    v = F.try_parse_json(F.col(column))
    kind = F.when(F.col(column).isNotNull() & v.isNull(), "invalid").otherwise(kind_of(v))
    return values.groupBy(*by, kind.alias("type")).agg(F.count("*").alias("n"))


def document_types(docs: DataFrame, column: str, depth: int = 3) -> DataFrame:
    """(field, type, n): the JSON types of all fields of a column of JSON documents, nested ones by their path
    (``a.b``), down to ``depth`` levels. Fields of objects are rows by ``variant_explode``, level by level, so documents
    needn't have the same fields."""
    level = docs.select(F.lit("").alias("_path"), F.try_parse_json(F.col(column)).alias("_v")).where("_v is not null")
    out = None
    for _ in range(depth):
        fields = level.where(F.schema_of_variant("_v").startswith("OBJECT<")).lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("_v").outer()))
        level = fields.select(F.concat("_path", F.when(F.col("_path") != "", ".").otherwise(""), "key").alias("_path"), F.col("value").alias("_v"))
        counted = level.groupBy(F.col("_path").alias("field"), kind_of(F.col("_v")).alias("type")).agg(F.count("*").alias("n"))
        out = counted if out is None else out.unionByName(counted)
    return out


def invalid_dates(values: DataFrame, column: str) -> DataFrame:
    """Values that aren't written YYYY-MM-DD."""
    return values.where(~F.coalesce(F.col(column).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False)))


def fill_counts(before: DataFrame, after: DataFrame, column: str = "rs_percentile") -> DataFrame:
    """Rows and filled values before and after a merge."""
    one = lambda df, name: df.agg(F.count("*").alias("records"), F.count(column).alias("filled")).withColumn("state", F.lit(name))
    return one(before, "before").unionByName(one(after, "after"))
