"""Queries over records as vendors land them, snapshots, and stages that a rerun takes up again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meadowlark import schemas
from meadowlark.operators import fundamentals, publish, universe
from meadowlark.plans.facts import _QUARTERS, PRIORITIES, quarterly
from meadowlark.plans.files import UNIVERSE_SQL, universe_sources
from meadowlark.plans.prices import rounded
from meadowlark.plans.registry import query
from meadowlark.sources import readers
from meadowlark.sources.derived import table
from meadowlark.sources.scratch import fresh_path, staged

#: Each statement's schema and the fields that are landed in it, by the priority whose sums they are.
STATEMENTS = {
    "income": (schemas.INCOME, {"revenue": 0, "netIncome": 1}),
    "cash-flow": (schemas.CASH_FLOW, {"freeCashFlow": 2}),
    "balance": (schemas.BALANCE, {"stockholdersEquity": 3}),
    "metrics": (schemas.METRICS, {"roic": 4}),
    "ratios": (schemas.RATIOS, {"bookValuePerShare": 0}),
    "earnings": (schemas.EARNINGS, {"epsActual": 1, "epsEstimated": 2}),
}


def land_statements(rows: DataFrame, base: str) -> None:
    """A folder of JSON a statement, with a field that nobody reads; a quarter that lacks a field lands without it."""
    wide = rows.groupBy(F.col("symbol").cast("string").alias("symbol"), "date").pivot("o_orderpriority", PRIORITIES).agg(F.first("v"))
    for name, (_, fields) in STATEMENTS.items():
        values = [F.col(f"`{PRIORITIES[i]}`").alias(f) for f, i in fields.items()]
        there = F.coalesce(*values).isNotNull()
        wide.where(there).select("symbol", "date", *values, F.lit("vendor").alias("link")).write.json(f"{base}/{name}")


@query(
    "landed_statements",
    f"WITH {_QUARTERS}, w AS (SELECT symbol, date, {', '.join(f"max(v) FILTER (p = '{p}') AS p{i}" for i, p in enumerate(PRIORITIES))} FROM src GROUP BY 1, 2) "
    "SELECT symbol::VARCHAR AS symbol, date, p0 AS revenue, p1 AS netIncome, p2 AS freeCashFlow, p3 AS stockholdersEquity, p4 AS roic, p0 AS bookValuePerShare, p1 AS epsActual, p2 AS epsEstimated, "
    "round(p1 / nullif(p3, 0) * 400, 6) AS roe, round((p1 - p2) / abs(nullif(p2, 0)) * 100, 6) AS surprise FROM w WHERE coalesce(p0, p1) IS NOT NULL AND p2 IS NOT NULL AND p3 IS NOT NULL AND p4 IS NOT NULL AND p0 IS NOT NULL AND coalesce(p1, p2) IS NOT NULL AND date >= DATE '1996-01-01'",
)
def landed_statements(spark, sf):
    """Six statements landed and read back by their schemas, joined by symbol and quarter, with ratios."""
    base = fresh_path(spark, "statements")
    land_statements(staged(quarterly(spark, sf), "quarters"), base)
    read = {name: readers.json_table(spark, f"{base}/{name}", schema) for name, (schema, _) in STATEMENTS.items()}
    kept = [fundamentals.last_per_key(df.select("symbol", "date", *STATEMENTS[n][1]), ["symbol", "date"], ["date"]) for n, df in read.items()]
    out = fundamentals.merged(kept, ["symbol", "date"], "1996-01-01")
    roe = fundamentals.roe_quarterly(F.col("netIncome"), F.col("stockholdersEquity")) * 4
    return rounded(out.withColumns({"roe": roe, "surprise": fundamentals.surprise_pct(F.col("epsActual"), F.col("epsEstimated"))}), "roe", "surprise")


@query("landed_universe", UNIVERSE_SQL)
def landed_universe(spark, sf):
    """The screener's and the profiles' records as JSON, with fields that aren't asked for and some that are missing."""
    stocks, profiles = universe_sources(spark, sf)
    base = fresh_path(spark, "records")
    stocks.withColumn("beta", F.lit(1.5)).write.json(f"{base}/screener")
    profiles.withColumn("ceo", F.lit("x")).write.json(f"{base}/profiles")
    return universe.select(readers.json_table(spark, f"{base}/screener", schemas.SCREENER), readers.json_table(spark, f"{base}/profiles", schemas.PROFILE), "1998-01-01", ("QB", "QUA"))


@query("universe_snapshot", "SELECT p_partkey::VARCHAR AS symbol, p_name AS name, CASE WHEN p_size % 9 <> 0 THEN p_type ELSE 'N/A' END AS sector, p_retailprice AS price FROM part WHERE p_size <> 1")
def universe_snapshot(spark, sf):
    """A CSV with a header, written over an older one, and a Parquet copy of what it reads as."""
    path = fresh_path(spark, "universe")
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("Symbol"), F.col("p_name").alias("Company Name"), F.when(F.col("p_size") % 9 != 0, F.col("p_type")).alias("Sector"), F.lit("x").alias("Industry"), F.col("p_retailprice").alias("Price"), "p_size")
    publish.write_snapshot(rows.where("p_size = 1").drop("p_size"), f"{path}/latest", "csv")
    publish.write_snapshot(rows.where("p_size <> 1").drop("p_size"), f"{path}/latest", "csv")
    publish.write_snapshot(readers.csv(spark, f"{path}/latest", schemas.UNIVERSE).withColumnsRenamed({"Company Name": "name"}), f"{path}/copy")
    out = spark.read.parquet(f"{path}/copy")
    return out.select(F.col("Symbol").alias("symbol"), "name", F.coalesce("Sector", F.lit("N/A")).alias("sector"), F.col("Price").alias("price"))


@query("resumed_stage", "SELECT o_custkey AS symbol, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1")
def resumed_stage(spark, sf):
    """A list that is built as its file isn't there, and read as it is; all of it counts, repeats too."""
    path = fresh_path(spark, "stage")
    build = lambda: readers.symbols(table(spark, sf, "orders").select(F.col("o_custkey").alias("symbol")), distinct=False)
    readers.read_or_build(lambda: spark.read.schema("symbol long").parquet(path), build).write.parquet(path)
    again = readers.read_or_build(lambda: spark.read.schema("symbol long").parquet(path), lambda: build().limit(0))
    return again.groupBy("symbol").agg(F.count("*").alias("n"))


@query("chosen_series", "SELECT r_name AS ticker, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY 1")
def chosen_series(spark, sf):
    """Some of the listed series by name; a name that isn't listed would be an error."""
    r, n = table(spark, sf, "region"), table(spark, sf, "nation")
    listed = [x.r_name for x in r.select("r_name").collect()]  # the list of series, a handful
    names = universe.known_only(listed, ["EUROPE", "ASIA"])
    return r.where(F.col("r_name").isin(names)).join(n, n.n_regionkey == r.r_regionkey).groupBy(F.col("r_name").alias("ticker")).agg(F.count("*").alias("nations"))
