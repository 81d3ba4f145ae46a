"""Common table expressions that the oracles share."""

BARS = """bars AS (
  SELECT l_suppkey AS symbol, CAST(date_trunc('week', l_shipdate) AS DATE) AS dt,
         first(l_extendedprice / l_quantity ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity) AS open,
         max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
         last(l_extendedprice / l_quantity ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity) AS close,
         sum(l_quantity) AS volume
  FROM lineitem GROUP BY 1, 2)"""

DIM = """dim AS (
  SELECT s_suppkey AS symbol, s_name AS name, n_name AS industry, r_name AS sector
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_PCT = "(close / nullif(lag(close, {n}) OVER w, 0) - 1) * 100 * {w}"
#: A dense grid of eligible symbols by dates, so that lags count calendar positions.
RS = (
    BARS
    + ", "
    + DIM
    + """,
elig AS (SELECT symbol FROM bars GROUP BY 1 HAVING count(close) >= 252),
cal AS (SELECT DISTINCT dt FROM bars WHERE symbol IN (SELECT symbol FROM elig) AND close IS NOT NULL),
grid AS (SELECT e.symbol, c.dt, b.close FROM elig e CROSS JOIN cal c LEFT JOIN bars b ON b.symbol = e.symbol AND b.dt = c.dt),
raw AS (SELECT symbol, dt, """
    + " + ".join(_PCT.format(n=n, w=w) for n, w in ((63, "0.4e0"), (126, "0.2e0"), (189, "0.2e0"), (252, "0.2e0")))
    + """ AS rs_raw FROM grid WINDOW w AS (PARTITION BY symbol ORDER BY dt)),
rs AS (
  SELECT symbol, dt, (rank() OVER (PARTITION BY dt ORDER BY rs_raw) + (count(*) OVER (PARTITION BY dt, rs_raw) - 1) / 2.0e0)
         / count(*) OVER (PARTITION BY dt) * 98 + 1 AS rs_percentile,
         rank() OVER (PARTITION BY dt ORDER BY rs_raw DESC) AS rank
  FROM raw WHERE rs_raw IS NOT NULL)"""
)

WEIGHTS = {
    "last_row": "weights AS (SELECT symbol, coalesce(close * volume, 1) AS weight FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY dt DESC) = 1)",
    "ffill": """weights AS (SELECT symbol, CASE WHEN c * v > 0 THEN c * v ELSE 1 END AS weight FROM (
  SELECT symbol, last(close ORDER BY dt) FILTER (close IS NOT NULL) AS c, last(volume ORDER BY dt) FILTER (volume IS NOT NULL) AS v FROM bars GROUP BY 1))""",
    "last_valid": "weights AS (SELECT symbol, coalesce(last(close * volume ORDER BY dt) FILTER (close * volume IS NOT NULL), 1) AS weight FROM bars GROUP BY 1)",
}


def group(by: str, weight: str) -> str:
    """Ranked groups; the means are rounded before ranking as in the query."""
    return f"""{WEIGHTS[weight]},
means AS (
  SELECT {by}, dt, round(sum(rs_percentile * weight) / nullif(sum(weight), 0), 6) AS g
  FROM rs JOIN dim USING (symbol) JOIN weights USING (symbol) WHERE {by} NOT IN ('', 'N/A', '-') GROUP BY 1, 2),
ranked AS (
  SELECT {by}, dt, (rank() OVER (PARTITION BY dt ORDER BY g) + (count(*) OVER (PARTITION BY dt, g) - 1) / 2.0e0)
         / count(*) OVER (PARTITION BY dt) * 98 + 1 AS rs_percentile, rank() OVER (PARTITION BY dt ORDER BY g DESC) AS rank
  FROM means WHERE g IS NOT NULL)"""


#: Sectors' weekly prices as macro series.
SERIES = BARS + ", " + DIM + """, series AS (
  SELECT sector AS ticker, dt, sum(close * volume) / sum(volume) AS close, sum(volume) AS volume FROM bars JOIN dim USING (symbol) GROUP BY 1, 2)"""

#: Keys of year documents, and others; what exists already.
KEYS = BARS + """, per AS (SELECT symbol, year(dt) AS year, count(*) * 100 AS size FROM bars GROUP BY 1, 2),
keys AS (
  SELECT 'stocks/daily/core/' || year || '/' || symbol || '.json' AS key, size, symbol % 4 <> 0 AS there FROM per
  UNION ALL SELECT 'scores/RS_scores/sector/' || year || '.json', sum(size), min(year) < 1998 FROM per GROUP BY year),
existing AS (SELECT key, size FROM keys WHERE there)"""
