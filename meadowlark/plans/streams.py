"""Queries that run streams to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from meadowlark.plans.registry import query
from meadowlark.sources.derived import table
from meadowlark.sources.scratch import fresh_path
from meadowlark.streaming import bars, repair

EVENTS = "event_id long, ts timestamp, event_type string, value double"
BARS = "symbol:string,ts:timestamp,open:double,high:double,low:double,close:double,n:bigint"
#: Files that come in time. Two with a beat a day later follow, for what is late is told by the watermark of the batch
#: before; then comes the late one.
FILES = 4

_SPAN = "(epoch_us(ts) // 300000000)"
_ARRIVED = f"""e AS (SELECT event_id, ts, event_type, value, {_SPAN} % 17 = 3 OR event_id % 97 = 5 AS late FROM events WHERE value IS NOT NULL),
g AS (SELECT event_type AS symbol, time_bucket(INTERVAL 5 MINUTE, ts) AS ts, late, first(value ORDER BY e.ts, event_id) AS open, max(value) AS high, min(value) AS low, last(value ORDER BY e.ts, event_id) AS close, count(*) AS n FROM e GROUP BY 1, 2, 3)"""


@query("streamed_bars", f"WITH {_ARRIVED} SELECT symbol, ts, open, high, low, close, n, CASE WHEN late THEN 'late' ELSE 'closed' END AS source FROM g QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY late) = 1")
def streamed_bars(spark, sf):
    """Events come in files in order of time, some twice; some come a month late. Late ones make the bars that are
    missing and leave the others as they were closed."""
    ts = F.col("ts").cast("timestamp")
    rows = table(spark, sf, "events").where("value is not null").select("event_id", ts.alias("ts"), "event_type", "value")
    late = (F.floor(F.unix_micros("ts") / 300000000) % 17 == 3) | (F.col("event_id") % 97 == 5)
    slot = F.least(F.floor((F.dayofmonth("ts") - 1) * FILES / 31), F.lit(FILES - 1)).cast("int")
    came = rows.withColumn("file", F.when(late, FILES + 2).otherwise(slot))
    again = came.where((F.col("event_id") % 13 == 0) & (F.col("file") < FILES))  # comes twice
    beats = F.explode(F.array(*[F.struct(F.lit(-1 - i).cast("long").alias("event_id"), F.lit(FILES + i).alias("file")) for i in (0, 1)]))
    end = rows.agg((F.max("ts") + F.expr("interval 1 day")).alias("ts")).select(beats.alias("b"), "ts", F.lit("end").alias("event_type"), F.lit(0.0).alias("value")).select("b.event_id", "ts", "event_type", "value", "b.file")
    source, path = fresh_path(spark, "events"), fresh_path(spark, "bars")
    repair.land(came.unionByName(again).unionByName(end), source, "file", FILES + 3)
    repair.bars_with_repair(bars.events(spark, source, EVENTS), path, fresh_path(spark, "checkpoint"))
    out = repair.table(spark, path, BARS).where("symbol <> 'end'")
    return out.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), "open", "high", "low", "close", "n", "source")


@query(
    "frozen_months",
    "WITH r AS (SELECT n_name AS symbol, l_shipdate AS ts, l_quantity AS volume FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey), m AS (SELECT CAST(max(ts) AS DATE) AS today FROM r) "
    "SELECT symbol, year(ts) AS year, month(ts) AS month, count(*) AS n, sum(volume) AS volume, min(ts) AS first, max(ts) AS last FROM r GROUP BY 1, 2, 3 HAVING date_diff('day', last_day(min(ts)), (SELECT today FROM m)) > 60",
)
def frozen_months(spark, sf):
    """Line items by nation come in files by year; each month is out once, when the stream is 61 days past it."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    names = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", F.col("n_name").alias("symbol"))
    items = table(spark, sf, "lineitem").join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = items.select("symbol", F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_quantity").alias("volume"), (F.year("l_shipdate") - 1995).alias("file"))
    source, path = fresh_path(spark, "items"), fresh_path(spark, "months")
    repair.land(rows, source, "file", 7)
    stream = spark.readStream.schema("symbol string, ts timestamp, volume double").option("maxFilesPerTrigger", 1).parquet(source)
    repair.run(repair.frozen_months(stream), lambda df, i: df.write.mode("overwrite").parquet(f"{path}/batch={i}"), fresh_path(spark, "checkpoint"))
    out = spark.read.schema(repair.FROZEN).parquet(path)
    return out.select("symbol", "year", "month", "n", "volume", F.col("first").cast("timestamp_ntz").alias("first"), F.col("last").cast("timestamp_ntz").alias("last"))
