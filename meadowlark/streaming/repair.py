"""Streams that close periods: bars that stay as they are once closed, late rows that only fill, months that freeze."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meadowlark.streaming import bars

KEYS = ["symbol", "ts"]


def fill_only(path: str, source: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that adds the bars that the table at ``path`` doesn't have. A batch owns the folder
    ``source=.../batch=...`` and writes it anew each time, and compares with all other folders only: a batch that is
    replayed after a failure gives the same table, half-written or not before."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        found = batch.persist()
        try:
            first, last = found.agg(F.min("ts"), F.max("ts")).first()
            own = f"{path}/source={source}/batch={number}"
            if first is None:
                found.limit(0).write.mode("overwrite").parquet(own)
                return
            there = table(spark, path, found.schema.simpleString()[7:-1]).where(F.col("ts").between(F.lit(first), F.lit(last)) & ~((F.col("source") == source) & (F.col("batch") == number)))
            found.join(there.select(*KEYS), KEYS, "left_anti").write.mode("overwrite").parquet(own)
        finally:
            found.unpersist()

    return write


def table(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """The bars at ``path`` with the folder that each came from; none if nothing has been written yet."""
    fields = ", ".join(f"{n} {k}" for n, k in (x.split(":") for x in fields.split(",")))
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], f"{fields}, source string, batch long")
    return spark.read.schema(f"{fields}, source string, batch long").parquet(path)


def run(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over all that is there, batch by batch, and waits for its end."""
    stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def bars_with_repair(events: DataFrame, path: str, checkpoint: str, late: str = "10 minutes") -> None:
    """Five-minute bars at ``path`` of a stream of events that come again and come late.

    The first query takes each event once, closes a bar when the watermark passes it and never changes it. The
    second goes through all events as they came: of what was late, the periods that have no bar yet get one of the
    batch that they came in; bars that are there stay."""
    run(bars.bars_5min(bars.once(events, late), None), fill_only(path, "closed"), f"{checkpoint}/closed")

    def late_bars(batch: DataFrame, number: int) -> None:
        from meadowlark.sources.derived import bars_5min

        fill_only(path, "late")(bars_5min(batch.dropDuplicates(["event_id"])), number)

    run(events, late_bars, f"{checkpoint}/late")


FROZEN = "symbol string, year long, month long, n long, volume double, first timestamp, last timestamp"


def frozen_months(rows: DataFrame, days: int = 60, late: str = "0 days") -> DataFrame:
    """Months of a stream of (symbol, ts, volume), each once, when the watermark lies more than ``days`` days after its
    last day: (symbol, year, month, n, volume, first, last). The state of a month is its sums and a timer for that moment;
    rows of a month that is closed lie behind the watermark and don't count."""
    keyed = rows.withWatermark("ts", late).select("symbol", F.year("ts").cast("long").alias("year"), F.month("ts").cast("long").alias("month"), "ts", F.col("volume").cast("double").alias("volume"))

    def close(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        symbol, year, month = key
        if state.hasTimedOut:
            n, volume, first, last = state.get
            state.remove()
            yield pd.DataFrame([(symbol, year, month, n, volume, pd.Timestamp(first, unit="us"), pd.Timestamp(last, unit="us"))], columns=["symbol", "year", "month", "n", "volume", "first", "last"])
            return
        n, volume, first, last = state.get if state.exists else (0, 0.0, None, None)
        for part in parts:
            at = part["ts"].astype("datetime64[us]").astype("int64")
            n, volume = n + len(part), volume + float(part["volume"].sum())
            first, last = min(int(at.min()), first if first is not None else int(at.min())), max(int(at.max()), last if last is not None else int(at.max()))
        state.update((n, volume, first, last))
        end = dt.datetime(year, month, calendar.monthrange(year, month)[1], tzinfo=dt.timezone.utc) + dt.timedelta(days=days + 1)
        state.setTimeoutTimestamp(max(int(end.timestamp() * 1000) - 1, state.getCurrentWatermarkMs() + 1))

    return keyed.groupBy("symbol", "year", "month").applyInPandasWithState(close, FROZEN, "n long, volume double, first long, last long", "append", GroupStateTimeout.EventTimeTimeout)


def land(rows: DataFrame, path: str, order: str, files: int) -> None:
    """Rows as ``files`` files that a stream reads one by one in the order of their names and times: a file per value
    of ``order`` (0, 1, ...), written one after the other."""
    for i in range(files):
        rows.where(F.col(order) == i).drop(order).coalesce(1).write.mode("append").parquet(path)

