"""Streaming counterparts of the batch panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def bars_5min(events: DataFrame, late: str | None = "10 minutes") -> DataFrame:
    """Five-minute bars of a stream of events. A bar is out once the watermark has passed it; events
    that come later still are left out, as in a closed period. ``late`` is None for a stream that has its
    watermark already, as one from ``once`` has."""
    order = F.struct("ts", "event_id", "value")
    marked = events.withWatermark("ts", late) if late else events
    rows = marked.where("value is not null").groupBy(F.window("ts", "5 minutes").alias("w"), F.col("event_type").alias("symbol"))
    bars = rows.agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").alias("n"))
    return bars.select("symbol", F.col("w.start").alias("ts"), "open", "high", "low", "close", "n")


def once(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Events by id, without those that come again within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def append(bars: DataFrame, path: str, checkpoint: str):
    """Writes finished bars as Parquet, exactly once; stops when the input is used up."""
    return bars.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
