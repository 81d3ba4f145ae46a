"""The Spark session the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC keeps dates and wall-clock conversions explicit; adaptive execution sizes and splits partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build(app: str = "meadowlark", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | extra)
    return (builder.master(master) if master else builder).getOrCreate()
