"""Scratch folders that all executors see."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The folders of this process by application, for ``release``.
_MADE: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where none is set (tests)."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="meadowlark-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def file_system(path: str):
    """The file system and the path within it, for any URI that Arrow or Hadoop knows."""
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: worked out once, whatever reads it
    later, and a cut in the lineage that any executor can reread."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Deletes what this application has staged in the shared folder, and returns the number of folders. To be
    called once results are written: DataFrames made from them can't be read after it. What an application
    left that never called it lies there until whoever owns the folder clears it."""
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in made:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(made)
