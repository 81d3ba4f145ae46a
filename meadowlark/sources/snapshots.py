"""Tables of partitioned files behind a manifest: readers see one snapshot, writers replace partitions.

``<base>/data/<write>/<column>=<value>/`` holds files, which are never changed; ``<base>/manifests/<n>.json`` says
which write each partition's files come from. The manifest with the highest number is the table. A writer adds its
files first, then puts the next manifest in place by a rename that fails if that number is there: whoever is
second has to begin again from the newer one, and a job lost before the rename leaves the table as it was."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meadowlark.operators import merge


class Conflict(Exception):
    """Another writer was first."""


@dataclass(frozen=True)
class Snapshot:
    version: int
    by: str
    schema: T.StructType
    parts: dict[str, str]  # partition value -> write


def _files(spark: SparkSession, base: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(base).getFileSystem(spark._jsc.hadoopConfiguration()), path


def current(spark: SparkSession, base: str) -> Snapshot | None:
    """The latest snapshot, or None if nothing has been committed."""
    fs, path = _files(spark, base)
    folder = path(f"{base}/manifests")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    last = max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=None)
    return None if last is None else snapshot(spark, base, last)


def snapshot(spark: SparkSession, base: str, version: int) -> Snapshot:
    text = spark.read.text(f"{base}/manifests/{version:08d}.json", wholetext=True).first()[0]
    told = json.loads(text)
    return Snapshot(version, told["by"], T.StructType.fromJson(told["schema"]), told["parts"])


def read(spark: SparkSession, base: str, version: int | None = None, values: list | None = None) -> DataFrame:
    """The rows of a snapshot (the latest unless ``version`` is given), or of some of its partitions: no others are listed."""
    found = current(spark, base) if version is None else snapshot(spark, base, version)
    if found is None:
        raise FileNotFoundError(f"nothing has been committed to {base}")
    wanted = None if values is None else {str(v) for v in values}
    folders = [f"{base}/data/{write}/{found.by}={value}" for value, write in sorted(found.parts.items()) if wanted is None or value in wanted]
    if not folders:
        return spark.createDataFrame([], found.schema)
    frames = {}
    for f in folders:  # partition columns come from the folders under a write
        frames.setdefault(f.rsplit("/", 1)[0], []).append(f)
    out = None
    for root, own in sorted(frames.items()):
        one = spark.read.schema(found.schema).option("basePath", root).parquet(*own).select(*found.schema.names)
        out = one if out is None else out.unionByName(one)
    return out


def _put(spark: SparkSession, base: str, new: Snapshot) -> None:
    """Writes a manifest under a name of its own and moves it to its place, if that is free."""
    fs, path = _files(spark, base)
    fs.mkdirs(path(f"{base}/manifests"))
    draft, place = path(f"{base}/manifests/.{uuid.uuid4().hex}"), path(f"{base}/manifests/{new.version:08d}.json")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"by": new.by, "schema": new.schema.jsonValue(), "parts": new.parts}).encode()))
    out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if "://" in base else jvm.java.io.File(base).toURI(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, place, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(place):
            raise Conflict(f"version {new.version} of {base} is there") from e
        raise


def replace(spark: SparkSession, base: str, rows: DataFrame, by: str, before: Snapshot | None = None) -> Snapshot:
    """Commits ``rows`` in place of the partitions that they have; others stay, and so do their files. ``before`` is the
    snapshot that ``rows`` were made from (by default the latest): if a later one is there, ``Conflict`` is raised."""
    before = before or current(spark, base)
    if before and before.by != by:
        raise ValueError(f"{base} is partitioned by {before.by}")
    write = uuid.uuid4().hex
    rows.hint("rebalance", by).write.partitionBy(by).parquet(f"{base}/data/{write}")
    fs, path = _files(spark, base)
    names = [s.getPath().getName() for s in fs.listStatus(path(f"{base}/data/{write}")) if s.isDirectory()]
    touched = {n.split("=", 1)[1]: write for n in names if n.startswith(f"{by}=")}
    new = Snapshot(before.version + 1 if before else 1, by, before.schema if before else rows.schema, (before.parts if before else {}) | touched)
    _put(spark, base, new)
    return new


def upsert(spark: SparkSession, base: str, rows: DataFrame, keys: list[str], by: str) -> Snapshot:
    """Rows by key over those that are there; only the partitions that ``rows`` have are read and written. Which those
    are is a list of partition values, the one thing that comes to the driver."""
    before = current(spark, base)
    if before is None:
        return replace(spark, base, rows, by)
    touched = [r[0] for r in rows.select(by).distinct().collect()]
    old = read(spark, base, before.version, touched)
    return replace(spark, base, merge.upsert(old, rows.select(*old.columns), keys), by, before)


def add_missing(spark: SparkSession, base: str, rows: DataFrame, by: str) -> Snapshot:
    """Commits only partitions that aren't there yet: what is published stays as it is."""
    before = current(spark, base)
    there = list(before.parts) if before else []
    return replace(spark, base, rows.where(~F.col(by).cast("string").isin(there)) if there else rows, by, before)
