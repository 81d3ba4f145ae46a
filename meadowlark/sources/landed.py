"""Landed vendor files as one source: partitions by chunk of symbols and range of dates, dates pushed down, retries.

Vendors serve so many symbols and so many days at a time; their answers land as Parquet files under
``from=<first date of the range>/chunk=<number>/``. A request's answer is small, so where a range has many, neighbours
share a folder, named by the first of them: folders don't grow in number with the symbols, until they are large.
``spark.read.format("landed")`` plans one partition for each file folder that a query can need, or for some of them
if they are many: date filters are pushed to the ranges, symbol filters to the chunks, and folders
that they rule out are neither planned nor opened. A folder that can't be read is tried again; one that isn't there
after all gives no rows, so that ``missing`` symbols show up as such."""

from __future__ import annotations

import datetime as dt
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from meadowlark import schemas
from meadowlark.operators import rank
from meadowlark.sources.scratch import file_system

#: Symbols of a request, days of a request, tries and the seconds between them.
CHUNK, DAYS, TRIES, WAIT = 50, 56, 3, 0.5
#: Folders of a range before requests share them, rows that a shared folder may have (a row a symbol and day), and
#: partitions before folders share them.
SPREAD, ROWS, TASKS = 16, 1 << 20, 128
FIELDS = schemas.BARS


@dataclass
class Folder(InputPartition):
    """A folder of answers, and the dates it covers; where folders are many, the others that are read with it."""

    path: str
    start: dt.date
    stop: dt.date  # the day after
    others: tuple[str, ...] = ()


def land(bars: DataFrame, path: str, days: int = DAYS, chunk: int = CHUNK, start: str = "1970-01-01") -> None:
    """Writes bars as a vendor's answers: symbols numbered in order, ``chunk`` of them to a request, ``days`` days each."""
    numbers = rank.numbered(bars.select("symbol").distinct(), [F.asc("symbol")], "_n")
    requests = -(-numbers.count() // chunk)
    shared = max(1, min(-(-requests // SPREAD), ROWS // (chunk * days)))
    folder = F.floor((F.col("_n") - 1) / (chunk * shared)) * shared
    begin = F.lit(start).cast("date")
    since = F.floor(F.datediff("dt", begin) / days) * days
    rows = bars.join(numbers, "symbol").withColumns({"from": F.date_add(begin, since.cast("int")), "chunk": folder})
    rows.drop("_n").hint("rebalance", "from", "chunk").sortWithinPartitions("from", "chunk", "symbol", "dt").write.partitionBy("from", "chunk").parquet(path)
    # which folder each symbol's chunk is in: a row a symbol, as the request list
    numbers.select("symbol", folder.alias("chunk")).write.parquet(f"{path}/_requests")


class LandedReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path, self.days, self.tries, self.wait, self.tasks = options["path"], int(options.get("days", DAYS)), int(options.get("tries", TRIES)), float(options.get("wait", WAIT)), int(options.get("tasks", TASKS))
        self.fields = [f.name for f in schema.fields]
        self.first, self.last = dt.date.min, dt.date.max
        self.symbols: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes bounds of dates and lists of symbols to plan by; Spark checks all filters on the rows again."""
        for f in filters:
            name, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if name == ("dt",) and isinstance(value, dt.date):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.first = max(self.first, value)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.last = min(self.last, value)
            if name == ("symbol",) and isinstance(f, (EqualTo, In)):
                asked = {value} if isinstance(f, EqualTo) else set(value)
                self.symbols = asked if self.symbols is None else self.symbols & asked
            yield f

    def partitions(self) -> list[Folder]:
        """The folders that the filters leave, by their names alone."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        place, base = file_system(self.path)
        chunks = None
        if self.symbols is not None:
            told = pq.read_table(f"{base}/_requests", filesystem=place, filters=[("symbol", "in", sorted(self.symbols))]) if self.symbols else None
            chunks = {str(c) for c in told.column("chunk").to_pylist()} if told else set()
        out = []
        for found in place.get_file_info(fs.FileSelector(base)):
            m = re.fullmatch(r"from=(\d{4}-\d{2}-\d{2})", found.base_name)
            if not m:
                continue
            start = dt.date.fromisoformat(m.group(1))
            stop = start + dt.timedelta(days=self.days)
            if stop <= self.first or start > self.last:
                continue
            for own in place.get_file_info(fs.FileSelector(found.path)):
                n = re.fullmatch(r"chunk=(\d+)", own.base_name)
                if n and (chunks is None or n.group(1) in chunks):
                    out.append(Folder(f"{self.path}/{found.base_name}/{own.base_name}", start, stop))
        out.sort(key=lambda p: p.path)
        step = -(-len(out) // self.tasks) or 1
        runs = [out[i : i + step] for i in range(0, len(out), step)]
        return [Folder(r[0].path, r[0].start, r[-1].stop, tuple(p.path for p in r[1:])) for r in runs]

    def wanted(self) -> list[tuple] | None:
        """What the pushed filters say of rows: those they rule out needn't leave the worker."""
        tests: list[tuple] = [] if self.symbols is None else [("symbol", "in", sorted(self.symbols))]
        tests += [("dt", op, day) for op, day, any_day in ((">=", self.first, dt.date.min), ("<=", self.last, dt.date.max)) if day != any_day]
        return tests or None

    def read(self, partition: Folder | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # how Spark asks for no partitions at all
            return
        for path in (partition.path, *partition.others):
            yield from self.answers(path)

    def answers(self, path: str) -> list[pa.RecordBatch]:
        """A folder's rows."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        for tried in range(self.tries):
            try:
                place, base = file_system(path)
                files = [f.path for f in place.get_file_info(fs.FileSelector(base, allow_not_found=True)) if f.base_name.endswith(".parquet")]
                return [b for f in files for b in pq.read_table(f, filesystem=place, columns=self.fields, partitioning=None, filters=self.wanted()).to_batches()]
            except OSError:
                if tried + 1 == self.tries:
                    raise
                time.sleep(self.wait * 2**tried)
        return []


class Landed(DataSource):
    """``path``, and ``days`` of a range if they aren't the usual; ``tries`` and ``wait`` seconds for what fails; ``tasks``
    at most (a task reads one folder after the other, and holds one)."""

    @classmethod
    def name(cls) -> str:
        return "landed"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema) -> LandedReader:
        return LandedReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Makes the source known to the session and lets it see filters. Its code goes to workers by value, so that they
    need not have this package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    cloudpickle.register_pickle_by_value(sys.modules["meadowlark.sources.scratch"])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Landed)


def read(spark: SparkSession, path: str, fields: str = FIELDS, **options) -> DataFrame:
    """The landed bars, or some ``fields`` of them: Spark doesn't tell a Python source which columns a query needs."""
    register(spark)
    return spark.read.format("landed").schema(fields).options(path=path, **{k: str(v) for k, v in options.items()}).load()
