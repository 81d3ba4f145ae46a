"""Snapshots and landed requests: what is read, what stays, what fails."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan

from meadowlark.operators import panel
from meadowlark.sources import landed, snapshots

FIELDS = "k long, year int, v double"


def rows(spark, *data):
    return spark.createDataFrame(list(data), FIELDS)


def got(df):
    return sorted(tuple(r) for r in df.select("k", "year", "v").collect())


def files(base):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{base}/data") for f in fs if f.endswith(".parquet")}


def test_upserts_touch_their_partitions_only(spark, tmp_path):
    base = str(tmp_path / "t")
    assert snapshots.current(spark, base) is None
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, base)
    first = snapshots.upsert(spark, base, rows(spark, (1, 2020, 1.0), (2, 2021, 2.0), (3, 2022, 3.0), (4, 2022, 4.0)), ["k"], "year")
    there = files(base)
    second = snapshots.upsert(spark, base, rows(spark, (4, 2022, 9.0), (5, 2023, 5.0), (6, 2022, None)), ["k"], "year")
    assert (first.version, second.version) == (1, 2) and there <= files(base)
    assert {y: second.parts[y] == first.parts.get(y) for y in second.parts} == {"2020": True, "2021": True, "2022": False, "2023": False}
    assert got(snapshots.read(spark, base)) == [(1, 2020, 1.0), (2, 2021, 2.0), (3, 2022, 3.0), (4, 2022, 9.0), (5, 2023, 5.0), (6, 2022, None)]
    assert got(snapshots.read(spark, base, 1)) == [(1, 2020, 1.0), (2, 2021, 2.0), (3, 2022, 3.0), (4, 2022, 4.0)]
    some = snapshots.read(spark, base, values=[2021, 2023, 1999])
    assert got(some) == [(2, 2021, 2.0), (5, 2023, 5.0)] and all("year=2022" not in f and "year=2020" not in f for f in some.inputFiles())
    third = snapshots.add_missing(spark, base, rows(spark, (1, 2020, -1.0), (7, 2024, 7.0)), "year")
    assert third.parts["2020"] == first.parts["2020"] and got(snapshots.read(spark, base, values=[2020, 2024])) == [(1, 2020, 1.0), (7, 2024, 7.0)]
    assert snapshots.read(spark, base, values=[]).count() == 0
    with pytest.raises(ValueError):
        snapshots.replace(spark, base, rows(spark, (1, 2020, 1.0)), "k")


def test_a_job_lost_before_its_commit(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    snapshots.replace(spark, base, rows(spark, (1, 2020, 1.0), (2, 2021, 2.0)), "year")
    before, there = got(snapshots.read(spark, base)), files(base)

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "_put", lost)
        with pytest.raises(RuntimeError):
            snapshots.upsert(spark, base, rows(spark, (1, 2020, 5.0)), ["k"], "year")
    assert len(files(base)) > len(there) and got(snapshots.read(spark, base)) == before and snapshots.current(spark, base).version == 1
    snapshots.upsert(spark, base, rows(spark, (1, 2020, 5.0)), ["k"], "year")
    assert got(snapshots.read(spark, base)) == [(1, 2020, 5.0), (2, 2021, 2.0)]


def test_two_writers(spark, tmp_path):
    base = str(tmp_path / "t")
    one = snapshots.replace(spark, base, rows(spark, (1, 2020, 1.0)), "year")
    snapshots.replace(spark, base, rows(spark, (2, 2021, 2.0)), "year", one)
    with pytest.raises(snapshots.Conflict):
        snapshots.replace(spark, base, rows(spark, (3, 2022, 3.0)), "year", one)
    assert got(snapshots.read(spark, base)) == [(1, 2020, 1.0), (2, 2021, 2.0)]
    assert [n for n in os.listdir(f"{base}/manifests") if not n.endswith(".crc")] == ["00000001.json", "00000002.json"]


BAR = "symbol string, dt date, open double, high double, low double, close double, volume long"


@pytest.fixture
def requests(spark, tmp_path):
    start = dt.date(2024, 1, 1)
    data = [(f"s{s}", start + dt.timedelta(days=i), 1.0 * i, 2.0, 0.5, 1.5, i) for s in range(5) for i in range(0, 100, 7)]
    path = str(tmp_path / "landed")
    landed.land(spark.createDataFrame(data, BAR), path, days=20, chunk=2, start="2024-01-01")
    return path, data


def test_partitions_follow_filters(spark, requests):
    path, _ = requests
    reader = lambda: landed.LandedReader({"path": path, "days": "20"}, landed.read(spark, path).schema)
    assert len(reader().partitions()) == 15
    one = reader()
    left = list(one.pushFilters([GreaterThanOrEqual(("dt",), dt.date(2024, 1, 25)), LessThan(("dt",), dt.date(2024, 2, 12)), In(("symbol",), ("s0", "s4"))]))
    assert len(left) == 3  # Spark checks the rows again
    assert [(p.start, p.path.rsplit("/", 1)[1]) for p in one.partitions()] == [(dt.date(2024, 1, 21), "chunk=0"), (dt.date(2024, 1, 21), "chunk=2"), (dt.date(2024, 2, 10), "chunk=0"), (dt.date(2024, 2, 10), "chunk=2")]
    none = reader()
    list(none.pushFilters([EqualTo(("symbol",), "s0"), EqualTo(("symbol",), "s1")]))
    assert none.partitions() == []


def test_landed_rows(spark, requests):
    path, data = requests
    df = landed.read(spark, path, days=20)
    assert sorted(map(tuple, df.collect())) == sorted(data)
    where = df.where("dt between date'2024-02-01' and date'2024-02-20' and symbol = 's3'")
    assert sorted(map(tuple, where.collect())) == sorted(r for r in data if r[0] == "s3" and dt.date(2024, 2, 1) <= r[1] <= dt.date(2024, 2, 20))
    assert where.rdd.getNumPartitions() == 2  # of 15 requests
    assert df.where("symbol = 'none'").count() == 0


def test_failed_requests_are_tried_again(spark, requests, monkeypatch):
    path, _ = requests
    reader = landed.LandedReader({"path": path, "days": "20", "wait": "0.01"}, landed.read(spark, path).schema)
    part = reader.partitions()[0]
    real, calls = landed.file_system, []

    def flaky(p):
        calls.append(p)
        if len(calls) < 3:
            raise OSError("busy")
        return real(p)

    monkeypatch.setattr(landed, "file_system", flaky)
    began = time.time()
    assert sum(b.num_rows for b in reader.read(part)) == 6 and len(calls) == 3 and time.time() - began < 5
    calls.clear()
    reader.tries = 2
    with pytest.raises(OSError):
        list(reader.read(part))
    gone = landed.Folder(path + "/from=1999-01-01/chunk=0", part.start, part.stop)
    monkeypatch.setattr(landed, "file_system", real)
    assert list(reader.read(gone)) == []


def test_requests_share_folders(spark, tmp_path):
    """Folders and partitions don't grow with the symbols; rows and filters stay what they were."""
    path, day = str(tmp_path / "many"), dt.date(2024, 1, 1)
    data = [(f"s{s:03}", day + dt.timedelta(days=i), 1.0, 2.0, 0.5, 1.5, i) for s in range(100) for i in (0, 25)]
    landed.land(spark.createDataFrame(data, BAR), path, days=20, chunk=2, start="2024-01-01")
    df = landed.read(spark, path, days=20)
    assert df.rdd.getNumPartitions() == 26 and len({d for d, _, fs in os.walk(f"{path}/from=2024-01-01") if fs}) == 13  # of 50 requests
    assert sorted(map(tuple, df.collect())) == sorted(data)
    some = df.where("symbol in ('s003', 's099') and dt > date'2024-01-21'")
    assert some.rdd.getNumPartitions() == 2 and sorted(map(tuple, some.collect())) == [r for r in data if r[0] in ("s003", "s099") and r[6]]
    assert sorted(r.symbol for r in landed.read(spark, path, "symbol string", days=20).collect()) == sorted(r[0] for r in data)
    reader = landed.LandedReader({"path": path, "days": "20", "tasks": "4"}, df.schema)
    parts = reader.partitions()
    assert len(parts) == 4 and sorted(r["symbol"] + str(r["volume"]) for p in parts for b in reader.read(p) for r in b.to_pylist()) == sorted(r[0] + str(r[6]) for r in data)


def test_missing_symbols_deal_out_each_symbol_once(spark):
    bars = spark.range(1000).select((F.col("id") % 3).cast("string").alias("symbol"))
    missing = panel.missing_symbols(spark.createDataFrame([("1",), ("7",), (None,)], "symbol string"), bars)
    assert "Aggregate" in missing._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.symbol or "" for r in missing.collect()) == ["", "7"]
