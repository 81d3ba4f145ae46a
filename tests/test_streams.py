"""Streams that are replayed, stopped and taken up again."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from meadowlark.operators import publish
from meadowlark.plans.streams import BARS, EVENTS
from meadowlark.sources import derived
from meadowlark.streaming import bars, repair

T = lambda h, m, s=0: dt.datetime(2024, 1, 1, h, m, s)


@pytest.fixture
def source(spark, tmp_path):
    """On time: 10:00 to 10:20; two beats; then late: a bar that is missing, and one that is closed."""
    files = [
        [(1, T(10, 0), "a", 1.0), (2, T(10, 3), "a", 4.0), (2, T(10, 3), "a", 4.0), (3, T(10, 6), "b", 2.0)],
        [(4, T(10, 16), "a", 5.0), (5, T(10, 17), "a", 6.0)],
        [(-1, T(23, 0), "end", 0.0)],
        [(-2, T(23, 1), "end", 0.0)],
        [(6, T(10, 4), "a", 99.0), (7, T(10, 11), "b", 7.0), (8, T(10, 12), "b", 8.0), (8, T(10, 12), "b", 8.0)],
    ]
    rows = [(*r, i) for i, f in enumerate(files) for r in f]
    df = spark.createDataFrame(rows, EVENTS + ", file int")
    repair.land(df, str(tmp_path / "in"), "file", len(files))
    return str(tmp_path / "in")


WANT = {("a", T(10, 0)): (4.0, 2, "closed"), ("b", T(10, 5)): (2.0, 1, "closed"), ("a", T(10, 15)): (6.0, 2, "closed"), ("b", T(10, 10)): (8.0, 2, "late")}


def found(spark, path):
    return {(r.symbol, r.ts): (r.close, r.n, r.source) for r in repair.table(spark, path, BARS).where("symbol <> 'end'").collect()}


def test_late_rows_fill_only(spark, source, tmp_path):
    path, check = str(tmp_path / "bars"), str(tmp_path / "check")
    repair.bars_with_repair(bars.events(spark, source, EVENTS), path, check)
    assert found(spark, path) == WANT
    assert repair.table(spark, path, BARS).where("symbol <> 'end'").count() == len(WANT)

    # a run that finds nothing new changes nothing; one whose last batches weren't committed writes them again
    repair.bars_with_repair(bars.events(spark, source, EVENTS), path, check)
    assert found(spark, path) == WANT
    for part in ("closed", "late"):
        last = max(int(p.name) for p in (tmp_path / "check" / part / "commits").iterdir() if p.name.isdigit())
        for name in (str(last), f".{last}.crc"):
            (tmp_path / "check" / part / "commits" / name).unlink(missing_ok=True)
        for p in (tmp_path / "bars" / f"source={part}").glob(f"batch={last}"):
            shutil.rmtree(p)  # the batch was half written
    repair.bars_with_repair(bars.events(spark, source, EVENTS), path, check)
    assert found(spark, path) == WANT and repair.table(spark, path, BARS).where("symbol <> 'end'").count() == len(WANT)


def test_a_batch_written_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("a", T(10, 0), 1.0)], "symbol string, ts timestamp, close double")
    two = spark.createDataFrame([("a", T(10, 0), 2.0), ("b", T(10, 0), 3.0)], one.schema)
    write = repair.fill_only(path, "x")
    for batch, number in ((one, 0), (two, 1), (two, 1), (one, 0), (one.limit(0), 2)):
        write(batch, number)
    assert sorted((r.symbol, r.close) for r in repair.table(spark, path, "symbol:string,ts:timestamp,close:double").collect()) == [("a", 1.0), ("b", 3.0)]


def test_months_freeze_once(spark, tmp_path):
    """The months that are out are those that the batch plan calls closed; a stop between batches loses none."""
    day = lambda s: dt.datetime.fromisoformat(s)
    files = [[("a", day("2023-01-05"), 1.0), ("a", day("2023-01-31 23:59:59"), 2.0), ("b", day("2023-02-10"), 3.0)], [("a", day("2023-03-20"), 4.0)], [("a", day("2023-04-29"), 5.0)], [("b", day("2023-04-30"), 6.0)]]
    fields = "symbol string, ts timestamp, volume double"
    out, check, source = (str(tmp_path / x) for x in ("out", "check", "in"))
    write = lambda df, i: df.write.mode("overwrite").parquet(f"{out}/batch={i}")

    def go(rows):
        spark.createDataFrame(rows, fields).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(fields).option("maxFilesPerTrigger", 1).parquet(source)
        repair.run(repair.frozen_months(stream), write, check)
        return {(r.symbol, r.year, r.month): (r.n, r.volume) for r in spark.read.schema(repair.FROZEN).parquet(out).collect()}

    assert go(files[0]) == {} and go(files[1]) == {}
    assert go(files[2]) == {("a", 2023, 1): (2, 3.0)}  # 2023-04-29: January ended 88 days ago, February 60
    assert go(files[3]) == {("a", 2023, 1): (2, 3.0), ("b", 2023, 2): (1, 3.0)}  # a day later
    final = go([("a", day("2023-05-04"), 1.0), ("a", day("2023-01-07"), 50.0)])  # a row of a closed month counts no more
    assert final == {("a", 2023, 1): (2, 3.0), ("b", 2023, 2): (1, 3.0)}
    assert spark.read.parquet(out).count() == 2
    rows = spark.createDataFrame([("a", 2023, 1), ("b", 2023, 2), ("a", 2023, 3), ("a", 2023, 5), ("b", 2023, 5)], "symbol string, year int, month int")
    keys = rows.select(F.concat_ws("/", "symbol", "year", "month").alias("key"), "year", "month")
    left = publish.freeze_months(keys, keys, "2023-05-04")  # what the plan would still write
    assert {r.key for r in keys.collect()} - {r.key for r in left.collect()} == {f"{s}/{y}/{m}" for s, y, m in final}


def test_batch_twin(spark, source):
    """Without late rows the stream's bars are the batch's."""
    events = spark.read.schema(EVENTS).parquet(source).where("event_id between 1 and 5").distinct()
    assert {(r.symbol, r.ts) for r in derived.bars_5min(events).collect()} == {k for k, v in WANT.items() if v[2] == "closed"}
