"""Every query against its SQL in DuckDB, on the smallest tables."""

import datetime as dt
import os
from pathlib import Path

import pytest

from meadowlark.plans import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, dt.datetime):
        return str(v.replace(tzinfo=None))
    return round(float(v), 9) if hasattr(v, "__float__") else str(v)


@pytest.mark.skipif(not Path(SF).exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted((tuple(map(plain, r)) for r in got.select(*columns).collect()), key=repr)
    rel = duck.execute(SQL[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
