"""Every query with SQL equals it on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry

ORACLES = {k: v for k, v in entry.oracle_sql().items() if not k.startswith("p")}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.fixture(scope="module")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in (data / "sf0.001").glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, data, duck, name):
    df = entry.queries()[name](spark, str(data / "sf0.001"))
    want = duck.sql(ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr) == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_entry(spark, data):
    assert entry.entry(spark).count() > 0
