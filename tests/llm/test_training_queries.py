"""The queries with SQL equal it on the smallest tables; the others give rows of their stated columns."""

import pytest

from lamplight.llm.queries import ORACLES, QUERIES

COLUMNS = {
    "p1_found": ["field", "key_a", "key_b"],
    "p3_found": ["row_id", "kind"],
    "p4_found": ["row_id_a", "row_id_b"],
    "p5_found": ["tab", "rec", "kind", "item"],
    "p6_ids": ["doc_id", "ids"],
    "p7_found": ["doc_id", "case_id"],
    "p8_found": ["doc_id", "band"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, data, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in (data / "sf0.001").glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = QUERIES[name](spark, str(data / "sf0.001"))
    want = con.sql(ORACLES[name])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, data, name):
    assert QUERIES[name](spark, str(data / "sf0.001")).columns == COLUMNS[name]
