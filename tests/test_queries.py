"""Every query with an oracle, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from tallystone.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


def rows(df):
    def cell(v):
        if v is None or v != v:
            return "NULL"
        return f"{v:.6g}" if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in r) for r in df.astype(object).where(df.notna(), None).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    if name not in ORACLES:
        assert len(got)
        return
    want = duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
