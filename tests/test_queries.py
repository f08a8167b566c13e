"""Each query with SQL against DuckDB on the smallest tables; the others run."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tarnwork.plans import queries as own

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connected(folder):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*' if os.path.isdir(path) else path}')")
    return con


def rows(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6)
    return sorted(map(str, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(own.QUERIES))
def test_query(spark, data, name):
    got = own.QUERIES[name](spark, data).toPandas()
    assert len(got)
    if name in own.ORACLES:
        want = connected(data).sql(own.ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
