"""Every registered query against its DuckDB twin on the smallest test data."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check import TABLES, rows_of

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_small, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_a_callable_and_sql_keys_match():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 69


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "monetary" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, sf_small, name):
    sdf = QUERIES[name](spark, sf_small).toPandas()
    ddf = con.execute(SQL[name]).df()
    sc, sr = rows_of(sdf)
    dc, dr = rows_of(ddf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() > 0
