"""Every registered query beside its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tidemark.suite import registered

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def rows_of(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].itertuples(index=False)
    return sorted((tuple("" if pd.isna(v) else v for v in row) for row in plain), key=str)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(ours) > 0
        return
    theirs = duck.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_every_query_has_sql():
    assert set(registered.QUERIES) <= set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 5
