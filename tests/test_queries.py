"""Every registered query against its SQL, on the smallest scale factor."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import rows_of

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, df.collect())
    if name in SQL:
        cursor = con.execute(SQL[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, cursor.fetchall())
    else:
        assert got


def test_entry(spark):
    assert entry.entry(spark).count() == 27
