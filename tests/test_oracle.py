"""Every registered query with SQL, compared value by value at the smallest scale."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check import canonical

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = canonical([tuple(r[c] for c in columns) for r in df.collect()])
    cursor = duck.execute(oracle_sql()[name])
    at = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(at) == columns
    assert ours == canonical([tuple(r[at[c]] for c in columns) for r in cursor.fetchall()])


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
