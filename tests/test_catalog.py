"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, normal

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    ours = queries()[name](spark, SF_DIR).toPandas()
    theirs = duck.execute(oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_names():
    assert set(oracle_sql()) <= set(queries())
