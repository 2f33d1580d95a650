"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check
from tidewatch.plans.oracle import all_sql
from tidewatch.plans.queries import all_queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

WITHOUT_SQL = {"additive_predictions", "additive_scores"}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_but_the_iterative_fits_has_sql():
    assert set(all_queries()) - set(all_sql()) == WITHOUT_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(all_queries()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 28


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    got = check.table(df.columns, [tuple(r) for r in df.collect()])
    if name in WITHOUT_SQL:
        assert len(got[1]) > 0
        return
    cursor = con.execute(entry.oracle_sql()[name])
    assert got == check.table([d[0] for d in cursor.description], cursor.fetchall())
