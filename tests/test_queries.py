"""Every registered query against its SQL, as multisets, on the shared test tables."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry
from railtempo.plans.queries import QUERIES
from railtempo.plans.reference_sql import SQL

SF_DIR = os.environ.get("RAILTEMPO_TESTDATA", "/root/testdata/sf0.01")
TABLES = "events orders lineitem".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def checker():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    yield connection
    connection.close()


def test_same_keys():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, checker, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = Counter(tuple(r[c] for c in columns) for r in df.collect())
    cursor = checker.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
