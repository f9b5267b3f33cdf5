"""Every query with SQL against that SQL on another engine."""
from collections import Counter

import duckdb
import pytest

from tuplewright.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    found = duckdb.connect()
    for table in TABLES:
        found.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
    return found


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, db, sf, name):
    made = catalogue.QUERIES[name](spark, sf)
    columns = sorted(made.columns)
    got = Counter(tuple(r[c] for c in columns) for r in made.collect())
    want = db.sql(catalogue.ORACLES[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted(want.columns) == columns
    assert got == Counter(tuple(r[i] for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_query_without_sql_runs(spark, sf, name):
    assert catalogue.QUERIES[name](spark, sf).count() > 0
