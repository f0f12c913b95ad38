"""Every query that has SQL, against that SQL."""

import __spark_entry__ as entry
import pytest
from compare import connect, differences
from skyledger.plans import catalog, oracle

SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", sorted(SQL))
def test_equals_sql(spark, sf_dir, con, key):
    assert differences(catalog.QUERIES[key](spark, sf_dir), con, SQL[key]) == []


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(SQL)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 25
