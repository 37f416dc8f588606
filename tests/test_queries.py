"""Every registered query against DuckDB over the same tables."""

import __spark_entry__ as entry_point
import oracle
import pytest

from feedloom.plans import queries as catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert catalog.QUERIES.keys() == catalog.ORACLES.keys()
    assert catalog.QUERIES.keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, connection, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    oracle.assert_same(df, connection, entry_point.oracle_sql()[name])


def test_entry(spark):
    assert entry_point.entry(spark).count() == 1000
