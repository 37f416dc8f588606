"""Queries that SQL can express, against that SQL over the same tables."""

import oracle
import pytest

from feedloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    oracle.assert_same(found, oracle.connect(SF_DIR), queries.ORACLES[name])
