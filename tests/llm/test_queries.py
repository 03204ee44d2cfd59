"""Queries that SQL can express, against it."""

import pytest

from cartwright.llm import oracle, queries
from checks.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query(spark, name):
    assert difference(queries.registered()[name](spark, SF_DIR), connect(SF_DIR), oracle.statements()[name]) is None
