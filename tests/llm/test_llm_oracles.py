"""Queries of the llm subpackage against their SQL."""

import pytest
from compare import compare, oracle_connection

from trackloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), oracle_connection(folder), ORACLES[name]) is None
