"""Registered queries against their SQL, value for value."""

from __future__ import annotations

import pytest
from compare import expected, found

from waymill.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert found(QUERIES[name](spark, FOLDER)) == expected(ORACLES[name], FOLDER)
