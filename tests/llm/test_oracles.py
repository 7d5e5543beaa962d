"""Queries of the training-data operators against their SQL."""

import pytest

from tessera.llm.queries import ORACLES, QUERIES
from tests.oracle import SMALL, differ


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert differ(QUERIES[name](spark, SMALL), ORACLES[name], SMALL) == ""
