"""Registered queries with expected SQL, on two data folders."""

import pytest

from tests.parity import connect, differences
from tidemark.llm import queries


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(queries.EXPECTED))
def test_query_matches(spark, name, sf):
    folder = f"/root/testdata/{sf}"
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.EXPECTED[name]) is None
