"""Every registered query against its expected SQL, on the smallest data folder."""

import pytest

import __spark_entry__ as registry
from tests.parity import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES = {k: f for k, f in registry.queries().items() if k not in registry.TEXT_QUERIES}
EXPECTED = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(EXPECTED) - set(registry.TEXT_EXPECTED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, EXPECTED[name]) is None


def test_entry_is_stable(spark):
    first = registry.entry(spark)
    assert first.schema == registry.entry(spark).schema
    assert first.count() > 0
