import pytest

import __spark_entry__ as registry
from checks.compare_all import connect, differences
from conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_its_sql(spark, connection, name):
    assert differences(spark, connection, SMALL, name) is None


def test_entry(spark):
    assert registry.entry(spark).count() == 2823


def test_every_sql_has_a_query():
    assert registry.oracle_sql().keys() <= registry.queries().keys()
