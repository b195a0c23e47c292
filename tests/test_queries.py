import pytest

from millrace.plans import registry
from tests.oracle import DATA, assert_same, connection


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, con, name):
    assert_same(registry.QUERIES[name](spark, DATA), registry.ORACLES[name], con)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
