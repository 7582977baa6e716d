import catalogue
import oracle
import pytest


@pytest.fixture(scope="module")
def connection(sf):
    return oracle.connect(sf)


def test_every_query_has_its_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE)


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query_equals_sql(spark, sf, connection, name):
    assert oracle.differences(catalogue.QUERIES[name](spark, sf), connection, catalogue.ORACLE[name]) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(catalogue.ORACLE) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
