import pytest

from scriptorium.plans import catalogue

from .compare import same

SLOW: set[str] = set()


@pytest.mark.parametrize("name", sorted(set(catalogue.ORACLE_SQL) - SLOW))
def test_query_equals_sql(spark, small, name):
    same(spark, small, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL) | catalogue.WITHOUT_SQL


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
