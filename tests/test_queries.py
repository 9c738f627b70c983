"""Every query with checking SQL must equal it, value for value."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, name, SF) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
