"""Every registered query against its SQL check on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_checks_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    result = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert result.startswith(("ok", "rows")) or result == "EMPTY", result


def test_entry(spark):
    assert entry.entry(spark).count() > 0
