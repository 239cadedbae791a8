"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare

SQL = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, folder, name):
    assert compare(spark, folder, entry.queries()[name], SQL.get(name)) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 42
