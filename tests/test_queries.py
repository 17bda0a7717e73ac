"""Every registered query runs; those with SQL give the same rows."""

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries

@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, sf, name):
    ok, text = compare.compare(spark, con, name, sf)
    assert ok, text


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(oracle_sql()) <= set(queries())
