"""Every registered query against its SQL in DuckDB, on the smallest scale."""

import pytest

import __spark_entry__ as spark_entry
import check
from stocktide.plans import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    assert check.compare(spark, duck, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(catalog.CHECKS) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 5
