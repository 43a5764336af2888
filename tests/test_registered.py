"""Every registered query against its SQL on the smallest tables."""

import pytest
from check_queries import compare, duck

from rinkflow.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert compare(connection, spark, FOLDER, name) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["Stadium", "avg_TempIce"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
