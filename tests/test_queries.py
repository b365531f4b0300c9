"""Every query against its SQL twin on the smallest tables."""

import pytest

from checks.compare import connect, differences
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, con, name):
    found, rows = differences(spark, con, FOLDER, name)
    assert not found
    assert rows > 0


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
