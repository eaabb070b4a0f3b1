"""Every registered query against its SQL, on the smallest tables.

``CHECK_SF_DIR=/root/testdata/sf0.01`` checks the larger ones.
"""

import os

import pytest

from check import connect, difference
from tidewell.catalogue import registered

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, connection, name):
    query = registered()[name]
    problem = difference(spark, connection, name, query.run, query.sql, FOLDER)
    assert problem in (None, "no rows on either side"), problem


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns[:2] == ["user_id", "subscription_id"]
