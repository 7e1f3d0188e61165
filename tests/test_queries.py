"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from roomledger.catalog.queries import QUERIES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.queries()) and set(QUERIES) <= set(entry_points.oracle_sql())


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
