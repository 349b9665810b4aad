"""Every registered query against its SQL equivalent."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck
from wattspindle.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    sql = entry.oracle_sql()[name]
    assert differences(spark, con, sf_dir, entry.queries()[name], sql) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert "machine_health_status" in result.columns
    assert result.count() > 0
