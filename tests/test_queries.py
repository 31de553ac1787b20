"""Every registered query against its SQL, value for value."""

from __future__ import annotations

import pytest

from compare import connect, differences, spark_rows, sql_rows
from obsgrid.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    found = spark_rows(QUERIES[name](spark, sf_dir))
    assert differences(found, sql_rows(con, ORACLES[name])) == []


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
