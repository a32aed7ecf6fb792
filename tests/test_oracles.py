"""Every registered query against its SQL counterpart over the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from checks import oracles, queries
from checks.compare import connect, differences

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
# The corpus queries have tests of their own.
QUERIES, ORACLES = queries.QUERIES, oracles.ORACLES


@pytest.fixture(scope="module")
def tables():
    if not os.path.isdir(FOLDER):
        pytest.skip(f"no tables at {FOLDER}")
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert sorted(QUERIES) == sorted(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    assert differences(QUERIES[name](spark, FOLDER), tables, ORACLES[name]) == []


def test_entry(spark, tables):
    df = entry_points.entry(spark)
    assert df.columns[0] == "activity_id" and not df.isEmpty()
