"""Every registered query against DuckDB's answer to its reference SQL."""

import os

import oracle
import pytest

import __spark_entry__ as entry_points
from lapwise.bindings import registry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.QUERIES, registry.ORACLE_SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert oracle.differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) == []


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == [
        "season_year", "championship_position", "driver_id", "driver_name",
        "constructor_name", "cumulative_points"]
    assert frame.count() > 0
