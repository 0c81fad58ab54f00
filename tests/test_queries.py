"""Every registered query against its SQL in DuckDB, over the supplied tables."""

import collections
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from repopulse.sample.adapter import FULL
from repopulse.sources.layout import raw_schema

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("nation", "customer", "orders", "lineitem")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


OWN = [name for name in entry.queries() if name != "pipeline" and not re.match(r"op\d+_", name)]


def test_every_query_has_its_sql():
    assert set(OWN) <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_staging_queries_fill_every_raw_field():
    for table, (_, _, fields) in FULL.items():
        assert fields.keys() == set(raw_schema(table).names)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, tables, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = tables.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    expected = collections.Counter(result.fetchall())
    found = collections.Counter(tuple(row) for row in df.select(*names).collect())
    assert sum(found.values()) > 0
    assert found == expected


def test_ordered_reports_keep_their_order(spark, tables):
    for name in ("activity_time_series", "top_repos_by_prs"):
        rows = [tuple(row) for row in entry.queries()[name](spark, SF_DIR).collect()]
        assert rows == tables.execute(entry.oracle_sql()[name]).fetchall()


def test_entry(spark):
    assert entry.entry(spark).count() == 25
