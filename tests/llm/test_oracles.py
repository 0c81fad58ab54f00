import collections
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(n for n in entry.oracle_sql() if n.startswith("op"))

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "pages", "conversations", "labels", "benchmark"):
        connection.execute(f"CREATE VIEW {t} AS FROM '{SF_DIR}/{t}.parquet'")
    df = entry.queries()[name](spark, SF_DIR)
    result = connection.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert collections.Counter(tuple(r) for r in df.select(*columns).collect()) == collections.Counter(result.fetchall())
