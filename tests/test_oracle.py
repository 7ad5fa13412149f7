"""Every query with an SQL form gives DuckDB's rows."""

import os

import pytest

from harborline.plans import registry

from .compare import difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), SF_DIR, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert len(df.columns) == len(set(df.columns))
    df.collect()
