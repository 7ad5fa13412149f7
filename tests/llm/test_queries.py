"""Every query of this subpackage runs over the smallest tables; those with SQL give its rows."""

import pytest

import __spark_entry__ as entry

from ..compare import difference

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if n.startswith("op")]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql().get(name)
    if sql:
        assert difference(df, SF, sql) is None
    else:
        assert df.count() > 0


def test_base_columns_have_no_gap(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in NAMES:
        if name.startswith(("op2_", "op3_", "op5_", "op7_", "op9_")):
            out = entry.queries()[name](spark, SF)
            assert out.select("doc_id").distinct().count() == docs == out.count()
