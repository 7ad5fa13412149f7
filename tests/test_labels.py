"""Rates as texts."""

from pyspark.sql import functions as F

from harborline.functions import columns


def test_a_fall_that_rounds_to_nothing_keeps_its_sign(spark):
    rows = [(-0.0004,), (0.0004,), (0.0,), (-0.0125,), (0.0125,), (-0.0006,)]
    got = spark.createDataFrame(rows, "g double").select(columns.percent(columns.away(F.col("g"), 6))).collect()
    assert [r[0] for r in got] == ["-0.0%", "+0.0%", "+0.0%", "-1.3%", "+1.3%", "-0.1%"]
    assert spark.createDataFrame([(-1e-8,)], "g double").select(columns.percent(columns.away(F.col("g"), 6))).first()[0] == "-0.0%"
