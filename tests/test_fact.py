"""The monthly fact is summed by a number of tasks that follows the lines."""

from pyspark.sql import functions as F

from harborline.sources import trade

SF_DIR = "/root/testdata/sf0.001"


def test_tasks_follow_the_lines(spark, monkeypatch):
    whole = spark.sql(trade.spark_text("select yyyymm, stat_cd, hs10, exp_dlr, imp_dlr, exp_wgt, imp_wgt, bal_payments from fact_trade", SF_DIR))
    monkeypatch.setattr(trade, "FACT_LINES", 500)
    made = trade._fact(spark, SF_DIR)
    sizes = [x["count"] for x in made.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 1000
    assert made.schema.names == whole.schema.names and made.exceptAll(whole).count() == whole.exceptAll(made).count() == 0
