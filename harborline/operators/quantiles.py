"""Exact quantiles of groups of any size: values are counted, ranges of them summed up, and only the ranges that hold an answer are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import written


def quantiles(rows: DataFrame, group: str, value: str, shares: list[float]) -> DataFrame:
    """(group, share, q): interpolated quantiles of a group's values, as if all of them were sorted.

    Equal values are one row with their count, added up before they are shuffled. Rows are dealt by ranges of group and value,
    so a group spreads over tasks; a row for each range says how many values come before it. Nulls are left out, groups
    without a value have no row; a null group is a group.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n"))
    counts = written(counts.repartitionByRange("g", "v").withColumn("part", F.spark_partition_id()), "counts")
    whole = Window.partitionBy("g")
    ranges = counts.groupBy("g", "part").agg(F.sum("n").alias("here"))
    ranges = ranges.select("g", "part", "here", F.coalesce(F.sum("here").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("here").over(whole).alias("total"))
    at = (F.col("total") - 1) * F.col("share")
    asked = ranges.withColumn("share", F.explode(F.array(*map(F.lit, shares)))).withColumn("i", F.explode(F.array(F.floor(at), F.ceil(at)))).distinct()
    asked = asked.where("before <= i and i < before + here").select(F.col("g").alias("of_g"), F.col("part").alias("of_part"), "share", "i", "before", "total")
    asked = written(asked, "positions")
    same = F.col("g").eqNullSafe(F.col("of_g")) & (F.col("part") == F.col("of_part"))
    held = counts.join(asked.select("of_g", "of_part").distinct(), same, "left_semi")
    last = F.sum("n").over(Window.partitionBy("g", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    held = held.withColumn("last", last)  # values of the range up to this one
    found = held.join(asked, same).where("before + last - n <= i and i < before + last")
    ends = found.groupBy("g", "share", "total").agg(F.min_by("v", "i").alias("low"), F.max_by("v", "i").alias("high"))
    part = at - F.floor(at)
    return ends.select(F.col("g").alias(group), "share", (F.col("low") + (F.col("high") - F.col("low")) * part).alias("q"))
