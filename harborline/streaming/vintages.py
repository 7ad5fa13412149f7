"""Streams: vintages that keep changed rows only, ten-day buckets and sessions of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import core


def append_changes(batch: DataFrame, path: str, name: str, keys: list[str], value: str, tolerance: float = 0.0, seen: str = "fetched_at") -> None:
    """Append the rows of a batch that are new or differ from the latest vintage of their key, as part `name` of `path`.

    A part written again replaces itself and is not compared with itself, so a repeated batch changes nothing. `state.changes`
    does the same with the latest values in a state store, for tables whose history is long.
    """
    spark: SparkSession = batch.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    known = batch.limit(0)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        known = spark.read.schema(StructType(list(batch.schema.fields)).add("part", "string")).parquet(path).where(F.col("part") != name).drop("part")
        known = known.join(batch.select(*keys).distinct(), keys, "left_semi")  # only the history of the batch's keys is ranked
    new = core.latest(batch, keys, seen)
    changed = core.vintage_delta(known, new, keys, value, tolerance, seen).select(*batch.columns)
    changed.write.mode("overwrite").parquet(f"{path}/part={name}")


def keep_vintages(stream: DataFrame, path: str, checkpoint: str, keys: list[str], value: str, tolerance: float = 0.0, seen: str = "fetched_at") -> StreamingQuery:
    """Run a stream of (keys, value, seen) rows into a vintage table; each micro-batch is one part, named by its number."""
    return stream.writeStream.foreachBatch(lambda batch, n: append_changes(batch, path, f"b{n:09d}", keys, value, tolerance, seen)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ten_day(ts: Column) -> Column:
    """Cut-off of the third of a month a time lies in: 10, 20 or 99."""
    day = F.dayofmonth(ts)
    return F.when(day <= 10, 10).when(day <= 20, 20).otherwise(99)


def bucket_totals(events: DataFrame, ts: str, value: str, keys: list[str], late: str = "10 days") -> DataFrame:
    """Counts and sums by key, day and its third of a month, of a stream or a table; days later than `late` are dropped from a stream."""
    e = events.withWatermark(ts, late) if events.isStreaming else events
    return e.groupBy(F.window(ts, "1 day").alias("day"), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("v")).select(F.col("day.start").alias("day"), ten_day(F.col("day.start")).alias("cutoff"), *keys, "n", "v")


def sessions(events: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Spells of a key's events that are no more than `gap` apart: begin, end, count."""
    e = events.withWatermark(ts, late) if events.isStreaming else events
    return e.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("begin"), F.col("w.end").alias("end"), "n")
