"""Mixing sources to target weights by systematic sampling; DataFrame functions only.

A source's documents stand in one order (size class, hash, size, id). Each is expected target / source size times.
The running sum of expected copies, shifted by one random offset for each source, crosses integers; a document is
emitted once for each integer it crosses. Standing in order of size, short and long documents are taken alike, so
words taken stay near the target.

The running position is a sum over three levels - size classes of a source, hash buckets of a class (about
`bucket_rows` rows each), rows of a bucket - so no task sees a whole source, however hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, written

CAP = 3  # times a source's size, or a document's


def md5_int(text):
    """The first 32 bits of a string column's MD5, as a long; SQL engines agree on it."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) of (source, source_size, n).

    Weights 1, 2, 3 repeat over the sources by code point, null last. Shares fill up to cap x source_size; the level
    at which all shares add up is found in one pass over sources by the level at which each is full.
    """
    w = sizes.withColumn("weight", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("weight", (F.col("weight") % 3 + 1).cast("double"))
    w = w.withColumn("full", F.col("source_size") * float(cap)).withColumn("level", F.col("full") / F.col("weight"))
    every = Window.partitionBy()
    order = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    w = w.withColumn("all", F.sum("source_size").over(every).cast("double")).withColumn("all_weight", F.sum("weight").over(every))
    w = w.withColumn("here", (F.col("all") - F.coalesce(F.sum("full").over(order), F.lit(0.0))) / (F.col("all_weight") - F.coalesce(F.sum("weight").over(order), F.lit(0.0))))
    # sources that are full below the level open to them stay full; the first that is not sets the level for the rest
    w = w.withColumn("place", F.row_number().over(Window.orderBy("level", F.col("source").asc_nulls_last())))
    w = w.withColumn("rate", F.min(F.when(F.col("level") > F.col("here"), F.struct("place", "here"))).over(every)["here"])
    target = F.when(F.col("rate").isNull() | (F.col("level") <= F.col("rate")), F.col("full")).otherwise(F.col("rate") * F.col("weight"))
    return w.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: str = "mix-1", bucket_rows: int = 20000, cap: int = CAP, carry: tuple = ()) -> DataFrame:
    """One row for each document: doc_id, source, size, source_size, target, copies, taken (size x copies).

    size: words of the text (null text: 0). A null source is a source of its own, last in order. A source whose
    documents hold no words has target 0 and no copies. Repeated doc_ids are documents of their own; rows that are
    alike in id and size may swap copies, which leaves the result the same. Empty tables give no rows; further
    columns are ignored, but those named in carry are handed on. Null ids make a bucket of their own, last in order.
    """
    sized = docs.select(*carry, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    sized = sized.withColumn("class", F.floor(F.log2(F.col("size") + 1.0) * 4).cast("int"))
    sized = written(sized, "sizes")
    return take(sized, seed, bucket_rows, cap, carry)


def take(sized: DataFrame, seed: str, bucket_rows: int, cap: int = CAP, carry: tuple = ()) -> DataFrame:
    n_buckets = max(1, -(-sized.count() // bucket_rows))
    b = sized.withColumn("bucket", md5_int(F.col("doc_id").cast("string")) % n_buckets)
    key = ["source", "class", "bucket"]
    counts = written(b.groupBy(*key).agg(F.count("*").alias("n"), F.sum("size").alias("words")), "buckets")
    classes = counts.groupBy("source", "class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    goal = targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), cap)
    goal = goal.withColumn("rate", F.coalesce(F.col("target") / F.expr("nullif(source_size, 0)"), F.lit(0.0)))
    goal = goal.withColumn("start", md5_int(F.concat(F.lit(seed + ":"), F.coalesce("source", F.lit("")))) / F.lit(4294967296.0))
    before = Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select(F.col("source").alias("s1"), F.col("class").alias("c1"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("class_before"))
    goal = goal.withColumnRenamed("source", "s2")
    inside = Window.partitionBy("source", "class").orderBy(F.col("bucket").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("bucket_before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    offsets = offsets.join(classes, F.col("source").eqNullSafe(F.col("s1")) & (F.col("class") == F.col("c1"))).join(goal, F.col("source").eqNullSafe(F.col("s2")))
    offsets = offsets.select(F.col("source").alias("s"), F.col("class").alias("c"), F.col("bucket").alias("k"), (F.col("class_before") + F.col("bucket_before")).alias("before"), "source_size", "target", "rate", "start")
    row = F.row_number().over(Window.partitionBy("source", "class", "bucket").orderBy("size", "doc_id"))
    placed = b.withColumn("row", row).join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("c")) & F.col("bucket").eqNullSafe(F.col("k")))
    at = F.col("before") + F.col("row")
    placed = placed.withColumn("copies", (F.floor(F.col("rate") * at + F.col("start")) - F.floor(F.col("rate") * (at - 1) + F.col("start"))).cast("long"))
    placed = placed.withColumn("copies", F.least(F.col("copies"), F.lit(cap).cast("long")))
    return placed.select(*carry, "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE_SQL = """
with sized as (
  select cast(doc_id as bigint) doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) size from documents),
k as (select greatest((count(*) + 19999) // 20000, 1) n_buckets from sized),
b as (select s.*, cast(floor(log2(size + 1e0) * 4) as integer) class, cast('0x' || substr(md5(cast(doc_id as varchar)), 1, 8) as bigint) % k.n_buckets bucket from sized s, k),
src as (select source, cast(sum(size) as bigint) source_size from b group by source),
w as (select *, cast((row_number() over (order by encode(source) nulls last) - 1) % 3 + 1 as double) weight from src),
l as (select *, 3e0 * source_size "full", 3e0 * source_size / weight level from w),
h as (select *, (cast(sum(source_size) over () as double) - coalesce(sum("full") over p, 0)) / (sum(weight) over () - coalesce(sum(weight) over p, 0)) here,
             row_number() over (order by level, encode(source) nulls last) place
      from l window p as (order by level, encode(source) nulls last rows between unbounded preceding and 1 preceding)),
r as (select *, arg_min(here, place) filter (where level > here) over () rate from h),
g as (select source, source_size, case when rate is null or level <= rate then "full" else rate * weight end target from r),
o as (select *, row_number() over (partition by source order by class, bucket, size, doc_id) pos from b),
c as (select o.doc_id, o.size, g.source_size, g.target, coalesce(g.target / nullif(g.source_size, 0), 0) f, pos,
             cast('0x' || substr(md5('mix-1:' || coalesce(o.source, '')), 1, 8) as bigint) / 4294967296e0 u
      from o join g on o.source is not distinct from g.source)
select doc_id, size, source_size, target, cast(size * least(cast(floor(f * pos + u) - floor(f * (pos - 1) + u) as bigint), 3) as bigint) taken from c
"""
