"""Vintages by keyed state against the same rows in batches, over restarts."""

import datetime
import random

from pyspark.sql import functions as F

from harborline.operators import core
from harborline.streaming import state

SCHEMA, KEYS = "series string, base_ym int, amt long, fetched_at int", ["series", "base_ym"]


def put(spark, rows, path, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def advance(spark, source, table, done, schema=SCHEMA, **options):
    q = state.keep(spark.readStream.schema(schema).parquet(source), table, done, KEYS, "amt", **options)
    q.awaitTermination()
    return q


def plain(rows, tolerance=0):
    """Rows passed on, one after another in order of the vintage."""
    latest, out = {}, []
    for s, b, v, t in sorted(rows, key=lambda x: x[3]):
        if (s, b) not in latest or abs(latest[s, b] - v) > tolerance:
            out.append((s, b, v, t, "revised" if (s, b) in latest else "new"))
            latest[s, b] = v
    return sorted(out)


def test_restarts_give_the_same_rows_as_one_pass_and_as_batches(spark, tmp_path):
    r = random.Random(4)
    vintages = [[(s, b, r.randrange(3), n) for s in "abc" for b in range(8) if r.random() < 0.7] for n in range(4)]
    source, table, done = (str(tmp_path / x) for x in ("in", "table", "done"))
    for rows in vintages:  # a start for each vintage: state comes from the checkpoint
        put(spark, rows, source)
        advance(spark, source, table, done)
    read = lambda t: sorted(tuple(x) for x in spark.read.parquet(t).collect())
    assert read(table) == plain([x for v in vintages for x in v])
    advance(spark, source, str(tmp_path / "once"), str(tmp_path / "done2"))  # all vintages in one batch
    assert read(str(tmp_path / "once")) == read(table)
    d = lambda rows: spark.createDataFrame(rows, SCHEMA)
    known = spark.read.parquet(table).where("fetched_at < 3").drop("kind")
    delta = core.vintage_delta(known, d(vintages[3]), KEYS, "amt")
    assert sorted(tuple(x) for x in delta.select("series", "base_ym", "amt", "fetched_at").collect()) == [x[:4] for x in read(table) if x[3] == 3]


def test_a_batch_reads_its_own_rows_only(spark, tmp_path):
    source, table, done = (str(tmp_path / x) for x in ("in", "table", "done"))
    put(spark, [("s", b, 1, 0) for b in range(500)], source)
    advance(spark, source, table, done)
    put(spark, [("s", 3, 1, 1), ("s", 4, 2, 1), ("s", 900, 5, 1)], source)
    q = advance(spark, source, table, done)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 3
    assert spark.read.parquet(table).where("fetched_at = 1").count() == 2


def test_tolerance_stale_and_null_rows(spark, tmp_path):
    source, table, done = (str(tmp_path / x) for x in ("in", "table", "done"))
    for rows in ([("a", 1, 10, 5), (None, 1, 4, 5)], [("a", 1, 11, 6), ("a", 1, 99, 4), (None, 1, None, 6)], [("a", 1, 13, 7), ("a", 1, 50, None), (None, 1, None, 7)]):
        put(spark, rows, source)
        advance(spark, source, table, done, tolerance=1)
    got = sorted(((x.series or "", x.amt, x.fetched_at, x.kind) for x in spark.read.parquet(table).collect()), key=str)
    assert got == sorted([("a", 10, 5, "new"), ("a", 13, 7, "revised"), ("", 4, 5, "new"), ("", None, 6, "revised")], key=str)


def test_settled_keys_make_later_revisions_late(spark, tmp_path):
    schema = SCHEMA + ", at timestamp"
    source, table, done = (str(tmp_path / x) for x in ("in", "table", "done"))
    at = lambda day: datetime.datetime(2000, 1, day)
    day = 24 * 3600 * 1000
    for rows in ([("a", 1, 5, 1, at(1)), ("b", 1, 5, 1, at(1))], [("b", 1, 6, 2, at(4))], [("c", 1, 1, 3, at(20))], [("a", 1, 7, 4, at(21))], [("c", 2, 1, 5, at(30))]):
        put(spark, rows, source, schema)
        advance(spark, source, table, done, schema, at="at", settle_ms=5 * day)
    got = spark.read.parquet(table).where(F.col("series") == "a").collect()
    assert sorted((x.kind, x.amt) for x in got) == [("late", 7), ("new", 5), ("settled", 5)]
    b = spark.read.parquet(table).where(F.col("series") == "b").collect()
    assert sorted((x.kind, x.amt) for x in b) == [("new", 5), ("revised", 6), ("settled", 6)]
