"""Links by classes of codes against all pairs in plain Python; fitting of one large group."""

import random

import pytest
from pyspark.sql import functions as F

from harborline.operators import fitting, links

from .test_fitting import plain_parts


def made(spark, seed, n=90):
    """Editions of four-digit codes (heads: two digits), some with no counterpart, and linked heads, some of codes that are not there."""
    r = random.Random(seed)
    every = sorted({f"{r.randrange(12):02d}{r.randrange(100):02d}" for _ in range(n)})
    past, now = {c for c in every if r.random() < 0.8}, {c for c in every if r.random() < 0.8 and c[:2] != "03"}
    heads = {(c[:2], c[:2]) for c in past} | {(f"{r.randrange(12):02d}", f"{r.randrange(14):02d}") for _ in range(6)}
    stay = past & now
    want = {(a, b) for a in past for b in now if (a[:2], b[:2]) in heads and (a == b or a not in stay or b not in stay)}
    editions = spark.createDataFrame([(1, c) for c in past] + [(2, c) for c in now] + [(1, None), (2, None), (3, "0000")], "edition int, hs10 string")
    return links.codes(editions, 1, 2, 2), spark.createDataFrame(sorted(heads), "hs6_past string, hs6 string"), past, now, want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_links_groups_and_orphans(spark, monkeypatch, seed):
    monkeypatch.setattr(links, "PAIRS", 5)
    c, heads, past, now, want = made(spark, seed)
    got = [tuple(x) for x in links.licensed(c, heads).collect()]
    assert set(got) == want and len(got) == len(want)
    assert {(x.side + x.hs10): x.grp for x in links.groups(c, heads).collect()} == {k: v[1:] for k, v in plain_parts([(a, b, 1) for a, b in want]).items()}
    orphans = [tuple(x) for x in links.orphans(c, heads).collect()]
    assert set(orphans) == {(a, "abolished") for a in past - {a for a, _ in want}} | {(None, "abolished")} and len(orphans) == len(set(orphans))
    same = [tuple(x) for x in links.within(c).collect()]
    stay = past & now
    assert set(same) == {(a, b) for a in past for b in now if a[:2] == b[:2] and (a == b or a not in stay or b not in stay)} and len(same) == len(set(same))


def test_a_large_group_of_a_join_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(links, "PAIRS", 1000)
    left, right = spark.range(200).select(F.lit("a").alias("key"), F.col("id").alias("x")), spark.range(100).select(F.lit("a").alias("key"), F.col("id").alias("y"))
    out = links.pairs(left, right, "key")
    assert out.select("x", "y").distinct().count() == out.count() == 20000
    sizes = [x["count"] for x in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 5 and max(sizes) <= 8000


def test_pieces_of_a_large_group_are_not_repeated_for_every_task(spark, monkeypatch):
    monkeypatch.setattr(links, "PAIRS", 100)
    left, right = (spark.range(k).select(F.when(F.col("id") < k - 50, "a").otherwise("b").alias("key"), F.col("id").alias(c)) for k, c in ((250, "x"), (150, "y")))
    sent = []
    repartition = type(left).repartition
    monkeypatch.setattr(type(left), "repartition", lambda x, *a: sent.append(x.count()) or repartition(x, *a))
    assert links.pairs(left, right, "key").count() == 200 * 100 + 50 * 50
    assert sum(sent) < 8000  # each row of the right for 200 pieces of the left: 30,250


def test_one_group_beyond_the_old_bound_is_fitted_without_rounds_of_joins(spark, monkeypatch):
    monkeypatch.setattr(fitting, "_rounds", lambda *a, **k: pytest.fail("rounds of joins"))
    v = lambda n, k: spark.range(n).select(F.col("id").cast("string").alias("hs10"), (F.col("id") % k + 1).cast("double").alias("v"))
    many = spark.range(450).crossJoin(spark.range(450).withColumnRenamed("id", "j")).select(F.col("id").cast("string").alias("hs_from"), F.col("j").cast("string").alias("hs_to"), F.lit(1.0).alias("prior"))
    got = fitting.masses(many, v(450, 7), v(450, 5), steps=20).groupBy("hs_to").agg(F.sum("mass").alias("m")).agg(F.count("*"), F.min("m"), F.max("m")).first()
    total = sum(i % 7 + 1 for i in range(450))
    assert got[0] == 450 and abs(got[2] / got[1] - 5) < 1e-4 and abs(got[1] - total / 1350) < 1e-3
