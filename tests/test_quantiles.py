import random

import numpy as np
from pyspark.sql import functions as F

from harborline.operators import core, quantiles


def test_exact_over_many_ranges(spark):
    r = random.Random(1)
    rows = [("hot", float(r.randrange(40)) if r.random() < 0.5 else r.random() * 40) for _ in range(4000)] + [("one", 7.0), ("two", 1.0), ("two", 2.0), (None, 3.0), (None, 9.0), ("none", None), ("same", 5.0), ("same", 5.0)]
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    df = spark.createDataFrame(rows, "k string, v double").repartition(9)
    got = {(x.k, x.share): x.q for x in quantiles.quantiles(df, "k", "v", shares).collect()}
    groups = {k: [v for g, v in rows if g == k and v is not None] for k in {g for g, _ in rows}}
    assert set(got) == {(k, s) for k, v in groups.items() if v for s in shares}
    for (k, s), q in got.items():
        assert abs(q - np.quantile(groups[k], s)) < 1e-12


def test_a_group_spreads_and_no_sort_of_all_values_is_planned(spark):
    df = spark.range(0, 5000, 1, 8).select(F.lit("k").alias("k"), (F.col("id") * 7919 % 5000).cast("double").alias("v"))
    out = quantiles.quantiles(df, "k", "v", [0.5])
    plan = out._jdf.queryExecution().toString()
    assert "percentile" not in plan.lower() and out.first().q == 2499.5


def plain_fill(rows):
    """Rows of (level cells): carried over from above, deeper ones forgotten where an upper one changes."""
    carry, out = [None] * len(rows[0]), []
    for row in rows:
        changed, got = False, []
        for level, v in enumerate(row):
            if v is not None:
                carry[level] = v
                carry[level + 1 :] = [None] * (len(row) - level - 1)
                changed = True
            elif not changed:
                v = carry[level]
            got.append(v)
        out.append(tuple(got))
    return out


def test_hierarchies_fill_down_with_reset(spark):
    r = random.Random(6)
    tables = {t: [tuple(str(r.randrange(9)) if r.random() < p else None for p in (0.1, 0.3, 0.6)) for _ in range(80)] for t in ("a", "b")}
    rows = [(t, i, *cells, i) for t, x in tables.items() for i, cells in enumerate(x)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "t string, i int, l1 string, l2 string, l3 string, other int")
    got = core.fill_hierarchy(df, ["t"], "i", ["l1", "l2", "l3"]).collect()
    want = {(t, i): x for t, cells in tables.items() for i, x in enumerate(plain_fill(cells))}
    assert len(got) == len(rows) and all((x.l1, x.l2, x.l3) == want[x.t, x.i] and x.other == x.i for x in got)


def test_carry_forward_with_reset(spark):
    df = spark.createDataFrame([(1, "a", False), (2, None, False), (3, None, True), (4, "b", False), (5, None, False)], "i int, v string, cut boolean")
    got = core.carry_forward(df, [], "i", ["v"], F.col("cut")).collect()
    assert {x.i: x.v for x in got} == {1: "a", 2: "a", 3: None, 4: "b", 5: "b"}
