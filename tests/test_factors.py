"""Fitting by factors of codes against fitting of links as rows, on made codes whose margins cannot all be met."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.operators import factors, fitting, links


def made(spark, seed):
    r = random.Random(seed)
    every = sorted({f"{r.randrange(8):02d}{r.randrange(100):02d}" for _ in range(60)})
    past, now = {c for c in every if r.random() < 0.8}, {c for c in every if r.random() < 0.8}
    heads = sorted({(c[:2], c[:2]) for c in past} | {(f"{r.randrange(8):02d}", f"{r.randrange(9):02d}") for _ in range(4)})
    editions = spark.createDataFrame([(1, c) for c in past] + [(2, c) for c in now] + [(1, None)], "edition int, hs10 string")
    names = tuple(spark.createDataFrame([(c, r.choice(["red tin", "red bolt", "old tin (new)", "gear"]), "metal") for c in side], "hs10 string, leaf string, path string") for side in (past, now))
    values = tuple(spark.createDataFrame([(c, float(r.randrange(1, 10**6))) for c in side if r.random() < 0.7], "hs10 string, v double") for side in (past, now))
    return links.codes(editions, 1, 2, 2), spark.createDataFrame(heads, "hs6_past string, hs6 string"), names, values


@pytest.mark.parametrize("seed", [1, 2])
def test_factors_give_the_links_masses_and_weights(spark, monkeypatch, seed):
    c, heads, names, values = made(spark, seed)
    monkeypatch.setattr(factors, "LINKS", 50)
    masses = fitting.masses(fitting.priors(links.licensed(c, heads), *names), *values, found=links.groups(c, heads))
    monkeypatch.setattr(fitting, "masses", lambda *a, **k: pytest.fail("links as rows"))
    x = factors.fit(c, heads, names, values, fewer=False)
    assert x.links == masses.count() and factors.fit(c, heads, names, values) is not None
    want = {w.hs_from + w.hs_to: (w.weight, w.score, w.relation) for w in fitting.weights(masses).collect()}
    rows = factors.weights(x).collect()
    got = {w.hs_from + w.hs_to: (w.weight, w.score, w.relation) for w in rows}
    assert len(rows) == len(got) and got.keys() == want.keys()
    assert all(np.allclose(got[k][:2], want[k][:2], rtol=1e-9) and got[k][2] == want[k][2] for k in want)
    want = {t.hs_to: (t.m, t.n) for t in masses.groupBy("hs_to").agg(F.sum("mass").alias("m"), F.count("*").alias("n")).collect()}
    got = {t.hs_to: (t.mass, t.n_links) for t in factors.targets(x).collect()}
    assert got.keys() == want.keys() and all(abs(got[k][0] / want[k][0] - 1) < 1e-9 and got[k][1] == want[k][1] for k in want)
    own = masses.agg(F.sum(F.expr("if(hs_from = hs_to, mass, 0)")) / F.sum("mass"), F.countDistinct("hs_from")).first()
    found = factors.retention(x).first()
    assert abs(found.retention - own[0]) < 1e-9 and found.n_sources == own[1]
