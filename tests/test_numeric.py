"""Kernels against direct sums and fixtures whose answers are known."""

import itertools

import numpy as np
import pandas as pd

from harborline.functions import kernels
from harborline.operators import numeric

RNG = np.random.default_rng(7)


def test_hac_equals_the_double_sum():
    x = np.column_stack((np.ones(60), RNG.normal(size=60)))
    e = RNG.normal(size=60)
    meat = np.zeros((2, 2))
    for i, j in itertools.product(range(60), repeat=2):
        if abs(i - j) <= 5:
            meat += (1 - abs(i - j) / 6) * e[i] * e[j] * np.outer(x[i], x[j])
    bread = np.linalg.inv(x.T @ x)
    assert np.allclose(kernels.hac(x, e, 5), bread @ meat @ bread)


def test_a_linear_series_is_its_own_trend():
    y = 3 + 0.5 * np.arange(80)
    assert np.allclose(kernels.hp_trend(y), y, atol=1e-6)
    assert np.allclose(kernels.hp_trend(np.array([1.0, 2.0])), [1, 2])


def test_two_levels_have_one_break():
    for seed in range(6):
        y = np.r_[np.zeros(60), np.full(60, 2.0)] + np.random.default_rng(seed).normal(size=120) * 0.3
        r = kernels.mean_breaks(y)
        assert r["lwz"] == [60] and r["n_lwz"] == 1 and len(r["phases"]) == 2 and 60 in r["bic"]
        assert abs(r["phases"][1] - r["phases"][0] - 2) < 0.3 and r["sup_f"] > 50


def test_breaks_equal_every_partition():
    y = RNG.normal(size=26) + np.r_[np.zeros(9), np.full(8, 3.0), np.full(9, -2.0)]
    cost = lambda edges: sum(((y[a:b] - y[a:b].mean()) ** 2).sum() for a, b in zip(edges, edges[1:], strict=False))
    least = {m: min((cost([0, *c, 26]), list(c)) for c in itertools.combinations(range(1, 26), m) if all(b - a >= 5 for a, b in zip([0, *c], [*c, 26], strict=True))) for m in (1, 2)}
    r = kernels.mean_breaks(y, least=5, most=2)
    assert r["bic"] == least[r["n_bic"]][1] and r["n_bic"] == 2


def test_short_series_have_one_phase():
    r = kernels.mean_breaks(np.arange(10.0))
    assert r["lwz"] == [] and r["bic"] == [] and r["phases"] == [4.5]


def test_fitting_meets_both_margins_and_one_source_takes_the_targets_shares():
    i, j = (a.ravel() for a in np.indices((3, 4)))
    row, col = np.array([5.0, 3, 2]), np.array([1.0, 2, 3, 4])
    w = kernels.ipf(RNG.random(12) + 0.1, row, col, i, j)
    assert np.allclose(np.bincount(i, w), row) and np.allclose(np.bincount(j, w), col)
    one = kernels.ipf(np.ones(4), np.array([10.0]), col, np.zeros(4, int), np.arange(4))
    assert np.allclose(one, col)


def test_seasonal_parts_of_a_made_series():
    n = np.arange(120)
    season = np.tile([3, 1, -2, 0, 4, -1, -3, 2, 0, -4, 1, -1.0], 10)
    trend = 10 + 0.1 * n
    y = season + trend
    y[50] += 30  # an outlier stays in the remainder
    s, t = kernels.stl(y)
    assert np.abs(s - season).max() < 0.3 and np.abs(t - trend).max() < 0.3
    s, t = kernels.stl(np.arange(10.0))
    assert not s.any() and (t == 4.5).all()


def test_residuals_equal_least_squares(spark):
    from harborline.plans import inference

    r = np.random.default_rng(4)
    rows = [(s, t, float(r.normal()), 1.0, float(r.normal()), float(r.normal()), 0.0) for s in "ab" for t in range(40)] + [("few", 1, 1.0, 1.0, 1.0, 1.0, 0.0)]
    spark.createDataFrame(rows, "series string, midx int, y double, c double, p double, q double, z double").createOrReplaceTempView("residual_panel")
    got = {(x.series, x.midx): x.e for x in spark.sql(inference.residuals("select * from residual_panel", ("c", "p", "q", "z"))).collect()}
    assert set(got) == {(x[0], x[1]) for x in rows if x[0] != "few"}
    for s in "ab":
        mine = [x for x in rows if x[0] == s]
        e = kernels.ols(np.array([x[2] for x in mine]), np.array([x[3:] for x in mine]))[1]
        assert np.allclose([got[s, x[1]] for x in mine], e, atol=1e-7)


def one_step(train, lwr, mon):
    """Prediction and residuals of a row, refitted from all rows before it."""
    b, e = kernels.ols(train.lr.to_numpy(), np.column_stack((np.ones(len(train)), train.lwr)))
    month = train.base_ym.to_numpy() % 100
    effect = {m: e[month == m].mean() if (month == m).sum() >= 3 else 0.0 for m in range(1, 13)}
    return b[0] + b[1] * lwr + effect[mon] + 0.75 * e[-6:].mean(), e - np.array([effect[m] for m in month])


def test_forecasts_equal_refitting_every_prefix(spark):
    r = np.random.default_rng(11)
    ym = [y * 100 + m for y in range(1995, 1999) for m in range(1, 13)]
    parts = []
    for item in "ij":
        pdf = pd.DataFrame({"series": "s", "item": item, "cutoff": 10, "base_ym": ym, "cum_kusd": r.integers(50, 90, 48), "act": r.integers(150, 250, 48).astype(float), "lwr": r.normal(size=48) * 0.1})
        pdf["lr"] = np.log(pdf.cum_kusd / pdf.act)
        pdf.loc[[5, 17, 47], ["act", "lr"]] = None
        parts.append(pdf)
    spark_df = spark.createDataFrame([tuple(None if x != x else x for x in row) for p in parts for row in p.astype(object).itertuples(index=False)], "series string, item string, cutoff int, base_ym int, cum_kusd long, act double, lwr double, lr double")
    got = {(x["item"], x.base_ym): x for x in numeric.expanding_forecast(spark_df, least=30).collect()}
    n = 0
    for pdf in parts:
        for i in range(48):
            train = pdf.iloc[:i].dropna()
            if len(train) < 30:
                continue
            row = pdf.iloc[i]
            pred, e = one_step(train, row.lwr, row.base_ym % 100)
            x = got[row["item"], row.base_ym]
            want = [row.cum_kusd / np.exp(pred)] + [row.cum_kusd / np.exp(pred + 1.1 * np.quantile(e, q)) for q in (0.9, 0.75, 0.25, 0.1)]
            assert np.allclose([x.fc, x.lo80, x.lo50, x.hi50, x.hi80], want, rtol=1e-9)
            n += 1
    assert n == len(got) > 20


def test_nested_forecasts_equal_refitting_every_prefix(spark):
    from harborline.plans import inference

    r = np.random.default_rng(12)
    rows = []
    for s, n in (("a", 60), ("b", 45), ("short", 8)):
        v = r.normal(size=n)
        y = np.zeros(n)
        for t in range(2, n):
            y[t] = 0.5 * y[t - 1] - 0.2 * y[t - 2] + 0.4 * v[t] + 0.3 * r.normal()
        rows += [(s, t, float(y[t]), 1.0, float(y[t - 1]), float(y[t - 2]), float(v[t])) for t in range(2, n)]
    spark.createDataFrame(rows, "series string, midx int, y double, c double, y1 double, y2 double, v double").createOrReplaceTempView("nested_panel")
    got = {x.series: x for x in spark.sql(inference.nested("select * from nested_panel", 20)).collect()}
    assert set(got) == {"a", "b"}
    for s in got:
        mine = [x for x in rows if x[0] == s]
        x1, y, t = np.array([x[3:] for x in mine]), np.array([x[2] for x in mine]), np.array([x[1] for x in mine])
        f = [(y[i], x1[i, :3] @ kernels.ols(y[:i], x1[:i, :3])[0], x1[i] @ kernels.ols(y[:i], x1[:i])[0]) for i in range(len(y)) if t[i] >= 20 and i >= 12]
        a, f0, f1 = map(np.array, zip(*f, strict=True))
        d = (a - f0) ** 2 - ((a - f1) ** 2 - (f0 - f1) ** 2)
        cw = d.mean() / np.sqrt(kernels.hac(np.ones((len(d), 1)), d - d.mean(), 12)[0, 0])
        assert got[s].n == len(a) and np.allclose([got[s].rmse0, got[s].rmse1, got[s].cw_t], [np.sqrt(((a - f0) ** 2).mean()), np.sqrt(((a - f1) ** 2).mean()), cw], atol=2e-6)


def test_forecasts_use_earlier_months_only(spark):
    ym = [y * 100 + m for y in range(1995, 1999) for m in range(1, 13)]
    pdf = pd.DataFrame({"series": "s", "item": "i", "cutoff": 10, "base_ym": ym, "cum_kusd": RNG.integers(50, 90, 48), "act": RNG.integers(150, 250, 48), "lwr": RNG.normal(size=48) * 0.1})
    pdf["lr"] = np.log(pdf.cum_kusd / pdf.act)
    whole = numeric.expanding_forecast(spark.createDataFrame(pdf)).toPandas().set_index("base_ym")
    part = numeric.expanding_forecast(spark.createDataFrame(pdf[pdf.base_ym <= 199806])).toPandas().set_index("base_ym")
    assert list(whole.index) == [199801 + i for i in range(12)] and np.allclose(part.fc, whole.fc.loc[part.index])
    assert (whole.lo80 <= whole.lo50).all() and (whole.lo50 <= whole.hi50).all() and (whole.hi50 <= whole.hi80).all()
