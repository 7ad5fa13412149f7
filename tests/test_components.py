"""Filter, smoother and search against Gaussian densities written out, and made series."""

import numpy as np

from harborline.functions import components as C
from harborline.operators import numeric


def density(y, mean, cov):
    d = y - mean
    return -0.5 * (len(y) * np.log(2 * np.pi) + np.linalg.slogdet(cov)[1] + d @ np.linalg.solve(cov, d))


def joint(theta, months, start):
    """Mean and covariance of all months' states, stacked, from the model's definition."""
    t, q, noise, p = (x[0] for x in C.system(theta[None]))
    mean, cov = np.zeros(4 * months), np.zeros((4 * months, 4 * months))
    mean[0] = start
    cov[:4, :4] = p
    for k in range(1, months):
        a, b = slice(4 * k - 4, 4 * k), slice(4 * k, 4 * k + 4)
        mean[b] = t @ mean[a]
        cov[b, : 4 * k] = t @ cov[a, : 4 * k]
        cov[: 4 * k, b] = cov[b, : 4 * k].T
        cov[b, b] = t @ cov[a, a] @ t.T + q
    return mean, cov, noise


def test_likelihood_and_smoother_equal_the_gaussian_density(monkeypatch):
    monkeypatch.setattr(C, "DIFFUSE", 50.0)
    r = np.random.default_rng(3)
    theta = np.array([[-1.0, -2.0, 0.3, 1.5, 0.2], [0.5, -4.0, -1.0, 0.1, -2.0]])
    y = np.cumsum(r.normal(size=(2, 12)), axis=1) + 5
    y[1, 4] = y[1, 11] = np.nan
    loglik, states = C.kalman(y, theta, keep=True)
    for i in range(2):
        mean, cov, noise = joint(theta[i], 12, y[i, 0])
        z = np.kron(np.eye(12), C.Z)
        has = np.flatnonzero(~np.isnan(y[i]))
        z, seen = z[has], y[i, has]
        m, s = z @ mean, z @ cov @ z.T + noise * np.eye(len(has))
        assert np.isclose(loglik[i], density(seen, m, s) - density(seen[:2], m[:2], s[:2, :2]), atol=1e-8)
        smooth = mean + cov @ z.T @ np.linalg.solve(s, seen - m)
        assert np.allclose(states[i], smooth.reshape(12, 4), atol=1e-8)


def test_the_search_beats_a_grid_and_batches_do_not_matter():
    r = np.random.default_rng(8)
    n = np.arange(96)
    y = np.stack([5 + 0.02 * n + 0.3 * np.sin(2 * np.pi * n / 40) + 0.05 * r.normal(size=96), np.cumsum(np.cumsum(0.01 * r.normal(size=96))) + 0.1 * r.normal(size=96)])
    both = C.fit(y)
    for i in range(2):
        alone = C.fit(y[i : i + 1])
        assert np.isclose(alone["loglik"][0], both["loglik"][i], atol=1e-6) and np.allclose(alone["level"][0], both["level"][i], atol=1e-6)
    scale = np.sqrt((np.diff(y, axis=1) ** 2).mean(axis=1))
    grid = np.array([[a, b, c, d, e] for a in (-6, -2, 0) for b in (-10, -6, -2) for c in (-6, -2, 0) for d in (0, 2, 4) for e in (-2, 0, 2)], float)
    for i in range(2):
        best = C.kalman(np.repeat(y[i : i + 1] / scale[i], len(grid), axis=0), grid).max() - 94 * np.log(scale[i])
        assert both["loglik"][i] >= best
    assert 34 < both["period"][0] < 46 and np.abs(both["level"][0] - (5 + 0.02 * n)).max() < 0.1
    assert np.allclose(np.diff(both["level"], axis=1), both["slope"][:, :-1], atol=1e-6)


def test_short_and_constant_series():
    y = np.full((3, 20), np.nan)
    y[0, :5] = np.arange(5)
    y[1] = 3.0
    out = C.fit(y, rounds=5)
    assert np.allclose(out["level"][0, :5], np.arange(5)) and np.isfinite(out["level"][1]).all() and np.isfinite(out["loglik"]).all()


def test_components_of_a_table_and_trends_side_by_side(spark):
    n = np.arange(100)
    rows = [(s, int(k) + 10, float(5 + a * k + 0.3 * np.sin(2 * np.pi * k / 36) + 0.2 * np.sin(2 * np.pi * k / 12))) for s, a in (("u", 0.02), ("v", -0.01)) for k in n]
    df = spark.createDataFrame([*rows, ("w", 1, None)], "series string, midx int, y double")
    got = numeric.unobserved(df, "series", "midx", "y").toPandas().sort_values(["series", "midx"])
    assert got.groupby("series").size().to_dict() == {"u": 100, "v": 100}
    assert np.allclose(got.y, got.level + got.cycle + got.noise)
    many = numeric.unobserved(df, "series", "midx", "y", together=1).toPandas().sort_values(["series", "midx"])
    assert np.allclose(got.level, many.level, atol=1e-5)
    table = {x.series: x for x in numeric.trend_methods(df, "series", "midx", "y").collect()}
    assert set(table) == {"u", "v"} and table["u"].n == 88
    assert table["u"].sd_hp < table["u"].sd_y and all(-1 <= c <= 1 for c in (table["u"].corr_ucm_hp, table["u"].corr_ucm_stl, table["u"].corr_hp_stl))
