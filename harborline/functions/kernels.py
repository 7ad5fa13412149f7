"""Numeric kernels on numpy arrays, for use inside grouped pandas functions."""

from __future__ import annotations

import math

import numpy as np


def ols(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of y on the columns of x, and residuals."""
    b, *_ = np.linalg.lstsq(x, y, rcond=None)
    return b, y - x @ b


def hac(x: np.ndarray, residuals: np.ndarray, lags: int) -> np.ndarray:
    """Covariance of least-squares coefficients with Bartlett weights over `lags` lags."""
    bread = np.linalg.inv(x.T @ x)
    u = x * residuals[:, None]
    meat = u.T @ u
    for k in range(1, min(lags, len(u) - 1) + 1):
        g = u[k:].T @ u[:-k]
        meat += (1 - k / (lags + 1)) * (g + g.T)
    return bread @ meat @ bread


def slope(y: np.ndarray, x: np.ndarray, lags: int = 12) -> dict:
    """Slope of y on a constant and x: estimate, robust error, t, normal p, n, r2, residual deviation (two parameters)."""
    z = np.column_stack((np.ones(len(x)), x))
    b, e = ols(y, z)
    se = math.sqrt(max(hac(z, e, lags)[1, 1], 0.0))
    t = b[1] / se if se > 0 else float("nan")
    total = ((y - y.mean()) ** 2).sum()
    return {"beta": b[1], "se": se, "t": t, "p": math.erfc(abs(t) / math.sqrt(2)) if t == t else float("nan"), "n": len(y), "r2": 1 - (e @ e) / total if total > 0 else float("nan"), "resid_sd": math.sqrt((e @ e) / (len(y) - 2)) if len(y) > 2 else float("nan")}


def hp_trend(y: np.ndarray, smoothing: float = 129600.0) -> np.ndarray:
    """Trend that minimises squared deviations plus `smoothing` times squared second differences."""
    n = len(y)
    if n < 3:
        return y.astype(float)
    d = np.diff(np.eye(n), 2, axis=0)
    return np.linalg.solve(np.eye(n) + smoothing * d.T @ d, y)


def mean_breaks(y: np.ndarray, least: int = 24, most: int = 5) -> dict:
    """Shifts of the mean: dynamic programming over the dates, numbers by Schwarz's criterion and by that of Liu, Wu and Zidek.

    Returns bic and lwz (positions where a segment begins), n_bic and n_lwz, phases (means between lwz's breaks) and sup_f,
    the largest squared robust t of a single step. A series without a segment of `least` has one phase.
    """
    n = len(y)
    s, q = np.concatenate(([0.0], np.cumsum(y))), np.concatenate(([0.0], np.cumsum(y * y)))

    def cost(i, j):
        return q[j] - q[i] - (s[j] - s[i]) ** 2 / (j - i)

    best, at = {0: np.full(n + 1, math.inf)}, {}
    best[0][least:] = cost(0, np.arange(least, n + 1)) if n >= least else []
    for m in range(1, most + 1):
        best[m], at[m] = np.full(n + 1, math.inf), np.zeros(n + 1, int)
        for j in range(least * (m + 1), n + 1):
            i = np.arange(least * m, j - least + 1)
            c = best[m - 1][i] + cost(i, j)
            k = int(c.argmin())
            best[m][j], at[m][j] = c[k], i[k]
    sums = {m: max(float(best[m][n]), 1e-300) for m in best if math.isfinite(best[m][n])}

    def places(m):
        out, j = [], n
        for step in range(m, 0, -1):
            j = int(at[step][j])
            out.append(j)
        return out[::-1]

    bic = min(sums, key=lambda m: math.log(sums[m] / n) + (2 * m + 1) * math.log(n) / n, default=0)
    lwz = min(sums, key=lambda m: math.log(sums[m] / (n - 2 * m - 1)) + (2 * m + 1) * 0.299 * math.log(n) ** 2.1 / n, default=0)
    top = 0.0
    for i in range(int(0.15 * n), int(0.85 * n)):
        step = (np.arange(n) >= i).astype(float)
        if 2 <= step.sum() <= n - 2:
            t = slope(y, step)["t"]
            top = max(top, t * t if t == t else 0.0)
    edges = [0, *places(lwz), n]
    return {"bic": places(bic), "lwz": edges[1:-1], "n_bic": bic, "n_lwz": lwz, "sup_f": top, "phases": [float(y[a:b].mean()) for a, b in zip(edges, edges[1:], strict=False) if b > a]}


def loess(y: np.ndarray, span: int, at: np.ndarray, weights: np.ndarray, degree: int = 1) -> np.ndarray:
    """Local polynomial fits of y at 0..n-1, at the places `at`: tricube weights over the `span` nearest, times `weights`."""
    n, x = len(y), np.arange(len(y), dtype=float)
    out = np.empty(len(at))
    for k, a in enumerate(at):
        d = np.abs(x - a)
        reach = np.partition(d, min(span, n) - 1)[min(span, n) - 1] * (max(span / n, 1.0) if span > n else 1.0)
        w = weights * np.clip(1 - (d / max(reach, 1e-12)) ** 3, 0, None) ** 3
        if w.sum() <= 0:
            w = weights + 1e-12
        mean = (w @ x) / w.sum()
        spread = w @ (x - mean) ** 2
        out[k] = (w @ y) / w.sum()
        if degree and spread > 1e-9 * w.sum():
            out[k] += (a - mean) * (w @ ((x - mean) * y)) / spread
    return out


def stl(y: np.ndarray, period: int = 12, seasonal: int = 13, inner: int = 2, outer: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Seasonal and trend parts of y by local regression (Cleveland et al. 1990), with robust weights."""
    n = len(y)
    if n < 2 * period:
        return np.zeros(n), np.full(n, y.mean() if n else 0.0)
    odd = lambda v: int(np.ceil(v)) | 1
    low, long = odd(period), odd(1.5 * period / (1 - 1.5 / seasonal))
    s, t, rho, steps = np.zeros(n), np.zeros(n), np.ones(n), np.arange(n)
    mean = lambda v, k: np.convolve(v, np.ones(k) / k, "valid")
    for _ in range(outer + 1):
        for _ in range(inner):
            cycle = np.empty(n + 2 * period)
            for m in range(period):
                part = (y - t)[m::period]
                cycle[m::period] = loess(part, seasonal, np.arange(-1, len(part) + 1), rho[m::period])
            filtered = loess(mean(mean(mean(cycle, period), period), 3), low, steps, np.ones(n))
            s = cycle[period : n + period] - filtered
            t = loess(y - s, long, steps, rho)
        r = np.abs(y - s - t)
        rho = np.clip(1 - (r / max(6 * np.median(r), 1e-12)) ** 2, 0, None) ** 2
    return s, t


def ipf(w: np.ndarray, row: np.ndarray, col: np.ndarray, i: np.ndarray, j: np.ndarray, steps: int = 400) -> np.ndarray:
    """Proportional fitting of sparse weights w at (i, j) to row and column sums: rows, then columns, `steps` times, or until nothing changes."""
    for _ in range(steps):
        last = w
        for at, goal in ((i, row), (j, col)):
            total = np.bincount(at, weights=w, minlength=len(goal))
            w = w * np.divide(goal, total, out=np.zeros(len(goal)), where=total > 0)[at]
        if (np.abs(w - last) <= 1e-15 * last).all():
            break
    return w
