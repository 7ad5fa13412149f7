"""Unobserved components of series by maximum likelihood: a smooth trend, a damped cycle and noise, many series at a time.

Level and slope are diffuse, the slope takes shocks; the cycle is stationary. Every recursion runs over the months once, for all
series, starts and perturbed parameters together: arrays' first axis is the batch. A month without a value is a NaN.
"""

from __future__ import annotations

import numpy as np

PERIODS = (18.0, 120.0)  # fixed bounds of the cycle's period in months
DIFFUSE = 1e6  # variance of the first level and slope, in units of the series' own
# starts of the search: share of the cycle in the changes, persistence, period
STARTS = ((0.3, 0.8, 30.0), (0.3, 0.9, 45.0), (0.6, 0.95, 60.0), (0.1, 0.7, 24.0), (0.6, 0.9, 90.0), (0.05, 0.5, 36.0))


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def parameters(theta: np.ndarray) -> tuple[np.ndarray, ...]:
    """Variances of noise, slope and cycle, persistence and frequency from unbounded numbers [batch, 5]."""
    noise, slope, cycle = np.exp(np.clip(theta[:, 0], -25, 10)), np.exp(np.clip(theta[:, 1], -25, 10)), np.exp(np.clip(theta[:, 2], -25, 10))
    period = PERIODS[0] + (PERIODS[1] - PERIODS[0]) * _sigmoid(theta[:, 4])
    return noise, slope, cycle, 0.999 * _sigmoid(theta[:, 3]), 2 * np.pi / period


def system(theta: np.ndarray) -> tuple[np.ndarray, ...]:
    """Transition and shocks' variance [batch, 4, 4], noise, and the first state's variance; state: level, slope, cycle, its twin."""
    noise, slope, cycle, rho, freq = parameters(theta)
    n = len(theta)
    t, q, p = np.zeros((n, 4, 4)), np.zeros((n, 4, 4)), np.zeros((n, 4, 4))
    t[:, 0, 0] = t[:, 0, 1] = t[:, 1, 1] = 1
    t[:, 2, 2] = t[:, 3, 3] = rho * np.cos(freq)
    t[:, 2, 3], t[:, 3, 2] = rho * np.sin(freq), -rho * np.sin(freq)
    q[:, 1, 1], q[:, 2, 2], q[:, 3, 3] = slope, cycle, cycle
    p[:, 0, 0] = p[:, 1, 1] = DIFFUSE
    p[:, 2, 2] = p[:, 3, 3] = cycle / (1 - rho**2)
    return t, q, noise, p


Z = np.array([1.0, 0, 1, 0])


def kalman(y: np.ndarray, theta: np.ndarray, keep: bool = False):
    """Log likelihood [batch] of y [batch, months], without the first two values of each series, which settle level and slope.

    keep: also the smoothed states [batch, months, 4].
    """
    t, q, noise, p = system(theta)
    n, months = y.shape
    a, p = np.zeros((n, 4)), p.copy()
    first = np.argmax(~np.isnan(y), axis=1)
    a[:, 0] = y[np.arange(n), first]
    a[np.isnan(a[:, 0]), 0] = 0.0
    loglik, seen, kept = np.zeros(n), np.zeros(n, int), []
    tt = np.swapaxes(t, 1, 2)
    for k in range(months):
        has = ~np.isnan(y[:, k])
        pz = p[:, :, 0] + p[:, :, 2]
        f = pz[:, 0] + pz[:, 2] + noise
        v = np.where(has, np.nan_to_num(y[:, k]) - a[:, 0] - a[:, 2], 0.0)
        seen += has
        loglik += np.where(has & (seen > 2), -0.5 * (np.log(2 * np.pi * f) + v * v / f), 0.0)
        gain = np.where(has, 1 / f, 0.0)[:, None] * pz
        if keep:
            kept.append((a, p, v, np.where(has, 1 / f, 0.0), gain))
        a = a + gain * v[:, None]
        p = p - gain[:, :, None] * pz[:, None, :]
        a = np.einsum("bij,bj->bi", t, a)
        p = t @ p @ tt + q
    if not keep:
        return loglik
    states, r = np.zeros((n, months, 4)), np.zeros((n, 4))
    for k in range(months - 1, -1, -1):
        a, p, v, f, gain = kept[k]
        r = np.einsum("bji,bj->bi", t, r)  # what later months say of the next state
        r = r - Z * np.einsum("bi,bi->b", gain, r)[:, None] + Z * (v * f)[:, None]
        states[:, k] = a + np.einsum("bij,bj->bi", p, r)
    return loglik, states


def _maximise(value, x: np.ndarray, rounds: int, step: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Highest points that quasi-Newton searches from each row of x reach, and their values. value: [batch, k] -> [batch]."""
    n, k = x.shape
    eye = np.eye(k)

    def slope(x):
        moved = np.concatenate([x + s * step * eye[i] for i in range(k) for s in (1, -1)])
        f = value(moved).reshape(k, 2, n)
        return ((f[:, 0] - f[:, 1]) / (2 * step)).T

    f, g = value(x), slope(x)
    h = np.tile(eye, (n, 1, 1))
    for _ in range(rounds):
        d = np.einsum("bij,bj->bi", h, g)
        down = (d * g).sum(axis=1) <= 0
        d[down], h[down] = g[down], eye
        d *= np.minimum(1, 2 / np.maximum(np.abs(d).max(axis=1), 1e-12))[:, None]
        scales = 0.5 ** np.arange(8)
        tried = value(np.concatenate([x + s * d for s in scales])).reshape(len(scales), n)
        gain = tried >= f + 1e-4 * scales[:, None] * (d * g).sum(axis=1)
        best = np.argmax(gain, axis=0)
        moved = gain.any(axis=0)
        s = np.where(moved, scales[best], 0.0)[:, None] * d
        new = x + s
        f2 = np.where(moved, tried[best, np.arange(n)], f)
        g2 = slope(new)
        y = g - g2
        sy = (s * y).sum(axis=1)
        ok = sy > 1e-12
        if ok.any():
            r = 1 / np.where(ok, sy, 1.0)
            left = np.eye(k) - r[:, None, None] * s[:, :, None] * y[:, None, :]
            h2 = left @ h @ np.swapaxes(left, 1, 2) + r[:, None, None] * s[:, :, None] * s[:, None, :]
            h = np.where(ok[:, None, None], h2, h)
        done = (np.abs(g2).max(axis=1) < 1e-4) | (~moved)
        h[~moved] = eye
        x, f, g = new, f2, g2
        if done.all():
            break
    return x, f


def fit(y: np.ndarray, rounds: int = 60) -> dict[str, np.ndarray]:
    """Of series [batch, months] (NaN: no value): level, slope, cycle [batch, months], loglik, period, rho, noise, start.

    Each series is searched for from every start, and the likeliest end counts. Series are scaled by their changes first. A
    series of fewer than 8 values has its values as level.
    """
    n, months = y.shape
    d = np.diff(y, axis=1)
    count = (~np.isnan(y)).sum(axis=1)
    scale = np.sqrt(np.nan_to_num(np.nanmean(np.where(np.isnan(d).all(axis=1, keepdims=True), 1.0, d) ** 2, axis=1), nan=1.0))
    scale = np.where(scale > 0, scale, 1.0)
    z = y / scale[:, None]
    begin = np.array([(np.log(0.3), np.log(1e-3), np.log(max(c, 1e-3)), np.log(r / (0.999 - r)), np.log((p - PERIODS[0]) / (PERIODS[1] - p))) for c, r, p in STARTS])
    m = len(begin)
    many = np.repeat(z, m, axis=0)
    value = lambda x: kalman(np.tile(many, (len(x) // len(many), 1)), x) - 1e-3 * (np.clip(np.abs(x) - 12, 0, None) ** 2).sum(axis=1)
    x, f = _maximise(value, np.tile(begin, (n, 1)), rounds)
    best = np.argmax(f.reshape(n, m), axis=1)
    theta = x.reshape(n, m, 5)[np.arange(n), best]
    loglik, states = kalman(z, theta, keep=True)
    noise, _, _, rho, freq = parameters(theta)
    short = count < 8
    level, slope, cycle = (states[:, :, i] * scale[:, None] for i in range(3))
    level[short], slope[short], cycle[short] = y[short], 0.0, 0.0
    return {"level": level, "slope": slope, "cycle": cycle, "loglik": loglik - np.maximum(count - 2, 0) * np.log(scale), "period": 2 * np.pi / freq, "rho": rho, "noise": noise * scale**2, "start": best}
