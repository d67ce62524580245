"""Exact Gaussian likelihood of ARMA models, for many series and orders at a time.

A batch holds one problem per row: a series and an order. All problems of a batch go through the Kalman filter together,
one step of time after the other, so the numpy calls are shared by them. Coefficients come from unbounded parameters by way of
partial autocorrelations (Jones, 1980), which keeps every model stationary and invertible; the variance and the mean are
solved for, not searched.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

TINY = 1e-300
EDGE = 0.9995   # of autoregressive parts: nearer to a unit root the start of the filter cannot be told from noise
TOGETHER = 256  # series of a batch that are fitted side by side


def bounded(u: np.ndarray) -> np.ndarray:
    return u / np.sqrt(1 + u * u)


def coefficients(u: np.ndarray, edge: float = 1.0) -> np.ndarray:
    """Coefficients c of a stationary 1 - c1 B - ... from unbounded parameters, per row (Durbin and Levinson).

    Partial autocorrelations stay below ``edge``.
    """
    r = edge * bounded(u)
    c = np.zeros_like(u)
    for k in range(u.shape[1]):
        c[:, :k] = c[:, :k] - r[:, k: k + 1] * c[:, :k][:, ::-1]
        c[:, k] = r[:, k]
    return c


def plain(most: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Parameters (ar..., ma...), ``most`` each, to coefficients; parameters of 0 at the end of each half are lags left out."""
    return lambda u: (coefficients(u[:, :most], EDGE), -coefficients(u[:, most:]))


def seasonal(season: int) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Four parameters to the products (1 - a B)(1 - A B^s) and (1 + m B)(1 + M B^s)."""
    def spread(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, big_a, m, big_m = (bounded(u) * [EDGE, EDGE, 1, 1]).T
        ar, ma = np.zeros((len(u), season + 1)), np.zeros((len(u), season + 1))
        ar[:, 0], ar[:, season - 1], ar[:, season] = a, big_a, -a * big_a
        ma[:, 0], ma[:, season - 1], ma[:, season] = m, big_m, m * big_m
        return ar, ma
    return spread


def filtered(w: np.ndarray, used: np.ndarray, ar: np.ndarray, ma: np.ndarray, centred: np.ndarray) -> tuple[np.ndarray, ...]:
    """(deviance, variance, mean, state after the last used value) of rows w, of which the first ``used`` values count.

    The deviance is -2 log likelihood at the best variance and, where ``centred``, the best mean; else the mean is 0.
    """
    n, most = w.shape
    r = max(ar.shape[1], ma.shape[1] + 1)
    phi = np.pad(ar, ((0, 0), (0, r - ar.shape[1])))
    theta = np.concatenate((np.ones((n, 1)), np.pad(ma, ((0, 0), (0, r - 1 - ma.shape[1])))), axis=1)
    noise = theta[:, :, None] * theta[:, None, :]
    move = np.zeros((n, r, r))
    move[:, :, 0] = phi
    move[:, np.arange(r - 1), np.arange(1, r)] = 1.0
    whole = np.eye(r * r) - np.einsum("bij,bkl->bikjl", move, move).reshape(n, r * r, r * r)
    p = np.linalg.solve(whole, noise.reshape(n, r * r, 1)).reshape(n, r, r)
    a, end = np.zeros((n, r, 2)), np.zeros((n, r, 2))  # filters the series and a row of ones, from which the mean follows
    logs, yy, yo, oo = (np.zeros(n) for _ in range(4))
    for t in range(most):
        live = used > t
        f = np.maximum(p[:, 0, 0], 1.0)  # never below the noise of the value itself, but for rounding
        v, o = w[:, t] - a[:, 0, 0], 1 - a[:, 0, 1]
        logs += np.where(live, np.log(f), 0)
        yy += np.where(live, v * v / f, 0)
        yo += np.where(live, v * o / f, 0)
        oo += np.where(live, o * o / f, 0)
        mp = phi[:, :, None] * p[:, :1, :]
        mp[:, :-1] += p[:, 1:]
        gain = mp[:, :, 0] / f[:, None]
        now = phi[:, :, None] * a[:, :1, :]
        now[:, :-1] += a[:, 1:]
        now += gain[:, :, None] * np.stack((v, o), axis=1)[:, None, :]
        a = now
        last = used == t + 1
        if last.any():
            end[last] = a[last]
        next_p = mp[:, :, :1] * phi[:, None, :]
        next_p[:, :, :-1] += mp[:, :, 1:]
        p = next_p + noise - gain[:, :, None] * gain[:, None, :] * f[:, None, None]
    mean = np.where(centred, yo / np.maximum(oo, TINY), 0.0)
    s = np.maximum((yy - mean * (2 * yo - mean * oo)) / used, TINY)
    deviance = used * (np.log(2 * np.pi * s) + 1) + logs
    return deviance, s, mean, end[:, :, 0] - mean[:, None] * end[:, :, 1]


def minimise(f: Callable[[np.ndarray, np.ndarray], np.ndarray], x: np.ndarray, free: np.ndarray, rounds: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """The least values of f(x, rows) and where they are, for every row of ``x`` at once; only ``free`` entries move.

    Quasi-Newton steps with gradients by differences; a row leaves when its gradient vanishes or no step helps.
    """
    x, k = x.copy(), x.shape[1]
    value = f(x, np.arange(len(x)))

    def slope(x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.zeros_like(x)
        for j in range(k):
            some = np.flatnonzero(free[rows, j])
            if len(some):
                h = np.zeros((len(some), k))
                h[:, j] = 1e-5
                out[some, j] = (f(x[some] + h, rows[some]) - f(x[some] - h, rows[some])) / 2e-5
        return out

    rows = np.flatnonzero(free.any(axis=1) & np.isfinite(value))
    g, inverse = np.zeros_like(x), np.tile(np.eye(k), (len(x), 1, 1))
    if len(rows):
        g[rows] = slope(x[rows], rows)
    for _ in range(rounds):
        rows = rows[np.abs(g[rows]).max(axis=1) > 1e-6] if len(rows) else rows
        if not len(rows):
            break
        step = -np.einsum("bij,bj->bi", inverse[rows], g[rows])
        down = (step * g[rows]).sum(axis=1)
        step[down >= 0] = -g[rows][down >= 0]
        step *= np.minimum(1, 2 / np.maximum(np.linalg.norm(step, axis=1), TINY))[:, None]
        down = (step * g[rows]).sum(axis=1)
        size, taken, found = np.ones(len(rows)), np.zeros(len(rows), bool), np.empty(len(rows))
        for _ in range(12):
            todo = np.flatnonzero(~taken)
            if not len(todo):
                break
            found[todo] = f(x[rows[todo]] + size[todo, None] * step[todo], rows[todo])
            taken[todo] = found[todo] <= value[rows[todo]] + 1e-4 * size[todo] * down[todo]
            size[todo[~taken[todo]]] /= 3
        rows, step, found = rows[taken], (size[:, None] * step)[taken], found[taken]
        if not len(rows):
            break
        x[rows] += step
        still = value[rows] - found > 1e-11 * (1 + np.abs(found))
        value[rows] = found
        new = slope(x[rows], rows)
        turn = new - g[rows]
        g[rows] = new
        along = (step * turn).sum(axis=1)
        good = along > 1e-14
        if good.any():
            own, s, y = rows[good], step[good], turn[good] / along[good, None]
            keep = np.eye(k) - s[:, :, None] * y[:, None, :]
            inverse[own] = np.einsum("bij,bjk,blk->bil", keep, inverse[own], keep) + s[:, :, None] * s[:, None, :] / along[good, None, None]
        rows = rows[still]
    return x, value


def fit(w: list[np.ndarray], free: np.ndarray, centred: np.ndarray, spread: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]],
        starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(deviance, variance, mean, ar, ma) of the best model per series, tried from every row of ``starts``.

    ``free`` tells per series which parameters are searched; the others are 0. A series that is constant where it should
    vary, like zeros, has no likelihood to climb: its coefficients are 0.
    """
    if len(w) > TOGETHER:
        pieces = [slice(i, i + TOGETHER) for i in range(0, len(w), TOGETHER)]
        return tuple(map(np.concatenate, zip(*[fit(w[i], free[i], centred[i], spread, starts) for i in pieces])))
    used = np.array([len(x) for x in w])
    rows = np.zeros((len(w), used.max(initial=1)))
    for i, x in enumerate(w):
        rows[i, : len(x)] = x
    flat = np.array([np.ptp(x) if c else np.abs(x).max(initial=0.0) for x, c in zip(w, centred)]) < 1e-10
    own = free & ~flat[:, None]
    many = len(starts)
    of = np.repeat(np.arange(len(w)), many)

    def deviance(u: np.ndarray, at: np.ndarray) -> np.ndarray:
        return filtered(rows[of[at]], used[of[at]], *spread(u), centred[of[at]])[0]

    x, value = minimise(deviance, np.tile(starts, (len(w), 1)) * own[of], own[of])
    value = np.where(np.isfinite(value), value, np.inf).reshape(len(w), many)
    best = x.reshape(len(w), many, -1)[np.arange(len(w)), value.argmin(axis=1)]
    ar, ma = spread(best)
    dev, variance, mean, _ = filtered(rows, used, ar, ma, centred)
    return dev, variance, mean, ar, ma
