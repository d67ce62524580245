import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.operators import arima, forecasting as fc, likelihood as lk
from tablewright.session import cut_lineage


def panel(spark, series):
    rows = [(s, dt.date(1900 + i // 4, 3 * (i % 4) + 1, 1), None if v is None else float(v)) for s, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "series string, period date, value double")


def density(w, ar, ma, centred):
    """-2 log likelihood and mean from the whole covariance matrix."""
    n, long = len(w), 3000
    psi = np.zeros(long)
    psi[0] = 1
    for j in range(1, long):
        psi[j] = (ma[j - 1] if j - 1 < len(ma) else 0) + sum(ar[i] * psi[j - 1 - i] for i in range(min(len(ar), j)))
    gamma = np.array([psi[: long - k] @ psi[k:] for k in range(n)])
    cov = gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    inverse, one = np.linalg.inv(cov), np.ones(n)
    mean = (one @ inverse @ w) / (one @ inverse @ one) if centred else 0.0
    s = (w - mean) @ inverse @ (w - mean) / n
    return n * np.log(2 * np.pi * s) + np.linalg.slogdet(cov)[1] + n, mean


@pytest.mark.parametrize("ar,ma", [([], []), ([0.5], []), ([], [0.4]), ([0.5, -0.2], [0.3]), ([0.2, 0.1, 0.3], [0.3, -0.2, 0.1]),
                                   ([0.5, 0, 0, 0.3, -0.15], [0.2, 0, 0, -0.4, -0.08])])
def test_deviance_is_that_of_the_normal_density(ar, ma):
    rng = np.random.default_rng(1)
    lengths, rows = [30, 17], np.zeros((2, 30))
    for i, n in enumerate(lengths):
        rows[i, :n] = rng.normal(size=n)
    for centred in (False, True):
        a, m = (np.tile(np.array(x, float), (2, 1)).reshape(2, -1) for x in (ar, ma))
        dev, _, mean, _ = lk.filtered(rows, np.array(lengths), a, m, np.full(2, centred))
        for i, n in enumerate(lengths):
            want, mu = density(rows[i, :n], ar, ma, centred)
            assert dev[i] == pytest.approx(want, abs=1e-6) and mean[i] == pytest.approx(mu, abs=1e-8)


def test_coefficients_are_always_stationary():
    for c in lk.coefficients(np.random.default_rng(2).normal(0, 2, (200, 3))):
        assert np.abs(np.roots([1, *-c])).max() < 1
    assert np.allclose(lk.coefficients(np.array([[1.0, 0, 0]])), [[2 ** -0.5, 0, 0]])


def simulated(ar, ma, n, seed):
    e = np.random.default_rng(seed).normal(size=n + 300)
    w = np.zeros(n + 300)
    for t in range(5, n + 300):
        w[t] = e[t] + sum(a * w[t - i - 1] for i, a in enumerate(ar)) + sum(m * e[t - i - 1] for i, m in enumerate(ma))
    return w[300:]


def test_estimates_of_simulated_series():
    """Within three standard errors, 1 / sqrt(n) times a factor below 2, of the truth."""
    ws = [simulated([0.6], [0.4], 400, s) for s in range(6)]
    free = np.tile([True, False, False, True, False, False], (6, 1))
    dev, variance, mean, ar, ma = lk.fit(ws, free, np.zeros(6, bool), lk.plain(3), np.zeros((1, 6)))
    assert np.abs(ar[:, 0] - 0.6).max() < 0.17 and np.abs(ma[:, 0] - 0.4).max() < 0.2 and np.abs(variance - 1).max() < 0.25
    assert not ar[:, 1:].any() and not ma[:, 1:].any()


def test_seasonal_estimates():
    a, big, m, big_m = 0.5, 0.4, -0.3, -0.5
    ws = [simulated([a, 0, 0, big, -a * big], [m, 0, 0, big_m, m * big_m], 390, s) for s in range(4)]
    _, _, _, ar, ma = lk.fit(ws, np.ones((4, 4), bool), np.zeros(4, bool), lk.seasonal(4), np.array([[0.0] * 4, [0.5, 0.3, -0.5, -0.5]]))
    found = np.column_stack((ar[:, 0], ar[:, 3], ma[:, 0], ma[:, 3])).mean(axis=0)
    assert np.abs(found - [a, big, m, big_m]).max() < 0.25
    assert np.allclose(ar[:, 4], -ar[:, 0] * ar[:, 3])


def test_larger_models_never_fit_worse_and_failures_are_rows(spark):
    rng = np.random.default_rng(3)
    p = panel(spark, {"a": rng.normal(size=30) + 9, "b": np.cumsum(rng.normal(size=25)) + 50, "tiny": [1.0, 3.0, 2.0, 5.0], "flat": [4.0] * 20,
                      "zero": [0.0] * 20, "gaps": [None, 1.0, None, 2.0] * 6})
    fits = {(r.series, r.p, r.d, r.q): r for r in arima.order_fits(p, ["series"], "period", "value").collect()}
    assert len(fits) == 6 * 48
    for (s, a, d, q), r in fits.items():
        if r.failed:
            assert r.aic is None and r.ar is None
            assert s in ("tiny", "gaps")
            continue
        assert len(r.ar) == a and len(r.ma) == q
        for x in ((s, a - 1, d, q), (s, a, d, q - 1)):
            if x in fits and fits[x].failed is None and s in "ab" and a + q <= 3:
                assert r.aic - 2 <= fits[x].aic + 0.5, (s, a, d, q)  # a search may end on a ridge near the unit circle
    assert fits["tiny", 3, 2, 3].failed == "2 values for 7 parameters"
    assert fits["tiny", 0, 1, 0].failed is None


def test_forecast_is_the_recursion(spark):
    w = simulated([0.7], [], 60, 5) + 20
    p = panel(spark, {"x": w})
    r = arima.arima_search(p, ["series"], "period", "value", 1, 0, 0, periods=5).first()
    scale = np.abs(w).mean()
    phi, mean = r.ar[0], r.intercept * scale
    want = [mean + phi ** h * (w[-1] - mean) for h in range(1, 6)]
    assert r.forecast == pytest.approx(want, rel=1e-9)


def test_long_series_take_the_regression(spark, monkeypatch):
    monkeypatch.setattr(arima, "EXACT", 50)
    p = panel(spark, {"long": simulated([0.6], [], 300, 1) + 50, "short": simulated([0.6], [], 45, 2) + 50})
    out = {r.series: r for r in arima.arima_search(p, ["series"], "period", "value", 1, 1, 1).collect()}
    assert set(out) == {"long", "short"} and len(out["long"].forecast) == 40 and out["long"].forecast[-1] == pytest.approx(50, abs=2)
    season = {r.series: r for r in arima.seasonal_arima(p, ["series"], "period", "value", 4).collect()}
    assert set(season) == {"long", "short"} and all(len(r.ar) == 5 for r in season.values())


def test_joint_forest_first_step(spark):
    """The first forecast of one pure tree is the row of the leaf that the last state falls in."""
    rng = np.random.default_rng(4)
    p = panel(spark, {s: rng.normal(10, 2, 24) for s in "abc"})
    rows = cut_lineage(fc.joint_training(p, "series", "period", "value"))
    assert rows.count() == 20
    model = fc.fit_joint_forest(rows, 1, None, 2, bootstrap=False)
    last = rows.orderBy(F.desc("period")).first()
    out = {(r.series, r.step): r for r in fc.joint_forecast(rows, model, "period", periods=40).collect()}
    assert len(out) == 120 and out["a", 1].period_end == dt.date(1906, 3, 31)
    from tablewright.operators.forests import mean_of_trees
    state = np.concatenate(([1906, 1], last.y, last.x[2: 2 + 9]))[None, :]
    want = mean_of_trees(state, *model.sent().value, {})[0]
    assert [out[s, 1].forecast for s in "abc"] == pytest.approx(want.tolist())
    with pytest.raises(ValueError):
        fc.joint_training(p.crossJoin(spark.range(3000).withColumnRenamed("id", "k")).withColumn("series", F.concat("series", "k")), "series", "period", "value")
