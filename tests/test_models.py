import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions.special import f_upper, t_quantile_two_sided, t_two_sided
from tablewright.operators import arima, forecasting as fc, learners as ml, regression as rg


def quarters(n, start=2000):
    return [dt.date(start + i // 4, 3 * (i % 4) + 1, 1) for i in range(n)]


def panel(spark, series):
    return spark.createDataFrame([(s, d, float(v)) for s, vs in series.items() for d, v in zip(quarters(len(vs)), vs)],
                                 "series string, period date, value double")


def test_tail_probabilities():
    # a published regression report: t 1.019 -> 0.310, F 103.5 on (1, 181) -> 1.62e-19
    assert t_two_sided(1.019, 181) == pytest.approx(0.310, abs=5e-4)
    assert f_upper(103.5, 1, 181) == pytest.approx(1.62e-19, rel=0.02)
    assert f_upper(10.175 ** 2, 1, 181) == pytest.approx(t_two_sided(10.175, 181), rel=1e-9)
    assert t_quantile_two_sided(0.05, 10) == pytest.approx(2.228139, abs=1e-6)


@pytest.fixture(scope="module")
def linear(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2)) + [2000, 5]
    y = 3 + 0.5 * x[:, 0] - 2 * x[:, 1] + rng.normal(size=400)
    df = spark.createDataFrame([(i, "ab"[i % 2], *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                               "id int, g string, a double, b double, y double")
    return df, x, y


def test_ols_equals_numpy(spark, linear):
    df, x, y = linear
    design = np.column_stack([np.ones(400), x])
    beta, rss, *_ = np.linalg.lstsq(design, y, rcond=None)
    m = rg.ols(df, ["a", "b"], "y").first()
    assert [m["intercept"], *m["coef"]] == pytest.approx(beta.tolist(), rel=1e-6)
    cov = np.linalg.inv(design.T @ design) * rss[0] / 397
    table = {r["term"]: r for r in rg.ols_coefficients(df, ["a", "b"], "y").collect()}
    assert [table[t]["se"] for t in ("const", "a", "b")] == pytest.approx(np.sqrt(np.diag(cov)).tolist(), rel=1e-6)
    assert table["a"]["ci_low"] < 0.5 < table["a"]["ci_high"] and table["b"]["p"] < 1e-10


def test_ols_summary_identities(spark, linear):
    df, x, y = linear
    s = rg.ols_summary(df, ["a", "b"], "y", "id").first()
    design = np.column_stack([np.ones(400), x])
    e = y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
    n, rss = 400, float(e @ e)
    loglik = -n / 2 * (math.log(2 * math.pi * rss / n) + 1)
    assert s["loglik"] == pytest.approx(loglik, rel=1e-6) and s["aic"] == pytest.approx(6 - 2 * loglik, rel=1e-6)
    assert s["bic"] == pytest.approx(3 * math.log(n) - 2 * loglik, rel=1e-6)
    assert s["f"] == pytest.approx(s["r2"] / 2 / ((1 - s["r2"]) / 397), rel=1e-6)
    assert s["durbin_watson"] == pytest.approx(float(np.sum(np.diff(e) ** 2)) / rss, rel=1e-6)
    z = (e - e.mean()) / e.std()
    skew, kurt = float(np.mean(z ** 3)), float(np.mean(z ** 4))
    assert s["jarque_bera"] == pytest.approx(n / 6 * (skew ** 2 + (kurt - 3) ** 2 / 4), rel=1e-4)
    assert s["cond"] == pytest.approx(np.linalg.cond(design), rel=1e-3)
    by = rg.ols_summary(df, ["a", "b"], "y", "id", ["g"]).collect()
    assert {r["g"]: r["n"] for r in by} == {"a": 200, "b": 200}


def test_redundant_column_gets_a_finite_fit(spark, linear):
    df, *_ = linear
    m = rg.ols(df.withColumn("c", F.col("b") * 2), ["a", "b", "c"], "y").first()
    assert m["r2"] == pytest.approx(rg.ols(df, ["a", "b"], "y").first()["r2"], rel=1e-6)


def test_splits(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = rg.hash_split(df.repartition(3), "k").where("is_train")
    b = rg.hash_split(df.repartition(11), "k").where("is_train")
    assert a.exceptAll(b).count() == 0 and 1500 < a.count() < 1700
    p = rg.chronological_split(panel(spark, {"s": range(10)}), ["series"], "period")
    assert [r["is_train"] for r in p.orderBy("period").collect()] == [True] * 8 + [False] * 2


def test_cross_validation_prefers_the_intercept(spark, linear):
    df, *_ = linear
    best = rg.cross_validate(df, ["b"], "y", "id").orderBy("place").collect()
    assert best[0]["fit_intercept"] and best[0]["mean_r2"] > best[1]["mean_r2"]


def test_trend_continues_a_line(spark):
    p = panel(spark, {"up": [10 + 2 * i for i in range(12)], "flat": [5.0] * 12})
    out = {(r["series"], r["step"]): r for r in fc.trend_forecast(p, ["series"], "period", "value", 8).collect()}
    assert out[("up", 8)]["forecast"] == pytest.approx(10 + 2 * 19) and out[("flat", 3)]["forecast"] == pytest.approx(5)
    assert out[("up", 1)]["period_end"] == dt.date(2003, 3, 31)


def test_arima_recovers_an_autoregression(spark):
    rng = np.random.default_rng(4)
    def ar(phi, n):
        v = [0.0]
        for e in rng.normal(size=n + 200):
            v.append(phi * v[-1] + e)
        return (np.array(v[-n:]) + 50).tolist()
    p = panel(spark, {"ar": ar(0.7, 2000), "short": [1.0] * 9, "noise": (rng.normal(size=2000) + 50).tolist()})
    out = {r["series"]: r for r in arima.arima_search(p, ["series"], "period", "value").collect()}
    assert set(out) == {"ar", "noise"}
    assert out["ar"]["order"]["d"] == 0 and len(out["ar"]["forecast"]) == 40
    assert out["ar"]["forecast"][-1] == pytest.approx(50, abs=1.0)
    assert out["noise"]["forecast_avg"] == pytest.approx(50, abs=0.5) and abs(out["noise"]["growth_rate"]) < 3


def test_two_stage_estimates(spark):
    rng = np.random.default_rng(11)
    e = rng.normal(size=5001)
    w = [0.0]
    for t in range(1, 5001):
        w.append(0.6 * w[-1] + e[t] + 0.4 * e[t - 1])
    p = panel(spark, {"x": (np.array(w) + 100).tolist()})
    d = arima.differenced(p, ["series"], "period", "value", {"0": [1.0]})
    rows = arima.residual_lags(d, ["series"], [1], [1], start=6)
    best = arima.fit_candidates(rows, ["series"], [([1], [1])], {"0"}).first()
    assert best["ar"][0] == pytest.approx(0.6, abs=0.05) and best["ma"][0] == pytest.approx(0.4, abs=0.07)


def test_seasonal_model_repeats_a_season(spark):
    rng = np.random.default_rng(8)
    base = [100 + i + 20 * (i % 4 == 2) + rng.normal() * 0.2 for i in range(120)]
    f = arima.seasonal_arima(panel(spark, {"s": base}), ["series"], "period", "value", 8).first()["forecast"]
    want = [100 + i + 20 * (i % 4 == 2) for i in range(120, 128)]
    assert f == pytest.approx(want, abs=3)


def test_difference_weights():
    assert arima.difference_weights(2) == [1.0, -2.0, 1.0]
    assert arima.difference_weights(1, 1) == [1.0, -1.0, 0.0, 0.0, -1.0, 1.0]


def test_recursive_forest_runs_over_all_series(spark):
    p = panel(spark, {"a": [10 + (i % 4) for i in range(24)], "b": [1000 + 10 * (i % 4) for i in range(24)]})
    training = fc.forest_training(p, ["series"], "period", "value")
    model = fc.fit_panel_forest(training, trees=10)
    out = fc.recursive_forecast(training, model, ["series"], "period", periods=6).collect()
    assert len(out) == 12 and {r["step"] for r in out} == set(range(1, 7))
    assert all(9 < r["forecast"] < 14 for r in out if r["series"] == "a")
    assert all(950 < r["forecast"] < 1100 for r in out if r["series"] == "b")


def test_forest_impute_only_fills(spark):
    df = spark.createDataFrame([(i, float(i % 10), None if i % 9 == 0 else float(i % 10) * 3, 1.0) for i in range(200)],
                               "i int, x double, y double, z double")
    out = ml.forest_impute(df, ["x", "z"], "y", trees=5).orderBy("i").collect()
    assert len(out) == 200
    assert all(abs(r["y"] - r["x"] * 3) < (3.1 if r["i"] % 9 == 0 else 1e-9) for r in out)
