"""ARIMA forecasts for every series of a panel.

Series of up to EXACT observations are fitted by exact likelihood: every (series, order) is a row, and a task takes the
rows of its batch through the Kalman filter together. A fit that fails stays as a row that says why.

Longer series are not gathered into a row. They are fitted by two-stage regression (Hannan & Rissanen, 1982), whose error is
small against that of the estimate by then: windows build the differenced series and their lags, a grouped aggregate reduces
each regression to means and covariances, and only the small solve and the forecast recursion run in Python.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window

from tablewright.functions.numbers import finite, percent_of
from tablewright.operators import likelihood
from tablewright.operators.filters import long_series_only
from tablewright.operators.joining import null_safe_join
from tablewright.operators.panel import last_mean
from tablewright.operators.regression import _square, chronological_split, moments, ols, predict, solve
from tablewright.session import cut_lineage, measured

EXACT = 400   # observations of a series that is fitted by exact likelihood
LONG_AR = 4
# what a Gaussian log-likelihood holds per row besides the logarithm of its variance
NORMAL = 1 + np.log(2 * np.pi)
SEASON = 4


def difference_weights(d: int, seasonal: int = 0, season: int = SEASON) -> list[float]:
    """Coefficients of (1 - B)^d (1 - B^s)^D, newest first."""
    out = np.array([1.0])
    for _ in range(d):
        out = np.convolve(out, [1.0, -1.0])
    for _ in range(seasonal):
        out = np.convolve(out, [1.0, *[0.0] * (season - 1), -1.0])
    return out.tolist()


def differenced(panel: DataFrame, series, date: str, value: str, choices: dict[str, list[float]]) -> DataFrame:
    """series..., diff, t, w: each differencing choice of each series, on values scaled by the series level."""
    w = Window.partitionBy(*series).orderBy(date)
    # a series of zeros keeps its scale, so it is forecast like any other
    level = F.coalesce(F.nullif(F.avg(F.abs(F.col(value))).over(Window.partitionBy(*series)), F.lit(0.0)), F.lit(1.0))
    scaled = panel.select(*series, date, finite(F.col(value).cast("double")).alias(value)).where(F.col(value).isNotNull())
    rows = scaled.withColumn("_level", level).withColumn(
        "_y", F.col(value) / F.col("_level")).withColumn("t", F.row_number().over(w))
    # the lag is over an attribute of this row set, so all choices share one window pass
    deepest = max(len(c) for c in choices.values())
    lagged = rows.select(*series, "t", "_level", "_y", *[F.lag("_y", i).over(w).alias(f"_y{i}") for i in range(1, deepest)])
    def apply(weights):
        return sum((F.lit(c) * F.col("_y" if i == 0 else f"_y{i}") for i, c in enumerate(weights) if c), F.lit(0.0))
    return lagged.select(*series, "t", "_level", "_y", F.inline(F.array(*[
        F.struct(F.lit(name).alias("diff"), apply(c).alias("w")) for name, c in choices.items()]))).where("w is not null")


def residual_lags(diffs: DataFrame, series, ar_lags, ma_lags, start: int, long_ar: int = LONG_AR) -> DataFrame:
    """Regression rows: w, its lags a<i> and lagged first-stage residuals m<j>, for t >= start.

    The first stage is a long autoregression; residuals before its first row count as 0.
    """
    keys = [*series, "diff"]
    w = Window.partitionBy(*keys).orderBy("t")
    depth = max([long_ar, *ar_lags])
    rows = diffs.select("*", *[F.lag("w", i).over(w).alias(f"a{i}") for i in range(1, depth + 1)])
    stage = [f"a{i}" for i in range(1, long_ar + 1)]
    model = ols(rows, stage, "w", keys, intercept=True)
    fitted = predict(rows, model, stage, keys, "_fit").withColumn("e", F.coalesce(F.col("w") - F.col("_fit"), F.lit(0.0)))
    out = fitted.select(*keys, "t", "_level", "_y", "w", "e", *[f"a{i}" for i in ar_lags],
                        *[F.coalesce(F.lag("e", j).over(w), F.lit(0.0)).alias(f"m{j}") for j in ma_lags])
    return out.withColumn("used", F.col("t") >= start)


def _roots_inside(coefs, lags) -> float:
    """Largest modulus among the inverse roots of 1 - sum c_i B^i."""
    if not len(coefs):
        return 0.0
    poly = np.zeros(max(lags) + 1)
    poly[0] = 1.0
    for c, i in zip(coefs, lags):
        poly[i] -= c
    return float(np.max(np.abs(np.roots(poly)), initial=0.0))


RESULT = ("diff string, p int, q int, n bigint, aic double, sigma2 double, intercept double, "
          "ar array<double>, ma array<double>")


def fit_candidates(rows: DataFrame, series, candidates, constant_for) -> DataFrame:
    """series..., and the candidate with the least AIC per series.

    ``candidates`` are (ar lags, ma lags); ``constant_for`` the differencing choices fitted
    with an intercept. Candidates outside the stationary and invertible region are skipped;
    a series always keeps at least the one without lags.
    """
    ar = sorted({i for a, _ in candidates for i in a})
    ma = sorted({j for _, m in candidates for j in m})
    names = [f"a{i}" for i in ar] + [f"m{j}" for j in ma]

    @F.pandas_udf(f"array<struct<{RESULT.replace(' ', ':').replace(',:', ',')}>>")
    def search(diff: pd.Series, n: pd.Series, mean: pd.Series, cov: pd.Series) -> pd.Series:
        out = []
        for d, rows_, m, c in zip(diff, n, mean, cov):
            m, s = np.asarray(m, float), _square(c, len(m))
            found = []
            for a, q in candidates:
                k = len(a) + len(q)
                const = d in constant_for
                if rows_ <= k + const:
                    continue
                take = [names.index(f"a{i}") for i in a] + [names.index(f"m{j}") for j in q] + [len(names)]
                part = s[np.ix_(take, take)]
                f = solve(rows_, m[take], part[np.triu_indices(k + 1)], const)
                phi, theta = f["coef"][:len(a)], f["coef"][len(a):]
                if max(_roots_inside(phi, a), _roots_inside(-theta, q)) >= 0.999:
                    continue
                sigma2 = max(f["rss"] / rows_, 1e-300)
                found.append({"diff": d, "p": len(a), "q": len(q), "n": int(rows_),
                              "aic": rows_ * (np.log(sigma2) + NORMAL) + 2 * (k + const + 1), "sigma2": sigma2,
                              "intercept": f["intercept"], "ar": [float(v) for v in phi], "ma": [float(v) for v in theta]})
            out.append(found)
        return pd.Series(out)

    m = moments(rows.where("used"), names, "w", [*series, "diff"])
    best = m.select(*series, F.inline(search("diff", "n", "mean", "cov")))
    fields = [c.split()[0] for c in RESULT.split(", ")]
    # at most three differencing choices times the candidates per series; ties go to the smaller model
    pick = F.min_by(F.struct(*fields), F.struct("aic", F.col("p") + F.col("q"), "p", "diff")).alias("_b")
    return best.groupBy(*series).agg(pick).select(*series, "_b.*")


def fit_seasonal(rows: DataFrame, series, season: int = SEASON, rounds: int = 25, edge: float = 0.98) -> DataFrame:
    """The multiplicative model: two ordinary and two seasonal coefficients, products at lag s + 1.

    Least squares in the four parameters by Gauss-Newton steps on the moments alone; every
    factor is kept inside the stationary and invertible region.
    """
    lags = [1, season, season + 1]
    names = [f"a{i}" for i in lags] + [f"m{i}" for i in lags]

    @F.pandas_udf(RESULT)
    def fit(diff: pd.Series, n: pd.Series, mean: pd.Series, cov: pd.Series) -> pd.DataFrame:
        out = []
        for d, rows_, m, c in zip(diff, n, mean, cov):
            m = np.asarray(m, float)
            s = _square(c, len(m)) + np.outer(m, m)
            sxx, sxy, syy = s[:-1, :-1], s[:-1, -1], s[-1, -1]

            def expand(v):
                return np.array([v[0], v[1], -v[0] * v[1], v[2], v[3], v[2] * v[3]])

            def loss(v):
                b = expand(v)
                return syy - 2 * b @ sxy + b @ sxx @ b

            v = np.zeros(4)
            for _ in range(rounds):
                j = np.zeros((6, 4))
                j[0, 0] = j[1, 1] = j[3, 2] = j[4, 3] = 1.0
                j[2, :2] = -v[1], -v[0]
                j[5, 2:] = v[3], v[2]
                step = np.linalg.pinv(j.T @ sxx @ j, rcond=1e-10) @ (j.T @ (sxy - sxx @ expand(v)))
                size, now = 1.0, loss(v)
                while size > 1e-6 and loss(np.clip(v + size * step, -edge, edge)) > now:
                    size /= 2
                new = np.clip(v + size * step, -edge, edge)
                if loss(new) > now or np.max(np.abs(new - v)) < 1e-10:
                    break
                v = new
            b, sigma2 = expand(v), max(loss(v), 1e-300)
            out.append((d, 3, 3, int(rows_), rows_ * (np.log(sigma2) + NORMAL) + 2 * 5, sigma2, 0.0, b[:3].tolist(), b[3:].tolist()))
        return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])

    m = moments(rows.where("used"), names, "w", [*series, "diff"])
    return m.withColumn("f", fit("diff", "n", "mean", "cov")).select(*series, "f.*")


def run_forward(rows: DataFrame, best: DataFrame, panel: DataFrame, series, date: str, value: str, choices, lag_sets,
                periods: int) -> DataFrame:
    """Add ``forecast`` (array of ``periods`` values) by the recursion on each series' last values."""
    need_y = max(max(len(c) for c in choices.values()) - 1 + max([0, *[max(a, default=0) for a, _ in lag_sets.values()]]), 1)
    need_e = max(1, *[max(m, default=0) for _, m in lag_sets.values()])
    w = Window.partitionBy(*series).orderBy(F.desc(date))
    tail_y = panel.select(*series, date, F.col(value).cast("double").alias("_v")).where(finite(F.col("_v")).isNotNull()).withColumn(
        "_rn", F.row_number().over(w)).where(F.col("_rn") <= need_y).groupBy(*series).agg(
        F.sort_array(F.collect_list(F.struct("_rn", "_v"))).alias("_ys"))
    we = Window.partitionBy(*series, "diff").orderBy(F.desc("t"))
    tail_e = rows.withColumn("_rn", F.row_number().over(we)).where(F.col("_rn") <= need_e).groupBy(*series, "diff").agg(
        F.sort_array(F.collect_list(F.struct("_rn", "e"))).alias("_es"), F.max("_level").alias("_level"))
    joined = null_safe_join(null_safe_join(best, tail_e, [*series, "diff"], "inner"), tail_y, series, "inner")

    @F.pandas_udf("array<double>")
    def recurse(diff: pd.Series, p: pd.Series, q: pd.Series, const: pd.Series, ar: pd.Series, ma: pd.Series,
                ys: pd.Series, es: pd.Series, level: pd.Series) -> pd.Series:
        out = []
        for d, p_, q_, c, phi, theta, y, e, lv in zip(diff, p, q, const, ar, ma, ys, es, level):
            a_lags, m_lags = lag_sets[(p_, q_)]
            poly = np.zeros(max(a_lags, default=0) + 1)
            poly[0] = 1.0
            for v, i in zip(phi, a_lags):
                poly[i] -= v
            weights = -np.convolve(poly, choices[d])[1:]
            past = [r["_v"] / lv for r in y]
            errs = [r["e"] for r in e]
            path = []
            for _ in range(periods):
                nxt = c + sum(b * past[i] for i, b in enumerate(weights[:len(past)]))
                nxt += sum(v * errs[j - 1] for v, j in zip(theta, m_lags) if j <= len(errs))
                past.insert(0, nxt)
                errs.insert(0, 0.0)
                path.append(float(nxt * lv))
            out.append(path)
        return pd.Series(out)

    return joined.withColumn("forecast", recurse("diff", "p", "q", "intercept", "ar", "ma", "_ys", "_es", "_level")).drop(
        "_ys", "_es", "_level")


def by_length(panel: DataFrame, series, value: str) -> tuple[DataFrame, DataFrame]:
    """The rows of series with up to EXACT finite values, and the others'."""
    n = measured(panel.groupBy(*series).agg(F.count(finite(F.col(value).cast("double"))).alias("_n")))
    both = null_safe_join(panel, n, series, "inner")
    return both.where(F.col("_n") <= EXACT).drop("_n"), both.where(F.col("_n") > EXACT).drop("_n")


def in_rows(panel: DataFrame, series, date: str, value: str) -> DataFrame:
    """series..., _level, _y: the finite values in time order over their mean size; a series of zeros has level 1."""
    v = finite(F.col(value).cast("double"))
    rows = panel.select(*series, F.col(date).alias("_d"), v.alias("_v")).where("_v is not null")
    own = rows.groupBy(*series).agg(F.array_sort(F.collect_list(F.struct("_d", "_v"))).alias("_a"), F.avg(F.abs("_v")).alias("_l"))
    level = F.when(F.col("_l") > 0, F.col("_l")).otherwise(1.0)
    return own.select(*series, level.alias("_level"), F.transform("_a", lambda x: x["_v"] / level).alias("_y"))


FIT = "n bigint, aic double, sigma2 double, intercept double, ar array<double>, ma array<double>, failed string"


def _differences(y: np.ndarray, weights: list[float]) -> np.ndarray:
    return np.convolve(y, weights, "valid") if len(y) >= len(weights) else np.empty(0)


def _fitted(ws: list[np.ndarray], free: np.ndarray, centred: np.ndarray, spread, starts: np.ndarray, lags: list[tuple[int, int]]) -> pd.DataFrame:
    """A row of FIT per series; too short a one, or one without a finite likelihood, says so. ``lags``: how many to return."""
    count = free.sum(axis=1) + centred + 1
    fine = np.array([len(w) > c and bool(np.isfinite(w).all()) for w, c in zip(ws, count)], bool)
    out: list[tuple] = [(len(w), None, None, None, None, None, f"{len(w)} values for {c} parameters") for w, c in zip(ws, count)]
    at = np.flatnonzero(fine)
    if len(at):
        found = likelihood.fit([ws[i] for i in at], free[at], centred[at], spread, starts)
        for i, dev, variance, mean, ar, ma in zip(at, *found):
            p, q = lags[i]
            if np.isfinite(dev):
                out[i] = (len(ws[i]), float(dev + 2 * count[i]), float(variance), float(mean), ar[:p].tolist(), ma[:q].tolist(), None)
            else:
                out[i] = (len(ws[i]), None, None, None, None, None, "no finite likelihood")
    return pd.DataFrame(out, columns=[c.split()[0] for c in FIT.split(", ")]).astype({"failed": object})


def order_fits(panel: DataFrame, series, date: str, value: str, max_p: int = 3, max_d: int = 2, max_q: int = 3) -> DataFrame:
    """series..., _level, _y, p, d, q and the columns of FIT: every order of every series by exact likelihood.

    The likelihood is that of the differenced series; without differencing it has a mean. Rows are dealt by series and
    order, so one series' orders spread over tasks. A failed fit has its reason in ``failed`` and nothing else.
    """
    most = max(max_p, max_q, 1)
    starts = np.array([np.zeros(2 * most), np.tile([0.6, -0.6, 0.6], most)[: 2 * most], np.full(2 * most, -0.8), np.full(2 * most, 0.9)])

    @F.pandas_udf(FIT)
    def search(y: pd.Series, p: pd.Series, d: pd.Series, q: pd.Series) -> pd.DataFrame:
        ws = [_differences(np.asarray(v, float), difference_weights(int(k))) for v, k in zip(y, d)]
        lag = np.arange(most)
        free = np.concatenate((lag[None, :] < p.to_numpy()[:, None], lag[None, :] < q.to_numpy()[:, None]), axis=1)
        return _fitted(ws, free, (d == 0).to_numpy(), likelihood.plain(most), starts, list(zip(p, q)))

    def numbers(name: str, most: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(most))).alias(name)

    rows = in_rows(panel, series, date, value).select("*", numbers("p", max_p)).select("*", numbers("d", max_d)).select("*", numbers("q", max_q))
    # few rows with much work each: a number of parts, or they would be put together again
    parts = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, *[F.col(c) for c in series], "p", "d", "q")
    return dealt.withColumn("_f", search("_y", "p", "d", "q")).select(*rows.columns, "_f.*")


def forecast_rows(fits: DataFrame, periods: int, weights: Column) -> DataFrame:
    """Add ``forecast``: the filtered state of each series' differences run ahead, and summed up again.

    ``weights`` is the differencing polynomial as an array, newest first.
    """
    @F.pandas_udf("array<double>")
    def ahead(y: pd.Series, level: pd.Series, polynomial: pd.Series, mean: pd.Series, ar: pd.Series, ma: pd.Series) -> pd.Series:
        out = []
        for v, size, poly, m, phi, theta in zip(y, level, polynomial, mean, ar, ma):
            v, poly, phi, theta = (np.asarray(x, float) for x in (v, poly, phi, theta))
            w = _differences(v, poly) - m
            state = likelihood.filtered(w[None, :], np.array([len(w)]), phi[None, :], theta[None, :], np.array([False]))[3][0]
            past, path = v[::-1][: len(poly) - 1].tolist(), []
            for _ in range(periods):
                nxt = m + state[0] - float(np.dot(poly[1:], past))
                moved = np.append(state[1:], 0.0)
                moved[: len(phi)] += phi * state[0]
                state = moved
                past = [nxt, *past][: len(poly) - 1]
                path.append(float(nxt * size))
            out.append(path)
        return pd.Series(out)

    return fits.withColumn("forecast", ahead("_y", "_level", weights, "intercept", "ar", "ma"))


def arima_search(panel: DataFrame, series, date: str, value: str, max_p: int = 3, max_d: int = 2, max_q: int = 3,
                 periods: int = 40, recent: int = 8, least: int = 10) -> DataFrame:
    """Best (p, d, q) per series by AIC, its forecast and growth.

    Of equal AIC the smaller model is taken. Series with fewer than ``least`` finite values, or without any fit that
    succeeds, are left out.
    """
    usable = cut_lineage(long_series_only(panel, series, value, least))
    short, long = by_length(usable, series, value)
    fits = cut_lineage(order_fits(short, series, date, value, max_p, max_d, max_q).drop("_level", "_y"), "fits").where("failed is null")
    names = ["p", "d", "q", *[c.split()[0] for c in FIT.split(", ")[:-1]]]
    best = fits.groupBy(*series).agg(F.min_by(F.struct(*names), F.struct("aic", F.col("p") + F.col("q"), "p", "d")).alias("_b")).select(*series, "_b.*")
    best = null_safe_join(in_rows(short, series, date, value), best, series, "inner")
    weights = F.array(*[F.lit(difference_weights(d) + [0.0] * (max_d - d)) for d in range(max_d + 1)])
    poly = F.slice(F.get(weights, F.col("d")), F.lit(1), F.col("d") + 1)
    out = forecast_rows(best, periods, poly).withColumn("order", F.struct("p", "d", "q")).drop("_level", "_y", "p", "d", "q")
    out = _with_growth(null_safe_join(out, last_mean(short, series, date, value, recent), series, "inner"))
    if long.isEmpty():
        return out
    more = two_stage_search(long, series, date, value, max_p, max_d, max_q, periods, recent)
    return out.unionByName(more.select(*out.columns))


def two_stage_search(panel: DataFrame, series, date: str, value: str, max_p: int = 3, max_d: int = 2, max_q: int = 3,
                     periods: int = 40, recent: int = 8) -> DataFrame:
    """As `arima_search`, by two-stage regression: AIC on a common sample, series whose fit fails left out."""
    choices = {str(d): difference_weights(d) for d in range(max_d + 1)}
    candidates = [(list(range(1, p + 1)), list(range(1, q + 1))) for p in range(max_p + 1) for q in range(max_q + 1)]
    diffs = differenced(panel, series, date, value, choices)
    rows = residual_lags(diffs, series, range(1, max_p + 1), range(1, max_q + 1), start=max_d + max_p + 1, long_ar=max(max_p + max_q, LONG_AR))
    best = fit_candidates(rows, series, candidates, constant_for={"0"})
    lag_sets = {(len(a), len(m)): (a, m) for a, m in candidates}
    out = run_forward(rows, best, panel, series, date, value, choices, lag_sets, periods)
    recent_avg = last_mean(panel, series, date, value, recent)
    return _with_growth(null_safe_join(out, recent_avg, series, "inner")).withColumn(
        "order", F.struct("p", F.col("diff").cast("int").alias("d"), "q")).drop("p", "q", "diff")


def seasonal_arima(panel: DataFrame, series, date: str, value: str, periods: int = 40, season: int = SEASON) -> DataFrame:
    """The fixed seasonal model (1,1,1)(1,1,1,s) for every series: its coefficients, multiplied out to s + 1 lags, and forecast array.

    A series too short for its differences and parameters is left out.
    """
    short, long = by_length(cut_lineage(panel), series, value)
    poly = difference_weights(1, 1, season)
    starts = np.array([[0.0, 0.0, 0.0, 0.0], [0.5, 0.3, -0.5, -0.5], [-0.3, -0.3, 0.3, -1.0], [0.3, 0.0, -1.2, -1.2]])

    @F.pandas_udf(FIT)
    def search(y: pd.Series) -> pd.DataFrame:
        ws = [_differences(np.asarray(v, float), poly) for v in y]
        lags = [(season + 1, season + 1)] * len(ws)
        return _fitted(ws, np.ones((len(ws), 4), bool), np.zeros(len(ws), bool), likelihood.seasonal(season), starts, lags)

    parts = int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_rows(short, series, date, value).repartition(parts, *[F.col(c) for c in series])
    fits = cut_lineage(rows.withColumn("_f", search("_y")).select(*series, "_level", "_y", "_f.*"), "fits").where("failed is null").drop("failed")
    out = forecast_rows(fits, periods, F.array(*[F.lit(float(w)) for w in poly])).drop("_level", "_y")
    if long.isEmpty():
        return out
    choices, lags = {"s": poly}, [1, season, season + 1]
    diffs = differenced(long, series, date, value, choices)
    stage = residual_lags(diffs, series, lags, lags, start=2 * season + 3, long_ar=season + 1)
    more = run_forward(stage, fit_seasonal(stage, series, season), long, series, date, value, choices, {(3, 3): (lags, lags)}, periods)

    def full(name: str) -> Column:
        """Coefficients at the lags 1, s and s + 1 as one of every lag."""
        return F.concat(F.array(F.col(name)[0]), F.array_repeat(F.lit(0.0), season - 2), F.array(F.col(name)[1], F.col(name)[2]))
    return out.unionByName(more.withColumn("ar", full("ar")).withColumn("ma", full("ma")).select(*out.columns))


def seasonal_holdout(panel: DataFrame, series, date: str, value: str, share: float = 0.8, season: int = SEASON) -> DataFrame:
    """Held-out periods of each series with the forecast of the seasonal model fitted on the earlier ones."""
    marked = cut_lineage(chronological_split(panel, series, date, share))
    held = marked.where(~F.col("is_train"))
    steps = held.groupBy(*series).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    paths = seasonal_arima(marked.where("is_train"), series, date, value, steps, season)
    path = paths.select(*series, F.posexplode("forecast").alias("_i", "prediction"))
    order = Window.partitionBy(*series).orderBy(date)
    placed = held.withColumn("_i", F.row_number().over(order) - 1)
    return null_safe_join(placed, path, [*series, "_i"], "inner").drop("_i", "is_train")


def _with_growth(df: DataFrame) -> DataFrame:
    total = F.aggregate("forecast", F.lit(0.0), lambda a, x: a + x)
    out = df.withColumn("forecast_avg", total / F.size("forecast"))
    return out.withColumn("growth_rate", percent_of(F.col("forecast_avg") - F.col("recent_avg"), F.col("recent_avg")))
