"""Linear regression from grouped sums, its inference report, splits and scores.

A fit needs only the means and covariances of the columns. Spark computes them for any
number of groups in one map-side combined aggregate (numerically stable, so large levels
such as calendar years do no harm); the remaining k x k solve touches one row per model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.functions.numbers import finite, ratio
from tablewright.functions.special import f_upper, t_quantile_two_sided, t_two_sided
from tablewright.operators.filters import require
from tablewright.operators.joining import null_safe_join
from tablewright.operators.ordered import lag_along
from tablewright.session import cut_lineage, measured

MODELS = 2000  # factors that a task holds before it passes them on
SHARES = 64    # parts of a model's factors that are folded side by side


def moments(df: DataFrame, features, label: str, by=()) -> DataFrame:
    """by..., n, mean (array), cov (upper triangle, population) over rows complete in all columns."""
    cols = [*features, label]
    clean = df.select(*by, *[finite(F.col(c).cast("double")).alias(c) for c in cols])
    pairs = combinations_with_replacement(cols, 2)
    rows = require(clean, *cols)
    return (rows.groupBy(*by) if by else rows.groupBy()).agg(
        F.count("*").alias("n"), F.array(*[F.avg(c) for c in cols]).alias("mean"),
        F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("cov")).where("n > 0")


def _square(upper, k: int) -> np.ndarray:
    s = np.zeros((k, k))
    s[np.triu_indices(k)] = upper
    return s + np.triu(s, 1).T


def solve(n: float, mean, cov, intercept: bool = True) -> dict:
    """Least squares of the last column on the others from means and covariances."""
    mean = np.asarray(mean, float)
    s = _square(cov, len(mean))
    if not intercept:
        s = s + np.outer(mean, mean)
    sxx, sxy = s[:-1, :-1], s[:-1, -1]
    # columns brought to unit scale before the pseudo-inverse; redundant directions get no weight
    unit = np.sqrt(np.where(np.diag(sxx) > 0, np.diag(sxx), 1.0))
    inverse = np.linalg.pinv(sxx / np.outer(unit, unit), rcond=1e-12, hermitian=True) / np.outer(unit, unit)
    coef = inverse @ sxy
    rss = max(n * (s[-1, -1] - 2 * coef @ sxy + coef @ sxx @ coef), 0.0)
    const = float(mean[-1] - coef @ mean[:-1]) if intercept else 0.0
    return {"intercept": const, "coef": coef, "rss": rss, "tss": n * s[-1, -1], "inverse": inverse}


def ols(df: DataFrame, features, label: str, by=(), intercept: bool = True) -> DataFrame:
    """by..., n, intercept, coef (array in feature order), rss, r2."""
    return fit_moments(moments(df, features, label, by), by, intercept).select(*by, "n", "intercept", "coef", "rss", "r2")


def fit_moments(table: DataFrame, by=(), intercept: bool = True) -> DataFrame:
    """Add the fit to rows of `moments`."""

    @F.pandas_udf("intercept double, coef array<double>, rss double, r2 double")
    def fit(n: pd.Series, mean: pd.Series, cov: pd.Series) -> pd.DataFrame:
        fits = [solve(*row, intercept) for row in zip(n, mean, cov)]
        return pd.DataFrame({
            "intercept": [f["intercept"] for f in fits], "coef": [f["coef"].tolist() for f in fits],
            "rss": [f["rss"] for f in fits],
            "r2": [1 - f["rss"] / f["tss"] if f["tss"] > 0 else None for f in fits]})

    return table.withColumn("f", fit("n", "mean", "cov")).select(*by, "n", "mean", "cov", "f.*")


def predict(df: DataFrame, model: DataFrame, features, by=(), into: str = "prediction") -> DataFrame:
    """Apply `ols` models as plain expressions: joined per group, or one scalar subquery."""
    if by:
        rows = null_safe_join(df, measured(model.select(*by, F.struct("intercept", "coef").alias("_m"))), by, "left")
    else:
        rows = df.withColumn("_m", model.select(F.struct("intercept", "coef")).scalar())
    terms = [F.col("_m.coef")[i] * F.col(c).cast("double") for i, c in enumerate(features)]
    return rows.withColumn(into, sum(terms, F.col("_m.intercept"))).drop("_m")


def simple_ols(df: DataFrame, x: str, y: str, by=()) -> DataFrame:
    """One-feature regression with the built-in aggregates."""
    rows = df.withColumn("_x", F.col(x).cast("double")).withColumn("_y", F.col(y).cast("double"))
    return (rows.groupBy(*by) if by else rows.groupBy()).agg(
        F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"),
        F.regr_r2("_y", "_x").alias("r2"), F.regr_count("_y", "_x").alias("n"))


def qr_factors(df: DataFrame, features, label: str, by=(), intercept: bool = True) -> DataFrame:
    """by..., n, r: the triangular factor of (1, features, label) of each model, over rows complete in all columns.

    A task folds its rows into one small factor per model, a few thousand rows at a time; factors are then folded by
    models and shares, and at last by models (a tree of two levels), so no task takes in more than a share of them.
    Unlike covariances, factors do not square the condition number of the features.
    """
    by, cols = list(by), [*features, label]
    width = len(cols) + intercept
    clean = df.select(*by, *[finite(F.col(f"`{c}`").cast("double")).alias(f"_x{i}") for i, c in enumerate(cols)])
    ready = require(clean, *[f"_x{i}" for i in range(len(cols))])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*by).schema)
    schema = (kinds + ", " if by else "") + "n long, r binary"
    shape = to_arrow_schema(ready.select(*by, F.lit(0).cast("long").alias("n"), F.lit(b"").alias("r")).schema)

    def folded(blocks: list[np.ndarray]) -> np.ndarray:
        r = np.linalg.qr(np.vstack(blocks), mode="r")
        return np.vstack((r, np.zeros((width - len(r), width)))) if len(r) < width else r

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[int, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            rows = [(*key, n, r.tobytes()) for key, (n, r) in held.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)

        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[len(by):]]) if b.num_rows else np.empty((0, len(cols)))
            x = np.column_stack((np.ones(len(x)), x)) if intercept else x
            keys = list(zip(*[c.to_pylist() for c in b.columns[: len(by)]])) if by else [()] * len(x)
            at: dict[tuple, list[int]] = {}
            for i, key in enumerate(keys):
                at.setdefault(key, []).append(i)
            for key, own in at.items():
                n, r = held.get(key, (0, np.zeros((0, width))))
                for i in range(0, len(own), 4096):
                    r = folded([r, x[own[i: i + 4096]]])
                held[key] = (n + len(own), r)
            if len(held) > MODELS:
                yield from out()
                held.clear()
        yield from out()

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        r = folded([np.frombuffer(x).reshape(width, width) for x in rows["r"]])
        return rows.iloc[:1].drop(columns=["_share"], errors="ignore").assign(n=int(rows["n"].sum()), r=[r.tobytes()])

    parts = ready.mapInArrow(local, schema).withColumn("_share", F.pmod(F.xxhash64("r"), F.lit(SHARES)).cast("int"))
    first = parts.groupBy(*by, "_share").applyInPandas(merged, schema)
    last = first if by else first.withColumn("_share", F.lit(0))
    return last.groupBy(*by or ["_share"]).applyInPandas(merged, schema)


def ols_qr(df: DataFrame, features, label: str, by=(), intercept: bool = True) -> DataFrame:
    """by..., n, intercept, coef, rss, r2, cond: least squares from triangular factors; of several best fits the one with the
    least coefficients (relative to the columns' sizes). cond is the condition number of the features (and the constant)."""
    @F.pandas_udf("intercept double, coef array<double>, rss double, r2 double, cond double")
    def fit(n: pd.Series, data: pd.Series) -> pd.DataFrame:
        out = []
        for rows, r in zip(n, data):
            r = np.frombuffer(r)
            r = r.reshape(math.isqrt(len(r)), -1)
            x, y = r[:, :-1], r[:, -1]
            unit = np.linalg.norm(x, axis=0)
            unit = np.where(unit > 0, unit, 1.0)
            u, s, v = np.linalg.svd(x / unit, full_matrices=False)
            keep = s > s.max(initial=0.0) * max(rows, x.shape[1]) * np.finfo(float).eps
            b = v.T[:, keep] @ ((u.T @ y)[keep] / s[keep]) / unit
            rss = float(np.square(y - x @ b).sum())
            # the constant's column is the first: what its direction takes off the label is the mean
            tss = float(np.square(y[1:]).sum()) if intercept else float(np.square(y).sum())
            whole = np.linalg.svd(x, compute_uv=False)
            out.append((float(b[0]) if intercept else 0.0, b[int(intercept):].tolist(), rss, 1 - rss / tss if tss > 0 else None,
                        float(whole.max() / whole.min()) if whole.min(initial=np.inf) > 0 else None))
        return pd.DataFrame(out, columns=["intercept", "coef", "rss", "r2", "cond"])

    return qr_factors(df, features, label, by, intercept).withColumn("f", fit("n", "r")).select(*by, "n", "f.*")


def ols_coefficients(df: DataFrame, features, label: str, by=(), alpha: float = 0.05) -> DataFrame:
    """by..., term, coef, se, t, p, ci_low, ci_high (the constant first)."""
    names = ["const", *features]

    @F.pandas_udf("array<struct<term:string,coef:double,se:double,t:double,p:double,ci_low:double,ci_high:double>>")
    def table(n: pd.Series, mean: pd.Series, cov: pd.Series) -> pd.Series:
        out = []
        for rows, m, c in zip(n, mean, cov):
            f, dof = solve(rows, m, c), rows - len(names)
            mx = np.asarray(m[:-1], float)
            spread = f["rss"] / dof / rows if dof > 0 else np.nan
            var = np.concatenate([[1 + mx @ f["inverse"] @ mx], np.diag(f["inverse"])]) * spread
            reach = t_quantile_two_sided(alpha, dof) if dof > 0 else np.nan
            lines = []
            for name, b, v in zip(names, [f["intercept"], *f["coef"]], var):
                se = math.sqrt(v) if v >= 0 else math.nan
                t = b / se if se > 0 else math.nan
                p = t_two_sided(t, dof) if dof > 0 and not math.isnan(t) else math.nan
                lines.append({"term": name, "coef": b, "se": se, "t": t, "p": p,
                              "ci_low": b - reach * se, "ci_high": b + reach * se})
            out.append(lines)
        return pd.Series(out)

    m = moments(df, features, label, by)
    return m.select(*by, F.inline(table("n", "mean", "cov")))


def residual_diagnostics(df: DataFrame, residual: str, order, by=()) -> DataFrame:
    """Durbin-Watson, skew, kurtosis, Jarque-Bera and omnibus statistics of residuals.

    The order-dependent term uses the chunked lag, so no task sorts the whole table.
    """
    rows = lag_along(require(df, residual), by, order, residual, "_prev")
    e = F.col(residual)
    d = e - F.col("_prev")
    a = (rows.groupBy(*by) if by else rows.groupBy()).agg(
        F.count("*").alias("n"), F.sum(e * e).alias("ss"), F.sum(d * d).alias("sd"),
        F.skewness(e).alias("skew"), (F.kurtosis(e) + 3).alias("kurtosis"))
    n = F.col("n").cast("double")
    # D'Agostino's skewness and Anscombe-Glynn kurtosis scores
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + F.sqrt(2 * (b2 - 1))
    u = F.col("skew") * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2))) / F.sqrt(2 / (w2 - 1))
    z1 = F.log(u + F.sqrt(u * u + 1)) / F.sqrt(0.5 * F.log(w2))
    ek = 3 * (n - 1) / (n + 1)
    vk = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("kurtosis") - ek) / F.sqrt(vk)
    sb = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    g = 6 + 8 / sb * (2 / sb + F.sqrt(1 + 4 / (sb * sb)))
    z2 = ((1 - 2 / (9 * g)) - F.cbrt((1 - 2 / g) / (1 + x * F.sqrt(2 / (g - 4))))) / F.sqrt(2 / (9 * g))
    jb = n / 6 * (F.col("skew") * F.col("skew") + (F.col("kurtosis") - 3) * (F.col("kurtosis") - 3) / 4)
    k2 = F.when(n >= 8, z1 * z1 + z2 * z2)
    return a.select(*by, "n", "ss", ratio(F.col("sd"), F.col("ss")).alias("durbin_watson"), "skew", "kurtosis",
                    jb.alias("jarque_bera"), F.exp(-jb / 2).alias("jb_p"),
                    k2.alias("omnibus"), F.exp(-k2 / 2).alias("omnibus_p"))


def ols_summary(df: DataFrame, features, label: str, order, by=()) -> DataFrame:
    """One row per model with the fit, information criteria and residual diagnostics."""
    k = len(features)

    @F.pandas_udf("f double, f_p double, cond double")
    def extra(n: pd.Series, mean: pd.Series, cov: pd.Series) -> pd.DataFrame:
        out = []
        for rows, m, c in zip(n, mean, cov):
            f, dof = solve(rows, m, c), rows - k - 1
            stat = (f["tss"] - f["rss"]) / k / (f["rss"] / dof) if dof > 0 and f["rss"] > 0 else math.nan
            full = np.concatenate([[1.0], m[:-1]])
            gram = np.outer(full, full)
            gram[1:, 1:] += _square(c, k + 1)[:-1, :-1]
            eig = np.linalg.eigvalsh(gram)
            out.append((stat, f_upper(stat, k, dof) if dof > 0 and not math.isnan(stat) else math.nan,
                        math.sqrt(eig[-1] / eig[0]) if eig[0] > 0 else math.inf))
        return pd.DataFrame(out, columns=["f", "f_p", "cond"])

    # one pass for the fit, one for the residuals; the diagnostics read only the stored residuals
    table = measured(moments(df, features, label, by))
    model = measured(fit_moments(table, by).withColumn("x", extra("n", "mean", "cov")).select(
        *by, "n", "intercept", "coef", "rss", "r2", "x.*"))
    fitted = predict(df, model, features, by, "_fit")
    orders = [order] if isinstance(order, str) else list(order)
    resid = cut_lineage(fitted.select(*by, *orders, (F.col(label).cast("double") - F.col("_fit")).alias("_e")))
    diag = residual_diagnostics(resid, "_e", orders, by).drop("n", "ss")
    if by:
        both = null_safe_join(model, diag, by, "inner")
    else:
        both = model.withColumn("_d", diag.select(F.struct("*")).scalar()).select(*model.columns, "_d.*")
    n = F.col("n").cast("double")
    loglik = -n / 2 * (F.log(2 * F.lit(math.pi) * F.col("rss") / n) + 1)
    return both.select(
        *by, "n", (F.col("n") - k - 1).alias("df_resid"), F.lit(k).alias("df_model"), "r2",
        (1 - (1 - F.col("r2")) * (n - 1) / (n - k - 1)).alias("adj_r2"), "f", "f_p", loglik.alias("loglik"),
        (2 * (k + 1) - 2 * loglik).alias("aic"), (F.log(n) * (k + 1) - 2 * loglik).alias("bic"),
        "omnibus", "omnibus_p", "durbin_watson", "skew", "kurtosis", "jarque_bera", "jb_p", "cond")


def hash_bucket(*keys: str, seed: int = 42) -> Column:
    """A number in [0, 2^32) from the row key alone: the same for any partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_split(df: DataFrame, keys, test_percent: int = 20, seed: int = 42, into: str = "is_train") -> DataFrame:
    """Mark training rows by a seeded hash of the key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.withColumn(into, hash_bucket(*keys, seed=seed) % 100 >= test_percent)


def chronological_split(panel: DataFrame, series, order: str, share: float = 0.8, into: str = "is_train") -> DataFrame:
    """Mark the first floor(share * n) periods of each series as training rows."""
    w = Window.partitionBy(*series)
    position = F.row_number().over(w.orderBy(order)) - 1
    return panel.withColumn("_t", position).withColumn("_n", F.count("*").over(w)).withColumn(
        into, F.col("_t") < F.floor(F.col("_n") * share)).drop("_t", "_n")


def regression_scores(df: DataFrame, label: str, prediction: str, by=()) -> DataFrame:
    """MAE, MSE, RMSE and R2 over rows that have both values."""
    e = F.col(label) - F.col(prediction)
    rows = df.where(e.isNotNull())
    mse = F.avg(e * e)
    return (rows.groupBy(*by) if by else rows.groupBy()).agg(
        F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        (1 - ratio(mse, F.var_pop(label))).alias("r2"))


def cross_validate(df: DataFrame, features, label: str, keys, folds: int = 5, seed: int = 42, by=()) -> DataFrame:
    """Cross-validated R2 of the linear model with and without intercept, from one pass.

    Each fold contributes its means and covariances; a training set is the pooled rest, and
    the score on the held-out fold also follows from its moments. Best setting first.
    """

    @F.pandas_udf("array<struct<fit_intercept:boolean,mean_r2:double,std_r2:double>>")
    def score(parts: pd.Series) -> pd.Series:
        out = []
        for rows in parts:
            folds_ = [(r["n"], np.asarray(r["mean"], float), _square(r["cov"], len(r["mean"]))) for r in rows]
            lines = []
            for intercept in (True, False):
                r2 = []
                for i, (n, m, s) in enumerate(folds_):
                    rest = [f for j, f in enumerate(folds_) if j != i]
                    total = sum(f[0] for f in rest)
                    if not total or s[-1, -1] <= 0:
                        continue
                    mean = sum(f[0] * f[1] for f in rest) / total
                    cov = sum(f[0] * (f[2] + np.outer(f[1] - mean, f[1] - mean)) for f in rest) / total
                    fit = solve(total, mean, cov[np.triu_indices(len(mean))], intercept)
                    b = fit["coef"]
                    bias = m[-1] - fit["intercept"] - b @ m[:-1]
                    sse = s[-1, -1] - 2 * b @ s[:-1, -1] + b @ s[:-1, :-1] @ b + bias * bias
                    r2.append(1 - sse / s[-1, -1])
                lines.append({"fit_intercept": intercept, "mean_r2": float(np.mean(r2)) if r2 else None,
                              "std_r2": float(np.std(r2)) if r2 else None})
            out.append(sorted(lines, key=lambda x: -(x["mean_r2"] or -np.inf)))
        return pd.Series(out)

    fold = (hash_bucket(*([keys] if isinstance(keys, str) else keys), seed=seed) % folds).alias("_fold")
    parts = moments(df.select("*", fold), features, label, [*by, "_fold"])
    gathered = (parts.groupBy(*by) if by else parts.groupBy()).agg(
        F.collect_list(F.struct("n", "mean", "cov")).alias("p"))  # one entry per fold
    return gathered.select(*by, F.posexplode(score("p")).alias("place", "s")).select(
        *by, (F.col("place") + 1).alias("place"), "s.*")
