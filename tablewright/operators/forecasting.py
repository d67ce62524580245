"""Forecasts for all series of a panel at once: trend lines, a recursive panel forest and a joint forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window

from tablewright.functions.dates import quarter_from_index, quarter_index
from tablewright.operators.forests import Forest, fit_arrays, mean_of_trees
from tablewright.operators.joining import null_safe_join
from tablewright.operators.learners import random_forest
from tablewright.operators.panel import lag_matrix
from tablewright.operators.regression import simple_ols


def future_calendar(panel: DataFrame, date: str, periods: int = 40) -> DataFrame:
    """step 1..periods with the quarter end after the last observed quarter."""
    last = panel.agg(F.max(quarter_index(F.col(date))).alias("i"))
    steps = last.select("i", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step"))
    start = quarter_from_index(F.col("i") + F.col("step"))
    return steps.select("step", F.last_day(F.add_months(start, 2)).alias("period_end"))


def trend_fit(panel: DataFrame, series, date: str, value: str) -> DataFrame:
    """Trend line per series on the quarter number, with the last observed quarter."""
    rows = panel.withColumn("_t", quarter_index(F.col(date)))
    last = rows.groupBy(*series).agg(F.max("_t").alias("last_t"))
    return null_safe_join(simple_ols(rows, "_t", value, series), last, series, "inner")


def trend_forecast(panel: DataFrame, series, date: str, value: str, periods: int = 40) -> DataFrame:
    """Extrapolate each series' trend: series..., step, period_end, forecast."""
    fit = trend_fit(panel, series, date, value)
    steps = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(periods))))
    t = F.col("last_t") + F.col("step")
    return steps.select(*series, "step", F.last_day(F.add_months(quarter_from_index(t), 2)).alias("period_end"),
                        (F.col("intercept") + F.col("slope") * t).alias("forecast"))


def trend_holdout(panel: DataFrame, series, date: str, value: str, is_train: str) -> DataFrame:
    """Predictions of the trend fitted on the training periods, for the held-out ones."""
    rows = panel.withColumn("_t", quarter_index(F.col(date)))
    fit = simple_ols(rows.where(F.col(is_train)), "_t", value, series).select(*series, "slope", "intercept")
    held = null_safe_join(rows.where(~F.col(is_train)), fit, series, "inner")
    return held.withColumn("prediction", F.col("intercept") + F.col("slope") * F.col("_t")).drop("_t", "slope", "intercept")


def forest_features(lags: int) -> list[str]:
    return ["_year", "_quarter", "_level", *[f"lag{i}" for i in range(1, lags + 1)]]


def forest_training(panel: DataFrame, series, date: str, value: str, lags: int = 4, fit_on: Column | None = None) -> DataFrame:
    """Training rows of the panel forest: calendar, series level and the own lags over the level.

    ``fit_on`` limits the rows the level is taken from (those a score must not have seen are left out); a level of
    zero counts as one, so a series of zeros is kept.
    """
    size = F.abs(F.col(value).cast("double"))
    level = panel.groupBy(*series).agg(F.avg(size if fit_on is None else F.when(fit_on, size)).alias("_level"))
    level = level.withColumn("_level", F.coalesce(F.nullif("_level", F.lit(0.0)), F.lit(1.0)))
    rows = null_safe_join(panel, level, series, "inner").withColumn("_v", F.col(value) / F.col("_level"))
    return lag_matrix(rows, series, date, "_v", lags).withColumn("_year", F.year(date)).withColumn("_quarter", F.quarter(date))


def fit_panel_forest(training: DataFrame, lags: int = 4, trees: int = 50, max_depth: int = 8, min_split: int = 5,
                     seed: int = 42) -> Forest:
    """One forest for every series, so the fit is one distributed job."""
    return random_forest(training, forest_features(lags), "_v", trees, max_depth, min_split, seed)


def _calendar(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Year and quarter of a quarter number."""
    return t // 4, t % 4 + 1


def recursive_forecast(training: DataFrame, model: Forest, series, date: str, lags: int = 4, periods: int = 40) -> DataFrame:
    """Forecast step by step, each prediction becoming the newest lag: series..., step, period_end, forecast.

    The model is sent to the tasks, and each walks all steps for its share of the series: one job whatever the horizon,
    with nothing but a series' last lags as its state. A forest too large to be sent is an error; ``max_depth`` bounds its size.
    """
    sent, opened = model.sent(), {}
    w = Window.partitionBy(*series).orderBy(F.desc(date))
    state = training.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(
        *series, "_level", quarter_index(F.col(date)).alias("_t"), F.array("_v", *[f"lag{i}" for i in range(1, lags)]).cast("array<double>").alias("_lags"))

    def walk(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for last, level, recent in batches:
            t, level, recent = last.to_numpy(), level.to_numpy(), np.array(recent.tolist(), float).reshape(len(last), -1)
            path = np.empty((len(t), periods))
            for step in range(periods):
                year, quarter = _calendar(t + step + 1)
                path[:, step] = mean_of_trees(np.column_stack((year, quarter, level, recent)), *sent.value, opened)[:, 0]
                recent = np.column_stack((path[:, step], recent[:, :-1]))
            yield pd.Series(list(path))

    state = state.withColumn("_path", F.pandas_udf(walk, "array<double>")("_t", "_level", "_lags"))
    path = state.select(*series, "_level", "_t", F.posexplode("_path").alias("_i", "_v"))
    start = quarter_from_index(F.col("_t") + F.col("_i") + 1)
    return path.select(*series, (F.col("_i") + 1).alias("step"), F.last_day(F.add_months(start, 2)).alias("period_end"),
                       (F.col("_v") * F.col("_level")).alias("forecast"))


#: Numbers in a row of the joint table: lags times series.
WIDEST = 20_000


def joint_training(panel: DataFrame, series: str, date: str, value: str, lags: int = 4) -> DataFrame:
    """One row per period: date, names, x (year, quarter, the values of all series in each of the ``lags`` periods before,
    the latest first) and y (all series). Only periods that have every series, after as many such periods, are kept.

    A row holds all series, so their number is bounded: above WIDEST numbers a row, use `forest_training`.
    """
    rows = panel.where(F.col(value).isNotNull()).select(F.col(series).cast("string").alias("_s"), F.col(date).alias("_d"), F.col(value).cast("double").alias("_v"))
    size = rows.select("_s").distinct().count()
    if size * lags > WIDEST:
        raise ValueError(f"{size} series times {lags} lags are more than {WIDEST} numbers in a row: fit a panel forest instead")
    whole = rows.groupBy("_d").agg(F.array_sort(F.collect_list(F.struct("_s", "_v"))).alias("_all")).where(F.size("_all") == size)
    w = Window.orderBy("_d")  # one row per period
    y = F.col("_all._v")
    lagged = whole.select("_d", F.col("_all._s").alias("names"), y.alias("y"), *[F.lag(y, i).over(w).alias(f"_{i}") for i in range(1, lags + 1)])
    x = F.concat(F.array(F.year("_d").cast("double"), F.quarter("_d").cast("double")), *[F.col(f"_{i}") for i in range(1, lags + 1)])
    return lagged.where(F.col(f"_{lags}").isNotNull()).select(F.col("_d").alias(date), "names", x.alias("x"), "y")


def fit_joint_forest(training: DataFrame, trees: int = 50, max_depth: int | None = 8, min_split: int = 5, seed: int = 42,
                     bootstrap: bool = True) -> Forest:
    """One forest whose leaves hold all series at once; a split lowers the squared error summed over the series."""
    return fit_arrays(training, ["x"], trees, max_depth, min_split, seed, bootstrap)


def joint_scores(training: DataFrame, model: Forest, date: str) -> DataFrame:
    """date, series, value, prediction of the rows of a joint table."""
    sent, opened = model.sent(), {}

    def mean(xs: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in xs:
            yield pd.Series(list(mean_of_trees(np.array(x.tolist(), float).reshape(len(x), -1), *sent.value, opened)))

    rows = training.withColumn("p", F.pandas_udf(mean, "array<double>")("x"))
    each = rows.select(date, F.inline(F.arrays_zip("names", "y", "p")))
    return each.select(date, F.col("names").alias("series"), F.col("y").alias("value"), F.col("p").alias("prediction"))


def joint_forecast(training: DataFrame, model: Forest, date: str, lags: int = 4, periods: int = 40) -> DataFrame:
    """series, step, period_end, forecast: every step's vector becomes the newest lag of the next."""
    sent, opened = model.sent(), {}
    last = training.orderBy(F.desc(date)).limit(1).select("names", quarter_index(F.col(date)).alias("t"), "x", "y")

    def walk(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for t, x, y in batches:
            out = []
            for t0, x0, y0 in zip(t, x, y):
                recent, path = np.concatenate((y0, x0[2: 2 + len(y0) * (lags - 1)])), []
                for step in range(1, periods + 1):
                    row = np.concatenate((_calendar(t0 + step), recent))[None, :]
                    path.append(mean_of_trees(row, *sent.value, opened)[0])
                    recent = np.concatenate((path[-1], recent))[: len(recent)]
                out.append([p.tolist() for p in path])
            yield pd.Series(out)

    path = last.select("names", "t", F.posexplode(F.pandas_udf(walk, "array<array<double>>")("t", "x", "y")).alias("i", "f"))
    each = path.select("t", "i", F.inline(F.arrays_zip("names", "f")))
    end = F.last_day(F.add_months(quarter_from_index(F.col("t") + F.col("i") + 1), 2))
    return each.select(F.col("names").alias("series"), (F.col("i") + 1).alias("step"), end.alias("period_end"), F.col("f").alias("forecast"))
