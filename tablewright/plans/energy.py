"""Monthly energy use by source: classes, scaling, correlation, regression."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.dates import month_text
from tablewright.operators import learners as ml, profiling, regression as rg, scaling
from tablewright.operators.filters import complete_rows
from tablewright.operators.reshape import column_groups
from tablewright.operators.schema import columns_of
from tablewright.session import cut_lineage

# fixed values: the two groups of sources, and the total
GROUPS = {"natural": ["coal", "nuclear", "natural_gas"], "renewable": ["solar", "wind", "hydroelectric"]}
SOURCES = [*GROUPS["natural"], *GROUPS["renewable"]]
TOTAL = "all_fuels"


def prepare(raw: DataFrame) -> DataFrame:
    """Month text to date and complete rows only."""
    return cut_lineage(complete_rows(raw.withColumn("Month", month_text(F.col("Month")))), "energy")


def classes(ready: DataFrame, groups=None) -> dict[str, DataFrame]:
    """Per source group, the values with their quartile class (from unscaled values)."""
    parts = column_groups(ready, ["Month"], groups or GROUPS)
    return {name: scaling.quartile_label(part, columns_of(part, "number")) for name, part in parts.items()}


def scaled(ready: DataFrame) -> DataFrame:
    return scaling.minmax(ready, columns_of(ready, "number"))


def correlations(ready: DataFrame) -> DataFrame:
    return profiling.correlation_matrix(ready)


def regression(ready: DataFrame, sources=None, total: str = TOTAL, test_percent: int = 20, fit_scaler_on_train: bool = True):
    """(coefficients, cross-validation, held-out scores) of the total on calendar parts and sources."""
    sources = sources or SOURCES
    d = rg.hash_split(ml.date_features(ready, "Month"), "Month", test_percent)
    d = cut_lineage(scaling.minmax(d, [*sources, total], fit_on=F.col("is_train") if fit_scaler_on_train else None))
    features = ["month", "year", "day_of_week", *sources]
    train = d.where("is_train")
    held = rg.predict(d.where("not is_train"), rg.ols(train, features, total), features)
    return (rg.ols_coefficients(train, features, total), rg.cross_validate(train, features, total, "Month"),
            rg.regression_scores(held, total, "prediction"))
