"""Trees and boosting on Spark ML, forests, model-based imputation and side-by-side prediction."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.operators.filters import require
from tablewright.operators.forests import Forest, fit_forest, fit_predict
from tablewright.session import cut_lineage

VECTOR = "_features"
WEIGHT = "_weight"


def date_features(df: DataFrame, date: str) -> DataFrame:
    """month, year and day_of_week (Monday 0) of a date."""
    return df.withColumns({"month": F.month(date), "year": F.year(date), "day_of_week": F.weekday(date)})


def assemble(df: DataFrame, features) -> DataFrame:
    """Feature vector of the rows that have all features."""
    ready = require(df, *features)
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR).transform(ready)


def merged(df: DataFrame, features, label: str, by=()) -> DataFrame:
    """features..., by..., label, WEIGHT: rows of equal features as at most two, with their count, mean and squares about it.

    Squared errors of predictions differ by equal sums, so trees and boosting learn and stop alike. Stored: learners read it often.
    """
    at = [*features, *by]
    y = F.col(label).cast("double")
    sums = df.groupBy(*at).agg(F.count("*").alias("_n"), F.avg(y).alias("_mean"), F.stddev_pop(y).alias("_s"))
    one = F.array(F.struct(F.col("_mean").alias(label), F.col("_n").cast("double").alias(WEIGHT)))
    two = F.array(*[F.struct((F.col("_mean") + side * F.col("_s")).alias(label), (F.col("_n") / 2).alias(WEIGHT)) for side in (-1, 1)])
    return cut_lineage(sums.select(*at, F.inline(F.when(F.col("_s") > 0, two).otherwise(one))), "merged")


def decision_tree(df: DataFrame, features, label: str, max_depth: int = 30, seed: int = 42) -> Model:
    t = DecisionTreeRegressor(featuresCol=VECTOR, labelCol=label, maxDepth=max_depth, seed=seed, weightCol=WEIGHT)
    return t.fit(assemble(merged(require(df, label, *features), features, label), features))


def random_forest(df: DataFrame, features, label: str, trees: int = 100, max_depth: int | None = None,
                  min_split: int = 2, seed: int = 42) -> Forest:
    """Forest that considers every feature at each split, grown to purity unless ``max_depth`` is set."""
    return fit_forest(df, features, label, trees, max_depth, min_split, seed)


def boosted_early_stop(df: DataFrame, features, label: str, is_validation: str, rounds: int = 50,
                       max_depth: int = 5, seed: int = 42) -> Model:
    """Non-linear regressor that stops when the error on the flagged rows no longer falls."""
    g = GBTRegressor(featuresCol=VECTOR, labelCol=label, maxIter=rounds, maxDepth=max_depth, seed=seed,
                     validationIndicatorCol=is_validation, validationTol=0.001, weightCol=WEIGHT)
    return g.fit(assemble(merged(require(df, label, is_validation, *features), features, label, [is_validation]), features))


def score(df: DataFrame, model: Model | Forest, features, into: str) -> DataFrame:
    """Add a model's prediction column; the input columns are kept."""
    if isinstance(model, Forest):
        return model.predict(df, into)
    out = model.transform(assemble(df, features))
    return out.withColumnRenamed(model.getPredictionCol(), into).drop(VECTOR)


def score_all(df: DataFrame, models: dict[str, Model | Forest], features) -> DataFrame:
    """Predictions of several models side by side."""
    out = assemble(df, features)
    for name, model in models.items():
        if isinstance(model, Forest):
            out = model.predict(out, name)
        else:
            out = model.transform(out).withColumnRenamed(model.getPredictionCol(), name)
    return out.drop(VECTOR)


def long_predictions(df: DataFrame, ids, names) -> DataFrame:
    """(ids..., model, prediction)."""
    return df.unpivot(list(ids), list(names), "model", "prediction")


def forest_impute(df: DataFrame, features, target: str, trees: int = 100, max_depth: int | None = None, seed: int = 42) -> DataFrame:
    """Fill missing targets with a forest trained on the rows that have one.

    Rows missing a feature cannot be predicted and stay as they are.
    """
    ready = None
    for c in features:
        ready = F.col(c).isNotNull() if ready is None else ready & F.col(c).isNotNull()
    known, unknown = df.where(~(F.col(target).isNull() & ready)), df.where(F.col(target).isNull())
    filled = fit_predict(df, features, target, unknown, "_p", trees, max_depth, seed=seed)
    filled = filled.withColumn(target, F.col("_p")).select(*df.columns)
    return known.unionByName(filled)
