"""Life expectancy by group with population: cleaning, models, projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.numbers import decade, money, to_long
from tablewright.operators import joining, learners as ml, missing, regression as rg, reshape
from tablewright.operators.schema import trim_headers

LIFE, DEATHS, POPULATION = "Average Life Expectancy (Years)", "Age-adjusted Death Rate", "Resident Population"
GROUPS = ["Race", "Sex"]
# fixed values: census count used for the first decade
CENSUS_1900 = 76212168


def national_population(raw: DataFrame) -> DataFrame:
    """(Decade, Resident Population) of the whole nation."""
    nation = raw.where(F.col("Geography Type") == "Nation")
    return nation.select(F.col("Year").alias("Decade"), to_long(F.col(f"`{POPULATION}`")).alias(POPULATION))


def combine(life: DataFrame, population: DataFrame) -> DataFrame:
    """Median fill within group, decade join, numbers from text, census fill for 1900-1909."""
    rows = missing.fill_group_median(trim_headers(life), LIFE, GROUPS, fallback=False)
    rows = rows.withColumn("Decade", decade(F.col("Year"))).withColumn(DEATHS, money(F.col(f"`{DEATHS}`").cast("string")))
    rows = joining.lookup(rows, national_population(population), "Decade")
    return missing.fill_by_rule(rows, POPULATION, F.col("Year").between(1900, 1909), CENSUS_1900)


def model_table(combined: DataFrame, levels=None) -> tuple[DataFrame, list[str], dict]:
    """Dummies for the groups; (table, feature names, levels)."""
    levels = levels or {g: reshape.levels_of(combined, g) for g in GROUPS}
    wide = reshape.dummies(combined.drop(DEATHS, POPULATION), GROUPS, levels)
    features = ["Year", "Decade", *[f"{g}_{v}" for g in GROUPS for v in levels[g]]]
    return wide, features, levels


def fit(wide: DataFrame, features, trees: int = 100, test_percent: int = 25, seed: int = 42):
    """Linear, tree and forest models on a hash split: (marked table, linear model, tree models)."""
    marked = rg.hash_split(wide, features, test_percent, seed)
    train = marked.where("is_train").withColumnRenamed(LIFE, "_y")
    safe = {c: f"_f{i}" for i, c in enumerate(features)}
    train = train.withColumnsRenamed(safe)
    models = {"tree": ml.decision_tree(train, list(safe.values()), "_y"),
              "forest": ml.random_forest(train, list(safe.values()), "_y", trees)}
    return marked, rg.ols(train, list(safe.values()), "_y"), models, safe


def predict_all(table: DataFrame, linear: DataFrame, models, safe: dict[str, str]) -> DataFrame:
    """All three predictions side by side, the groups restored from their dummies."""
    rows = table.withColumnsRenamed(safe)
    scored = ml.score_all(rg.predict(rows, linear, list(safe.values()), into="linear"), models, list(safe.values()))
    named = scored.withColumnsRenamed({v: k for k, v in safe.items()})
    for g in GROUPS:
        named = reshape.undummies(named, g, g)
    return named


def future_table(combined: DataFrame, levels, first: int = 2018, last: int = 2037) -> DataFrame:
    """Dummies for every group combination and future year."""
    grid = joining.category_grid(combined, GROUPS, "Year", first, last)
    return reshape.dummies(grid.withColumn("Decade", decade(F.col("Year"))), GROUPS, levels)
