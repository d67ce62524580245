"""Reshape: pivot, unpivot, dummies, exploded series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pivot(df: DataFrame, index, column: str, value: str, levels) -> DataFrame:
    """Long to wide with a given level list; a duplicate (index, level) fails the job."""
    def cell(level) -> Column:
        hit = F.col(column) == F.lit(level)
        dup = F.raise_error(F.lit(f"duplicate entry for level {level}")).cast(df.schema[value].dataType)
        return F.when(F.count_if(hit) > 1, dup).otherwise(F.max(F.when(hit, F.col(value)))).alias(str(level))

    return df.where(F.col(column).isin(*levels)).groupBy(*index).agg(*[cell(v) for v in levels])


def pivot_pairs(df: DataFrame, index, code: str, name: str, value: str, pairs) -> DataFrame:
    """Wide table with a two-part column header, flattened to ``code|name``."""
    joined = df.withColumn("_pair", F.concat_ws("|", code, name))
    return pivot(joined, index, "_pair", value, [f"{c}|{n}" for c, n in pairs])


def unpivot(df: DataFrame, ids, cols, names: str = "variable", values: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), names, values)


def levels_of(df: DataFrame, col: str, most: int = 10_000) -> list:
    """Sorted distinct levels. They are to become columns of a schema, so they are read into the driver; above ``most`` an error."""
    found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{col} has more than {most} levels: too many for columns")
    return sorted(r[0] for r in found)


def dummies(df: DataFrame, cols, levels: dict[str, list] | None = None, sep: str = "_") -> DataFrame:
    """One 0/1 column per level (all levels kept); the source columns are dropped."""
    levels = levels or {c: levels_of(df, c) for c in cols}
    hot = {f"{c}{sep}{v}": F.when(F.col(c) == F.lit(v), 1).otherwise(0) for c in cols for v in levels[c]}
    return df.withColumns(hot).drop(*cols)


def undummies(df: DataFrame, prefix: str, into: str, sep: str = "_", drop: bool = True) -> DataFrame:
    """Inverse of `dummies` for one prefix; a row must have exactly one 1."""
    hot = [c for c in df.columns if c.startswith(prefix + sep)]
    labels = F.filter(
        F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c[len(prefix + sep):])) for c in hot]), lambda x: x.isNotNull())
    bad = F.raise_error(F.lit(f"row of {prefix} is not one-hot")).cast("string")
    out = df.withColumn(into, F.when(F.size(labels) == 1, labels[0]).otherwise(bad))
    return out.drop(*hot) if drop else out


def explode_series(df: DataFrame, array: str, step: str = "step", value: str = "value") -> DataFrame:
    """One row per array element with its position."""
    rest = [c for c in df.columns if c != array]
    return df.select(*rest, F.posexplode(array).alias(step, value))


def forecast_rows(df: DataFrame, array: str, last_date: str, value: str = "forecast", legacy_year: int | None = None):
    """Long forecast table dated one quarter end per step.

    ``legacy_year`` adds the label that counts steps as years from that year on.
    """
    out = explode_series(df, array, "step", value)
    first = F.add_months(F.trunc(F.col(last_date), "quarter"), 3)
    out = out.withColumn("period", F.last_day(F.add_months(first, F.col("step") * 3 + 2)))
    return out if legacy_year is None else out.withColumn("year_label", F.lit(legacy_year) + F.col("step"))


def column_groups(df: DataFrame, key, groups: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Split a wide frame in named column groups that share the key."""
    return {name: df.select(*key, *cols) for name, cols in groups.items()}
