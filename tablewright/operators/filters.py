"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.numbers import finite
from tablewright.session import measured


def rows_at_max(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` equals its overall maximum (scalar subquery, no join)."""
    return df.where(F.col(col) == df.agg(F.max(col)).scalar())


def in_list(df: DataFrame, col: str, values, negate: bool = False) -> DataFrame:
    hit = F.col(col).isin(*values)
    return df.where(~hit if negate else hit)


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows missing any named column.

    One predicate per column, so each reaches the side of a join it belongs to and
    an outer join below becomes an inner one.
    """
    return reduce(lambda d, c: d.where(F.col(c).isNotNull()), cols, df)


def complete_rows(df: DataFrame) -> DataFrame:
    return require(df, *df.columns)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows where every column is missing."""
    return df.na.drop("all")


def finite_only(df: DataFrame, *cols: str) -> DataFrame:
    return reduce(lambda d, c: d.where(finite(F.col(c)).isNotNull()), cols, df)


def between_closed(df: DataFrame, col: str, low, high) -> DataFrame:
    return df.where(F.col(col).between(low, high))


def drop_ordinals(df: DataFrame, ordinal: str, *positions: int) -> DataFrame:
    """Drop rows by their ingest ordinal (e.g. a header line read as data)."""
    return df.where(~F.col(ordinal).isin(*positions))


def long_series_only(panel: DataFrame, keys, value: str, least: int = 10) -> DataFrame:
    """Keep series with at least ``least`` finite values.

    Counting is a map-side combined aggregate and the filter a semi join, so a
    long series is never gathered in one task.
    """
    usable = panel.where(finite(F.col(value)).isNotNull())
    long = usable.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return usable.join(measured(long.select(*keys)), list(keys), "left_semi")


def outside_sigma(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Rows below / above mean +- k sample deviations, with the side they fall on."""
    s = df.agg(F.struct(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))).scalar()
    out = df.withColumn("_s", s)
    low, high = F.col("_s.m") - k * F.col("_s.s"), F.col("_s.m") + k * F.col("_s.s")
    side = F.when(F.col(col) < low, "below").when(F.col(col) > high, "above")
    return out.withColumn("side", side).where(F.col("side").isNotNull()).drop("_s")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def for_year(df: DataFrame, year: int, col: str = "year") -> DataFrame:
    """Parameterised year selection, written as the SQL a user would send."""
    return df.sparkSession.sql(f"SELECT * FROM {{src}} WHERE `{col}` = :year", args={"year": year}, src=df)


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)
