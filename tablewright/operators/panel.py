"""Time-series operators on a long panel (series..., period, value).

A panel holds one row per series and period: `to_panel` builds it with a map-side combined
aggregate, so however many source rows a series has, a window over it sees at most one row
per calendar period. Series at raw grain go through `ordered` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from tablewright.functions.dates import quarter_index
from tablewright.functions.numbers import percent_of, ratio
from tablewright.session import measured


def to_panel(df: DataFrame, series, period: Column, value: Column, period_name: str = "period",
             value_name: str = "value") -> DataFrame:
    """Aggregate rows to one per series and period."""
    return df.groupBy(*series, period.alias(period_name)).agg(value.alias(value_name))


def _by(series, order) -> Window:
    return Window.partitionBy(*series).orderBy(*([order] if isinstance(order, str) else order))


def growth(panel: DataFrame, series, order, value: str, into: str = "growth", periods: int = 1,
           scale: float = 1.0, first: float | None = None) -> DataFrame:
    """Relative change against ``periods`` rows earlier, gaps padded with the last value.

    A zero base gives NULL; ``first`` replaces the missing change of a series' first rows.
    """
    w = _by(series, order)
    padded = panel.withColumn("_v", F.last(value, True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = padded.withColumn("_p", F.lag("_v", periods).over(w)).withColumn("_rn", F.row_number().over(w))
    change = (ratio(F.col("_v"), F.col("_p")) - 1) * scale
    if first is not None:
        change = F.when((F.col("_rn") <= periods) | F.col("_v").isNull() | F.col("_p").isNull(), F.lit(float(first))).otherwise(change)
    return out.withColumn(into, change).drop("_v", "_p", "_rn")


def growth_present(panel: DataFrame, series, order, value: str, into: str = "growth") -> DataFrame:
    """Growth with the rows that have none dropped."""
    return growth(panel, series, order, value, into).where(F.col(into).isNotNull())


def year_over_year(panel: DataFrame, series, date: str, value: str, into: str = "yoy", scale: float = 100.0) -> DataFrame:
    """Change against the same quarter a year before, by calendar: a missing quarter gives NULL.

    A range frame on the quarter number reads the row exactly four quarters back.
    """
    w = Window.partitionBy(*series).orderBy(quarter_index(F.col(date))).rangeBetween(-4, -4)
    return panel.withColumn(into, (ratio(F.col(value), F.first(value).over(w)) - 1) * scale)


def lag_matrix(panel: DataFrame, series, order, value: str, lags: int = 4, complete: bool = True) -> DataFrame:
    """Columns lag1..lagN (newest first); ``complete`` drops the rows without all of them."""
    w = _by(series, order)
    out = panel.select("*", *[F.lag(value, i).over(w).alias(f"lag{i}") for i in range(1, lags + 1)])
    for i in range(1, lags + 1) if complete else ():
        out = out.where(F.col(f"lag{i}").isNotNull())
    return out


def last_rows(panel: DataFrame, series, order: str, n: int, age: str | None = None) -> DataFrame:
    """The n latest rows of each series (the row limit is applied before the shuffle).

    ``age`` names a column counting them from 1, the latest.
    """
    w = Window.partitionBy(*series).orderBy(F.desc(order))
    out = panel.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", age) if age else out.drop("_rn")


def last_mean(panel: DataFrame, series, order: str, value: str, n: int = 8, into: str = "recent_avg") -> DataFrame:
    return last_rows(panel, series, order, n).groupBy(*series).agg(F.avg(value).alias(into))


def time_index(panel: DataFrame, date: str, into: str = "t") -> DataFrame:
    """Quarters since the first quarter of the panel; arithmetic only, no global window."""
    first = panel.agg(F.min(quarter_index(F.col(date)))).scalar()
    return panel.withColumn(into, quarter_index(F.col(date)) - first)


def period_total(panel: DataFrame, period, value: str, members: Column | None = None, into: str = "total") -> DataFrame:
    """Sum over the member series of each period put on every row; all-missing sums to 0.

    ``members`` restricts the sum to the member series. Aggregate and join back, so a
    period with many series is not buffered in a window.
    """
    keys = [period] if isinstance(period, str) else list(period)
    v = F.col(value) if members is None else F.when(members, F.col(value))
    total = panel.groupBy(*keys).agg(F.coalesce(F.sum(v), F.lit(0).cast(panel.schema[value].dataType)).alias(into))
    return panel.join(measured(total), keys)


def share_of_total(panel: DataFrame, period, value: str, members: Column | None = None, into: str = "share") -> DataFrame:
    """Percent of the period's total."""
    return period_total(panel, period, value, members, "_t").withColumn(
        into, percent_of(F.col(value), F.col("_t"))).drop("_t")


def seasonal_stats(panel: DataFrame, season: Column, value: str, series=(), name: str = "season") -> DataFrame:
    """Mean and sample deviation per season."""
    return panel.groupBy(*series, season.alias(name)).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))


def first_last(panel: DataFrame, series, order: str, value: str) -> DataFrame:
    """First and last period of each series with their values (no sort)."""
    return panel.groupBy(*series).agg(
        F.min(order).alias("first_period"), F.min_by(value, order).alias("first_value"),
        F.max(order).alias("last_period"), F.max_by(value, order).alias("last_value"))


def frequency(panel: DataFrame, series, date: str) -> DataFrame:
    """Most common gap in months between successive periods of each series."""
    w = _by(series, date)
    gap = F.months_between(F.col(date), F.lag(date).over(w))
    gaps = panel.withColumn("_g", gap).where("_g is not null").groupBy(*series, "_g").agg(F.count("*").alias("_n"))
    return gaps.groupBy(*series).agg(F.max_by("_g", F.struct("_n", -F.col("_g"))).alias("months"))
