"""Top-n, growth rankings and stability classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from tablewright.functions.numbers import ratio
from tablewright.operators.panel import growth
from tablewright.operators.quantiles import quantile_struct


def top(df: DataFrame, n: int, by: str, ties: str, ascending: bool = False) -> DataFrame:
    """The n best rows, ties broken by key; plans as a distributed top-k."""
    order = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    return df.orderBy(order, ties).limit(n)


def ranked(df: DataFrame, n: int, by: str, ties: str, ascending: bool = False) -> DataFrame:
    """`top` with a rank column 1..n; the ranking window sees only the n rows left."""
    order = F.asc_nulls_last(by) if ascending else F.desc_nulls_last(by)
    best = top(df, n, by, ties, ascending)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(order, F.asc(ties))))


def growth_table(recent: DataFrame, future: DataFrame, key: str) -> DataFrame:
    """key, recent_avg, forecast_avg, growth_rate (percent)."""
    return recent.join(future, key).withColumn(
        "growth_rate", 100 * ratio(F.col("forecast_avg") - F.col("recent_avg"), F.col("recent_avg")))


def rank_summary(table: DataFrame, metric: str = "growth_rate") -> DataFrame:
    """Number of series, mean and median metric, how many rise and fall (one row per series in)."""
    return table.withColumn("_q", quantile_struct(table, [metric], [0.5])).agg(
        F.count(metric).alias("series"), F.avg(metric).alias("mean"), F.max(F.col(f"_q.`{metric}`")[0]).alias("median"),
        F.count_if(F.col(metric) > 0).alias("positive"), F.count_if(F.col(metric) < 0).alias("negative"))


def roll_up(panel: DataFrame, period: str, member: str, value: str, sectors: DataFrame,
            default: str = "Other") -> DataFrame:
    """Sector sums per period; ``sectors`` maps (member, sector) and the rest is ``default``."""
    from tablewright.operators.joining import lookup

    placed = lookup(panel, sectors, member).withColumn("sector", F.coalesce("sector", F.lit(default)))
    return placed.groupBy(period, "sector").agg(F.sum(value).alias(value))


def sector_growth(rolled: DataFrame, period: str, value: str) -> DataFrame:
    """Period-on-period growth per sector, first periods dropped."""
    return growth(rolled, ["sector"], period, value, "growth_rate").where("growth_rate is not null")


def stability_classes(growths: DataFrame, key: str, value: str, n: int = 10) -> DataFrame:
    """Class each series: the n highest mean growths are Stable, the n largest deviations Volatile.

    A series in both takes Volatile, the later assignment. ``growths`` holds per-period
    growth rows; everything is joined on the series id.
    """
    stats = growths.groupBy(key).agg(F.avg(value).alias("mean_growth"), F.stddev_samp(value).alias("volatility"))
    stable = top(stats, n, "mean_growth", key).select(key, F.lit(True).alias("_s"))
    volatile = top(stats, n, "volatility", key).select(key, F.lit(True).alias("_v"))
    return stats.join(stable, key, "left").join(volatile, key, "left").withColumn(
        "stability", F.when(F.col("_v"), "Volatile").when(F.col("_s"), "Stable").otherwise("Other")).drop("_s", "_v")
