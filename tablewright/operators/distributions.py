"""The data behind the charts: histograms, boxes, densities, error bars, 2-D bins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.numbers import finite
from tablewright.operators.joining import null_safe_join
from tablewright.operators.quantiles import exact_quantiles
from tablewright.session import measured


def _limits(df: DataFrame, col: str):
    low, high = F.min(col).cast("double"), F.max(col).cast("double")
    flat = low == high
    return df.agg(F.struct(F.when(flat, low - 0.5).otherwise(low).alias("a"),
                           F.when(flat, high + 0.5).otherwise(high).alias("b"))).scalar()


def _bin(v: Column, low: Column, high: Column, bins: int) -> Column:
    return F.least(F.floor((v - low) * bins / (high - low)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins (top edge in the last bin, empty bins kept): bin, left, right, count."""
    v = df.select(finite(F.col(col).cast("double")).alias("v")).where("v is not null")
    limits = _limits(v, "v")
    counts = v.withColumn("_l", limits).groupBy(
        _bin(F.col("v"), F.col("_l.a"), F.col("_l.b"), bins).alias("bin")).agg(F.count("*").alias("count"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("_l", limits)
    width = (F.col("_l.b") - F.col("_l.a")) / bins
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("_l.a") + F.col("bin") * width).alias("left"),
        (F.col("_l.a") + (F.col("bin") + 1) * width).alias("right"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def automatic_bins(df: DataFrame, col: str) -> DataFrame:
    """The bin count chosen by default in plotting: the finer of the Sturges and Freedman-Diaconis rules."""
    v = finite(F.col(col).cast("double"))
    q = exact_quantiles(df, [col], [0.25, 0.75]).select(F.struct("n", "q")).scalar()
    s = df.agg(F.min(v).alias("a"), F.max(v).alias("b")).withColumn("_q", q)
    width = F.col("b") - F.col("a")
    sturges = width / (F.log2(F.col("_q.n")) + 1)
    fd = 2 * (F.col("_q.q")[1] - F.col("_q.q")[0]) / F.cbrt(F.col("_q.n").cast("double"))
    step = F.when(fd > 0, F.least(sturges, fd)).otherwise(sturges)
    return s.select(F.col("_q.n").alias("n"), F.when(width > 0, F.ceil(width / step)).otherwise(1).cast("int").alias("bins"))


def box_stats(df: DataFrame, col: str, by=(), k: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and outlier count per group."""
    by = list(by)
    rows = df.select(*by, finite(F.col(col).cast("double")).alias("v")).where("v is not null")
    q = exact_quantiles(rows, ["v"], [0.25, 0.5, 0.75], by).select(
        *by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    fenced = q.withColumn("_lo", F.col("q1") - k * iqr).withColumn("_hi", F.col("q3") + k * iqr)
    if by:
        both = null_safe_join(rows, measured(fenced), by, "inner")
    else:
        both = rows.withColumn("_b", fenced.select(F.struct("*")).scalar()).select("v", "_b.*")
    within = F.col("v").between(F.col("_lo"), F.col("_hi"))
    return both.groupBy(*by, "n", "q1", "median", "q3").agg(
        F.min(F.when(within, F.col("v"))).alias("whisker_low"), F.max(F.when(within, F.col("v"))).alias("whisker_high"),
        F.count_if(~within).alias("outliers"))


def kde(df: DataFrame, col: str, by=(), points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian density on an even grid (Scott bandwidth, grid ``cut`` bandwidths past the data).

    Every row adds its kernel to ``points`` sums of one map-side combined aggregate; no row is multiplied. A group
    whose values are all equal has no bandwidth: it has one row, without point and density, that names its value.
    """
    by = list(by)
    v = df.select(*by, finite(F.col(col).cast("double")).alias("v")).where("v is not null")
    h = F.col("s") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    stats = (v.groupBy(*by) if by else v.groupBy()).agg(
        F.count("*").alias("n"), F.stddev_samp("v").alias("s"), F.min("v").alias("a"), F.max("v").alias("b")
    ).withColumn("h", F.when(F.col("s") > 0, h)).select(
        *by, "n", "h", (F.col("a") - cut * F.coalesce("h", F.lit(0.0))).alias("lo"), (F.col("b") + cut * F.coalesce("h", F.lit(0.0))).alias("hi"))
    if by:
        rows = null_safe_join(v, measured(stats), by, "inner")
    else:
        rows = v.withColumn("_s", stats.select(F.struct("*")).scalar()).select("v", "_s.*")
    step = (F.col("hi") - F.col("lo")) / (points - 1)

    def kernel(i: int) -> Column:
        z = (F.col("lo") + i * step - F.col("v")) / F.col("h")
        return F.sum(F.exp(-0.5 * z * z))

    sums = rows.groupBy(*by, "n", "h", "lo", "hi").agg(F.array(*[kernel(i) for i in range(points)]).alias("k"))
    grid = F.posexplode(F.when(F.col("h").isNotNull(), F.col("k")).otherwise(F.array(F.lit(None).cast("double"))))
    point = F.when(F.col("h").isNotNull(), F.col("point"))
    return sums.select(*by, "n", "h", "lo", "hi", grid.alias("point", "_k")).select(
        *by, point.alias("point"), F.when(point.isNotNull(), F.col("lo") + F.col("point") * step).otherwise(F.col("lo")).alias("x"),
        (F.col("_k") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))


def mean_bar(df: DataFrame, category: str, value: str) -> DataFrame:
    """Bar data: mean, deviation and a 95% interval of the mean per category."""
    s = df.groupBy(category).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    half = 1.96 * F.col("std") / F.sqrt("n")
    return s.withColumn("ci_low", F.col("mean") - half).withColumn("ci_high", F.col("mean") + half)


def bins_2d(df: DataFrame, x: str, y: str, bins: int = 20, by=()) -> DataFrame:
    """Scatter data at any size: counts on a bins x bins grid over the data range."""
    v = df.select(*by, finite(F.col(x).cast("double")).alias("x"), finite(F.col(y).cast("double")).alias("y"))
    v = v.where("x is not null and y is not null")
    placed = v.withColumn("_x", _limits(v, "x")).withColumn("_y", _limits(v, "y"))
    return placed.groupBy(
        *by, _bin(F.col("x"), F.col("_x.a"), F.col("_x.b"), bins).alias("x_bin"),
        _bin(F.col("y"), F.col("_y.a"), F.col("_y.b"), bins).alias("y_bin")).agg(F.count("*").alias("count"))


def line_series(df: DataFrame, group, x: str, y) -> DataFrame:
    """Series by group over time, ordered for drawing."""
    ys = [y] if isinstance(y, str) else list(y)
    return df.select(*group, x, *ys).orderBy(*group, x)


def bubble_map(df: DataFrame, lat: str, lon: str, size: str, shade: str, power: float = 2.5, scale: float = 5.0):
    """Map data: bubble area from a power of a column, shade scaled to [0, 1] over the data."""
    from tablewright.functions.numbers import real_power
    from tablewright.operators.scaling import minmax

    area = real_power(F.col(size).cast("double"), power) * scale
    return minmax(df.withColumn("bubble", area), [shade], "_shade").select(lat, lon, size, "bubble", shade, f"{shade}_shade")


def choropleth(df: DataFrame, entity: str, year: str, value: str, hover, at: int) -> DataFrame:
    """Map data of one year: entity, shaded value and hover fields."""
    return df.where(F.col(year) == at).select(entity, year, value, *hover)
