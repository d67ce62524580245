"""Outlier limits, capping, scaling and quartile classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.numbers import clipped, finite, percent_of, ratio
from tablewright.operators.quantiles import exact_quantiles, melt, quantile_struct


def iqr_fences(df: DataFrame, cols, by=(), k: float = 1.5) -> DataFrame:
    """by..., column, q1, q3, iqr, lower, upper."""
    q = exact_quantiles(df, cols, [0.25, 0.75], by)
    q1, q3 = F.col("q")[0], F.col("q")[1]
    return q.select(*by, "column", q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"),
                    (q1 - k * (q3 - q1)).alias("lower"), (q3 + k * (q3 - q1)).alias("upper"))


def sigma_report(df: DataFrame, cols, k: float = 3.0) -> DataFrame:
    """Per column: mean, sample deviation, limits, outlier count and share, data range.

    The limits enter the second pass as one scalar-subquery struct; both passes are single
    map-side combined aggregates over all columns.
    """
    v = {c: finite(F.col(f"`{c}`").cast("double")) for c in cols}
    limits = df.agg(F.struct(*[F.struct(F.avg(e).alias("m"), F.stddev_samp(e).alias("s")).alias(c)
                               for c, e in v.items()])).scalar()
    rows = df.select(*cols).withColumn("_l", limits)

    def one(c: str, e: Column) -> Column:
        low = F.col(f"_l.`{c}`.m") - k * F.col(f"_l.`{c}`.s")
        high = F.col(f"_l.`{c}`.m") + k * F.col(f"_l.`{c}`.s")
        out = F.count_if((e < low) | (e > high))
        return F.struct(
            F.lit(c).alias("column"), F.avg(e).alias("mean"), F.stddev_samp(e).alias("std"),
            (F.avg(e) - k * F.stddev_samp(e)).alias("lower"), (F.avg(e) + k * F.stddev_samp(e)).alias("upper"),
            out.alias("outliers"), percent_of(out, F.count(e)).alias("outlier_pct"),
            F.min(e).alias("min"), F.max(e).alias("max"))

    return rows.agg(F.array(*[one(c, e) for c, e in v.items()]).alias("a")).select(F.inline("a"))


def _with_stats(df: DataFrame, cols, make) -> DataFrame:
    """Attach per-column statistics of the whole table as a scalar-subquery struct ``_s``."""
    return df.withColumn("_s", df.agg(F.struct(*[make(c).alias(c) for c in cols])).scalar())


def _moments(c: str) -> Column:
    return F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s"))


def winsorise(df: DataFrame, cols, k: float = 3.0, floor_zero=()) -> DataFrame:
    """Cap at mean +- k population deviations; ``floor_zero`` columns are then floored at 0."""
    out = _with_stats(df, cols, _moments)
    capped = {}
    for c in cols:
        m, s = F.col(f"_s.`{c}`.m"), F.col(f"_s.`{c}`.s")
        e = clipped(F.col(c), m - k * s, m + k * s)
        capped[c] = clipped(e, 0.0) if c in floor_zero else e
    return out.withColumns(capped).drop("_s")


def floor_at(df: DataFrame, col: str, low: float = 0.0) -> DataFrame:
    return df.withColumn(col, clipped(F.col(col), low))


def zscore(df: DataFrame, cols, suffix: str = "") -> DataFrame:
    """Population z-scores; a constant column becomes 0."""
    out = _with_stats(df, cols, _moments)
    z = {c + suffix: F.when(F.col(c).isNotNull(), F.coalesce(ratio(
        F.col(c) - F.col(f"_s.`{c}`.m"), F.col(f"_s.`{c}`.s")), F.lit(0.0))) for c in cols}
    return out.withColumns(z).drop("_s")


def minmax(df: DataFrame, cols, suffix: str = "", fit_on: Column | None = None) -> DataFrame:
    """Scale to [0, 1]; a constant column becomes 0.

    ``fit_on`` restricts the rows the limits are learnt from (e.g. the training rows).
    """
    base = df if fit_on is None else df.where(fit_on)
    s = base.agg(F.struct(*[F.struct(F.min(c).alias("a"), F.max(c).alias("b")).alias(c) for c in cols])).scalar()
    out = df.withColumn("_s", s)
    scaled = {}
    for c in cols:
        low, high = F.col(f"_s.`{c}`.a"), F.col(f"_s.`{c}`.b")
        scaled[c + suffix] = F.when(F.col(c).isNotNull(),
                                    F.coalesce(ratio(F.col(c) - low, high - low), F.lit(0.0)))
    return out.withColumns(scaled).drop("_s")


# fixed values: quartile class labels, lowest first
QUARTILE_LABELS = ("Low", "Medium", "High", "Very High")


def quartile_label(df: DataFrame, cols, suffix: str = "_category") -> DataFrame:
    """Quartile class per value: right-closed intervals, lowest value included.

    Tied quartiles are legal: a value takes the first class whose upper edge it does not exceed.
    """
    out = df.withColumn("_q", quantile_struct(df, cols, [0.25, 0.5, 0.75]))
    labels = {}
    for c in cols:
        edge, v = F.col(f"_q.`{c}`"), F.col(c)
        labels[c + suffix] = (
            F.when(v <= edge[0], QUARTILE_LABELS[0]).when(v <= edge[1], QUARTILE_LABELS[1])
            .when(v <= edge[2], QUARTILE_LABELS[2]).when(v.isNotNull(), QUARTILE_LABELS[3]))
    return out.withColumns(labels).drop("_q")


__all__ = ["iqr_fences", "sigma_report", "winsorise", "floor_at", "zscore", "minmax", "quartile_label", "melt",
           "QUARTILE_LABELS"]
