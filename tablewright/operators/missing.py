"""Missing data: constants, medians, cascades, rules and fills along a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.operators.joining import null_safe_join
from tablewright.operators.ordered import fill_along
from tablewright.operators.quantiles import medians, quantile_struct
from tablewright.session import measured


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


def fill_global_median(df: DataFrame, cols) -> DataFrame:
    """Fill with the exact column median (a scalar subquery, no join)."""
    out = df.withColumn("_m", quantile_struct(df, cols, [0.5]))
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_m.`{c}`")[0]) for c in cols}).drop("_m")


def fill_group_median(df: DataFrame, col: str, by, fallback: bool = True, legacy_null_key: bool = False) -> DataFrame:
    """Fill with the median of the row's group, then with the median of the filled column.

    A row whose group key is missing keeps its own value and gets no group median.
    ``legacy_null_key`` instead loses the values of such rows before the global fill.
    """
    by = list(by)
    keyless = F.lit(False)
    for k in by:
        keyless = keyless | F.col(k).isNull()
    grouped = measured(medians(df.where(~keyless), col, by, "_gm"))
    own = F.when(~keyless, F.col(col)) if legacy_null_key else F.col(col)
    filled = df.join(grouped, by, "left").withColumn(col, F.coalesce(own, "_gm")).select(*df.columns)
    return fill_global_median(filled, [col]) if fallback else filled


def fill_cascade(df: DataFrame, col: str, sources, by, legacy_null_key: bool = False) -> DataFrame:
    """Fill from sibling columns, then the group median, then the global median."""
    first = df.withColumn(col, F.coalesce(F.col(col), *[F.col(s).cast(df.schema[col].dataType) for s in sources]))
    return fill_group_median(first, col, by, True, legacy_null_key)


def fill_by_rule(df: DataFrame, col: str, when: Column, value) -> DataFrame:
    """Fill missing values of the rows a rule selects."""
    return df.withColumn(col, F.when(F.col(col).isNull() & when, F.lit(value)).otherwise(F.col(col)))


def forward_fill(df: DataFrame, keys, order, cols, chunks: int | None = None) -> DataFrame:
    return fill_along(df, keys, order, cols, chunks, back=False)


def forward_back_fill(df: DataFrame, keys, order, cols, chunks: int | None = None) -> DataFrame:
    return fill_along(df, keys, order, cols, chunks, back=True)


def masked(df: DataFrame, col: str, mask: Column, value) -> DataFrame:
    """Masked assignment."""
    v = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(col, F.when(mask, v).otherwise(F.col(col)) if col in df.columns else F.when(mask, v))
