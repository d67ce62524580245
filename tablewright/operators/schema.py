"""Projection and schema operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T


def normalised_name(name: str) -> str:
    """Trim, blanks to underscores, no parentheses, no stray encoding mark."""
    return re.sub(r"[()Â]", "", name.strip().replace(" ", "_"))


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalised_name(c) for c in df.columns])


def lower_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def drop_columns(df: DataFrame, names, must_exist: bool = False) -> DataFrame:
    """Drop named columns; absent ones are ignored unless ``must_exist``."""
    absent = [n for n in names if n not in df.columns]
    if must_exist and absent:
        raise KeyError(f"no such columns: {absent}")
    return df.drop(*names)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def keep(df: DataFrame, names, rest: bool = False) -> DataFrame:
    """Select (and order) columns; ``rest`` appends the others."""
    tail = [c for c in df.columns if c not in names] if rest else []
    return df.select(*names, *tail)


# kinds of columns by Spark type
KINDS = {
    "number": (T.NumericType,),
    "float": (T.DoubleType, T.FloatType),
    "text": (T.StringType,),
    "time": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,),
}


def columns_of(df: DataFrame, kind: str, exclude=()) -> list[str]:
    """Names of the columns of one kind (plan-time only, no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, KINDS[kind]) and f.name not in exclude]


def columns_like(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def pack(df: DataFrame, name: str, *parts: str, drop: bool = True) -> DataFrame:
    """Pack columns into one struct column, e.g. a coordinate pair."""
    out = df.withColumn(name, F.struct(*parts))
    return out.drop(*parts) if drop else out


def flatten_structs(df: DataFrame, sep: str = "_") -> DataFrame:
    """One column per struct field, for sinks that take no structs."""
    cols: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"`{f.name}`.`{g}`").alias(f"{f.name}{sep}{g}") for g in f.dataType.names]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def code_names(df: DataFrame, code: str, name: str) -> DataFrame:
    """The (code, name) dimension of a long table; an empty name falls back to the code."""
    return df.groupBy(code).agg(F.coalesce(F.max(name), F.first(code)).alias(name))


def apply_contract(df: DataFrame, contract: dict[str, Column]) -> DataFrame:
    """Replace raw columns by their typed expressions, leaving the others alone."""
    return df.withColumns(contract)


def rejected_casts(raw: DataFrame, contract: dict[str, Column]) -> DataFrame:
    """Per contract column: values present before the cast and missing after it."""
    checks = [
        F.struct(
            F.lit(name).alias("column"),
            F.count_if(F.col(f"`{name}`").isNotNull() & expr.isNull()).alias("rejected"),
        )
        for name, expr in contract.items()
    ]
    return raw.agg(F.array(*checks).alias("c")).select(F.inline("c"))
