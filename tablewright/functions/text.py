"""Text expressions (all stay in whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def trimmed(c: Column) -> Column:
    """Trim, and read an empty string as a missing value."""
    t = F.trim(c)
    return F.when(t != "", t)


def without_separators(c: Column) -> Column:
    """Drop thousands separators and dollar signs."""
    return F.regexp_replace(c, "[,$]", "")


def spaced(*cols: Column) -> Column:
    """Join parts with one space; missing when any part is missing."""
    return F.concat(*[p for i, c in enumerate(cols) for p in ((F.lit(" "), c) if i else (c,))])


def shortened(c: Column, width: int = 20) -> Column:
    """Cut to ``width`` characters plus an ellipsis when longer."""
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)


def null_tokens(c: Column, tokens=("", "N.A.", "NA", "NaN", "null")) -> Column:
    """Read the usual spellings of a missing value as NULL."""
    t = F.trim(c)
    return F.when(~t.isin(*tokens), t)


def after_prefix(c: Column, sep: str = "_") -> Column:
    """The part after the first separator."""
    return F.regexp_replace(c, f"^[^{sep}]*{sep}", "")


def number_text(c: Column, decimals: int = 1, prefix: str = "", suffix: str = "") -> Column:
    """Report formatting: grouped digits with a fixed number of decimals."""
    return F.concat(F.lit(prefix), F.format_number(c, decimals), F.lit(suffix))
