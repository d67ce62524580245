"""Joins: lookups, alignment, backfill and category grids.

No operator forces a broadcast by hint. Catalyst broadcasts a side when its size is below the
session's threshold, otherwise the join shuffles and AQE splits skewed partitions. Sides that
are aggregates are stored first (`session.measured`), so that the decision rests on their real
size and not on the size of what they were computed from.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablewright.session import measured



def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Equi-join in which a missing key matches a missing key; key columns come from the left."""
    keys = list(keys)
    if not keys:
        raise ValueError("a join needs at least one key")
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) for k in keys])
    out = left.join(r, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{k}" for k in keys])


def unique_keys(df: DataFrame, keys) -> DataFrame:
    """Pass the rows through, failing the job when a key occurs more than once.

    The check is a grouped count over the small side of a lookup, combined map-side.
    """
    cols = [c for c in df.columns if c not in keys]
    one = [
        F.when(F.count("*") > 1, F.raise_error(F.lit(f"duplicate lookup key in {list(keys)}")))
        .otherwise(F.first(c)).alias(c)
        for c in cols
    ]
    return df.groupBy(*keys).agg(*one) if cols else df.dropDuplicates(list(keys))


def lookup(fact: DataFrame, dimension: DataFrame, on, checked: bool = True) -> DataFrame:
    """Left many-to-one enrichment."""
    keys = [on] if isinstance(on, str) else list(on)
    side = measured(unique_keys(dimension, keys)) if checked else dimension
    return fact.join(side, keys, "left")


def inner_on_latest(fact: DataFrame, yearly: DataFrame, keys, year: str, required) -> DataFrame:
    """Join with the rows of the latest year whose ``required`` columns are present.

    Equals a left join followed by dropping unmatched rows, planned as an inner join.
    """
    from tablewright.operators.filters import require, rows_at_max

    latest = require(rows_at_max(yearly, year), *required)
    return require(fact.join(latest, [*keys, year], "inner"), *required)


def align_outer(frames, on: str) -> DataFrame:
    """Column-wise concatenation of frames on a key (full outer)."""
    return reduce(lambda a, b: a.join(b, on, "full"), frames)


def common_range(frames, order: str) -> list[DataFrame]:
    """Cut each frame to max(of starts) .. min(of ends); bounds are scalar subqueries."""
    starts = [f.agg(F.min(order)).scalar() for f in frames]
    ends = [f.agg(F.max(order)).scalar() for f in frames]
    low = F.greatest(*starts) if len(frames) > 1 else starts[0]
    high = F.least(*ends) if len(frames) > 1 else ends[0]
    return [f.where(F.col(order).between(low, high)) for f in frames]


def map_values(c: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    """Single-pass dictionary lookup; unmatched values take ``default`` (the value itself).

    The dictionary is in the driver and goes into the plan; `map_through` takes one that is a table.
    """
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(table, c), c if default is None else default)


def map_through(df: DataFrame, col: str, mapping: DataFrame, source: str, target: str, into: str,
                default: Column | None = None) -> DataFrame:
    """Dictionary lookup against a table of any size."""
    out = lookup(df, mapping.select(F.col(source).alias(col), F.col(target).alias("_to")), col)
    return out.withColumn(into, F.coalesce("_to", F.col(col) if default is None else default)).drop("_to")


def semi_top(df: DataFrame, key: str, top: DataFrame) -> DataFrame:
    """Rows whose key is in a derived key set."""
    return df.join(top.select(key), key, "left_semi")


def backfill_missing(df: DataFrame, listed: DataFrame, key: str, lookups: list[tuple[DataFrame, str, str]],
                     constants: dict[str, Column] | None = None) -> DataFrame:
    """Append a row for every listed key that is absent from ``df``.

    ``lookups`` are (table, its key column, the column of ``listed`` to match); each
    contributes its remaining columns. Columns nobody supplies are missing.
    """
    extra = listed.join(df.select(key), key, "left_anti")
    for table, table_key, listed_key in lookups:
        # only the listed keys of a lookup table matter, so it is cut to them before anything else
        asked = table.join(listed.select(F.col(listed_key).alias(table_key)), table_key, "left_semi")
        side = unique_keys(asked, [table_key]).withColumnRenamed(table_key, "_k")
        extra = extra.join(side, F.col(listed_key) == F.col("_k"), "left").drop("_k")
    for name, value in (constants or {}).items():
        extra = extra.withColumn(name, value)
    wanted = [c for c in extra.columns if c in df.columns]
    return df.unionByName(extra.select(*wanted), allowMissingColumns=True)


def category_grid(df: DataFrame, categories, name: str, first: int, last: int, most: int = 100_000) -> DataFrame:
    """Every combination of the observed category levels with the integers first..last; missing levels are left out.

    The first category's levels stay a distributed frame; those of each further category enter as one array (a
    scalar subquery) that every row explodes, so the requested product is built where the rows are. A further category of
    more than ``most`` levels is an error: give the largest one first.
    """
    seen = [df.select(c).where(F.col(c).isNotNull()).distinct() for c in categories]
    out = seen[0]
    for c, levels in zip(categories[1:], seen[1:]):
        some = levels.limit(most + 1)
        checked = F.when(F.count("*") > most, F.raise_error(F.lit(f"{c} has more than {most} levels")).cast(T.ArrayType(df.schema[c].dataType)))
        out = out.withColumn(c, F.explode(some.agg(checked.otherwise(F.sort_array(F.collect_list(c)))).scalar()))
    return out.select(*categories, F.explode(F.sequence(F.lit(first), F.lit(last))).alias(name))


def three_way_join(flat: DataFrame, api: DataFrame, html: DataFrame, key: str) -> DataFrame:
    """Three-source equi-join on a shared key, with the other two sources at key grain.

    Every row of ``flat`` meets exactly one row per source, so the result has the size of
    ``flat`` however many rows a year holds.
    """
    spark = flat.sparkSession
    cols_api = ", ".join(f"a.`{c}` AS `api_{c}`" for c in api.columns if c != key)
    cols_html = ", ".join(f"h.`{c}` AS `html_{c}`" for c in html.columns if c != key)
    return spark.sql(
        f"SELECT f.*, {cols_api}, {cols_html} FROM {{flat}} f "
        f"JOIN {{api}} a ON f.`{key}` = a.`{key}` JOIN {{html}} h ON f.`{key}` = h.`{key}`",
        flat=flat, api=measured(unique_keys(api, [key])), html=measured(unique_keys(html, [key])),
    )


def many_to_many_totals(left: DataFrame, right: DataFrame, key: str, left_sum: str, right_sum: str) -> DataFrame:
    """Row count and column sums of a many-to-many join, without producing its rows.

    Each side is first reduced to the key: the joined row count is n_l * n_r, and a left
    column is repeated n_r times (and the reverse).
    """
    a = left.groupBy(key).agg(F.count("*").alias("_nl"), F.sum(left_sum).alias("_sl"))
    b = right.groupBy(key).agg(F.count("*").alias("_nr"), F.sum(right_sum).alias("_sr"))
    return a.join(b, key).select(
        key,
        (F.col("_nl") * F.col("_nr")).alias("joined_rows"),
        (F.col("_sl") * F.col("_nr")).alias(f"sum_{left_sum}"),
        (F.col("_sr") * F.col("_nl")).alias(f"sum_{right_sum}"),
    )
