"""Profiling: counts, describe tables, duplicates, correlations."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.functions.numbers import finite, ratio
from tablewright.operators.quantiles import exact_quantiles
from tablewright.operators.schema import columns_of
from tablewright.session import small_frame

WIDE = 40  # columns up to which a correlation matrix is one aggregate of expressions


def null_audit(df: DataFrame, cols=None) -> DataFrame:
    """Per column: rows, present, missing, completeness. One aggregate over all columns."""
    cols = cols or df.columns
    per = [F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), F.count(F.col(f"`{c}`")).alias("present"),
                    (F.count("*") - F.count(F.col(f"`{c}`"))).alias("missing"),
                    ratio(F.count(F.col(f"`{c}`")), F.count("*")).alias("completeness")) for c in cols]
    return df.agg(F.array(*per).alias("a")).select(F.inline("a"))


def columns_with_nulls(df: DataFrame, cols=None) -> DataFrame:
    """The audited columns that miss values, worst first (one row per column)."""
    return null_audit(df, cols).where("missing > 0").orderBy(F.desc("missing"), "column")


def null_total(df: DataFrame) -> DataFrame:
    return null_audit(df).agg(F.sum("missing").alias("missing"))


def schema_report(df: DataFrame) -> DataFrame:
    """Column, type and present count: schema joined to the audit at plan time."""
    kind = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    return null_audit(df).select("column", kind[F.col("column")].alias("type"), "present")


def type_counts(df: DataFrame) -> DataFrame:
    """How many columns have each type; read off the schema, no data is touched."""
    kinds = Counter(f.dataType.simpleString() for f in df.schema.fields)
    return small_frame(df.sparkSession, sorted(kinds.items()), "type string, columns bigint")


def describe(df: DataFrame, cols, by=()) -> DataFrame:
    """by..., column, count, mean, std, min, q25, q50, q75, max with exact quartiles.

    A column without any value in a group has count 0 and nothing else.
    """
    extra = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by, extra)
    return q.select(*by, "column", F.col("n").alias("count"), "mean", "std", "min", F.col("q")[0].alias("q25"),
                    F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")


def basic_stats(df: DataFrame, col: str, by=()) -> DataFrame:
    """Min, max, mean, median and sample deviation of one column."""
    return describe(df, [col], by).select(
        *by, "min", "max", "mean", F.col("q50").alias("median"), "std")


def distinct_counts(df: DataFrame, cols=None, approximate: bool = False) -> DataFrame:
    """Distinct values per column: exact by two-level grouping, or a mergeable sketch."""
    cols = cols or columns_of(df, "text")
    if approximate:
        per = [F.struct(F.lit(c).alias("column"), F.approx_count_distinct(c).alias("distinct")) for c in cols]
        return df.agg(F.array(*per).alias("a")).select(F.inline("a"))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("v")) for c in cols]
    long = df.select(F.inline(F.array(*pairs)))
    return long.distinct().groupBy("column").agg(F.count("v").alias("distinct"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"), F.sum("_n").alias("rows"))


def without_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def value_checks(df: DataFrame, cols) -> DataFrame:
    """Per column: any infinite, any negative, counts of negative / positive values, finite range."""
    per = []
    for c in cols:
        e = F.col(f"`{c}`").cast("double")
        ok = finite(e)
        per.append(F.struct(
            F.lit(c).alias("column"), F.coalesce(F.bool_or(F.abs(e) == float("inf")), F.lit(False)).alias("any_infinite"),
            F.coalesce(F.bool_or(ok < 0), F.lit(False)).alias("any_negative"), F.count_if(ok < 0).alias("negative"),
            F.count_if(ok > 0).alias("positive"), F.min(ok).alias("min"), F.max(ok).alias("max")))
    return df.agg(F.array(*per).alias("a")).select(F.inline("a"))


def category_counts(df: DataFrame, col: str, order) -> DataFrame:
    """Counts in a fixed category order, absent categories included."""
    position = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(i))])
    zeros = small_frame(df.sparkSession, [(v, 0) for v in order], f"`{col}` string, `count` bigint")
    seen = df.where(F.col(col).isin(*order)).groupBy(col).agg(F.count("*").alias("count"))
    return seen.unionByName(zeros).groupBy(col).agg(F.sum("count").alias("count")).select(
        position[F.col(col)].alias("position"), col, "count")


def correlation(df: DataFrame, a: str, b: str, by=()) -> DataFrame:
    """Pearson correlation over the pairs in which both values are present."""
    x, y = finite(F.col(a).cast("double")), finite(F.col(b).cast("double"))
    both = df.where(x.isNotNull() & y.isNotNull())
    return (both.groupBy(*by) if by else both.groupBy()).agg(
        finite(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))).alias("r"), F.count("*").alias("n"))


def correlation_matrix(df: DataFrame, cols=None) -> DataFrame:
    """Long matrix (a, b, r) of all numeric columns, pairwise complete.

    Up to WIDE columns are one aggregate of built-in expressions; a plan with an expression per pair does not carry
    hundreds of columns, so those are summed up in blocks (`gram_correlations`).
    """
    cols = cols or columns_of(df, "number")
    if len(cols) > WIDE:
        return gram_correlations(df, cols)
    v = {c: finite(F.col(f"`{c}`").cast("double")) for c in cols}

    def pair(a, b):
        both = v[a].isNotNull() & v[b].isNotNull()
        x, y = F.when(both, v[a]), F.when(both, v[b])
        return finite(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))  # corr fails on a constant

    upper = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), pair(a, b).alias("r")) for a, b in combinations(cols, 2)]
    diagonal = [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"),
                         F.when(F.stddev_pop(v[c]) > 0, 1.0).alias("r")) for c in cols]
    half = df.agg(F.array(*upper, *diagonal).alias("m")).select(F.inline("m"))
    return _both_halves(half)


def _both_halves(half: DataFrame) -> DataFrame:
    return half.select(F.inline(F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", "r"))).otherwise(
        F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r")))))


def gram_correlations(df: DataFrame, cols) -> DataFrame:
    """(a, b, r) as `correlation_matrix`, in one pass for any number of columns.

    A task adds up the products of its rows and of their presence masks, all pairs of columns at a time, about the first
    value it meets in each column. One row per column goes on; the rows of a column are moved to a common origin and
    added as they arrive, so no task holds more than one column's sums besides its own square ones.
    """
    cols, k = list(cols), len(cols)
    schema = "i int, sums binary"
    shape = to_arrow_schema(T.StructType.fromDDL(schema))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin, total = np.full(k, np.nan), np.zeros((6, k, k))
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.slice(at, 4096).columns])
                there = np.isfinite(x)
                new = np.isnan(origin) & there.any(axis=0)
                origin[new] = x[there.argmax(axis=0)[new], new]
                m = there.astype(float)
                z = np.where(there, x - np.where(np.isnan(origin), 0, origin), 0.0)
                s, q = z.T @ m, (z * z).T @ m
                total += np.stack((m.T @ m, s, s.T, q, q.T, z.T @ z))
        if not np.isnan(origin).all():
            whole = np.where(np.isnan(origin), 0, origin)
            for i in range(k):
                data = np.concatenate(([whole[i]], whole[i:], total[:, i, i:].ravel())).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([data])], schema=shape)

    names = pa.array(cols)
    result = to_arrow_schema(T.StructType.fromDDL("a string, b string, r double"))

    def related(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, origin, sums = None, None, None

        def done() -> pa.RecordBatch:
            n, sx, sy, xx, yy, xy = sums
            with np.errstate(divide="ignore", invalid="ignore"):
                vx, vy = xx - sx * sx / n, yy - sy * sy / n
                r = (xy - sx * sy / n) / np.sqrt(vx * vy)
            r[~((vx > 1e-13 * xx) & (vy > 1e-13 * yy) & (n > 1))] = np.nan
            r[0] = 1.0 if r[0] == r[0] else np.nan
            values = pa.array(np.clip(r, -1, 1), from_pandas=True)
            return pa.RecordBatch.from_arrays([pa.array([cols[held]] * len(r)), names.slice(held), values], schema=result)

        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x0, *rest = np.split(np.frombuffer(data), [1, 1 + k - i])
                y0, more = rest[0], rest[1].reshape(6, k - i)
                if i != held:
                    if held is not None:
                        yield done()
                    held, origin, sums = i, (x0, y0), more.copy()
                    continue
                dx, dy = x0 - origin[0], y0 - origin[1]
                n, sx, sy, xx, yy, xy = more
                sums += np.stack((n, sx + n * dx, sy + n * dy, xx + 2 * dx * sx + n * dx * dx, yy + 2 * dy * sy + n * dy * dy,
                                  xy + dx * sy + dy * sx + n * dx * dy))
        if held is not None:
            yield done()

    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    parts = min(k, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = values.mapInArrow(summed, schema).repartition(parts, "i").sortWithinPartitions("i")
    return _both_halves(dealt.mapInArrow(related, "a string, b string, r double"))


def structure_report(df: DataFrame, entity: str, period: str) -> DataFrame:
    """Rows, number of periods and entities, and the period range of a long panel."""
    entities = distinct_counts(df, [entity, period])
    counts = entities.agg(F.struct(F.max(F.when(F.col("column") == entity, F.col("distinct"))).alias("e"),
                                   F.max(F.when(F.col("column") == period, F.col("distinct"))).alias("p"))).scalar()
    return df.agg(F.count("*").alias("rows"), F.min(period).alias("first"), F.max(period).alias("last")).withColumn(
        "_c", counts).select("rows", F.col("_c.p").alias("periods"), F.col("_c.e").alias("entities"), "first", "last")
