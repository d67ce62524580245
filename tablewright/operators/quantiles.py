"""Exact linear-interpolated quantiles, by one method for every size and any hot group.

A first pass counts and sketches the values of every group and column (KLL sketches merge map-side and hold a bounded number
of values). The sketch brackets each wanted rank between two values. A second pass counts what lies outside of the brackets
and keeps, with their counts, only the distinct values inside: a hundredth of them or so. The wanted ranks are looked up
there. Where the brackets of a group would still hold more than LIMIT rows, they are sketched again first. A rank that lies
outside of its bracket is noticed, and the brackets are drawn wider.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from tablewright.functions.numbers import finite
from tablewright.operators.joining import null_safe_join
from tablewright.session import measured

SKETCH = 2000      # the sketches' parameter k: about three times as many values are held
GRID = 500         # ranks that a sketch is asked for
LIMIT = 2_000_000  # rows expected in the brackets of one group


def melt(df: DataFrame, cols, by=()) -> DataFrame:
    """(by..., column, value) for the finite values of numeric columns; a narrow operation."""
    pairs = [F.struct(F.lit(c).alias("column"), finite(F.col(f"`{c}`").cast("double")).alias("value")) for c in cols]
    return df.select(*by, F.inline(F.array(*pairs))).where(F.col("value").isNotNull())


def exact_quantiles(df: DataFrame, cols, probs, by=(), extra=None) -> DataFrame:
    """by..., column, n, q: the quantiles ``probs`` of every column, within every group that has a value.

    ``extra`` maps names to aggregates of the value (column -> aggregate), added as columns; with it, groups and
    columns without any value have a row too, with n = 0 and no quantiles.
    """
    by, cols, probs, extra = list(by), list(cols), [float(p) for p in probs], extra or {}
    keys = [*by, "column"]
    sides = [f"_{x}{i}" for i in range(len(probs)) for x in ("lo", "hi")]

    def known(c: str) -> Column:
        return finite(F.col(f"`{c}`").cast("double"))

    per = [F.struct(F.lit(c).alias("column"), F.count(known(c)).alias("n"), F.kll_sketch_agg_double(known(c), F.lit(SKETCH)).alias("_s"),
                    *[f(known(c)).alias(n) for n, f in extra.items()]) for c in cols]
    groups = (df.groupBy(*by) if by else df.groupBy()).agg(F.array(*per).alias("_a")).select(*by, F.inline("_a"))
    ranks = [((F.col("n") - 1) * F.lit(p)) for p in probs]
    width = 3 * 2.296 / SKETCH ** 0.9723  # three times the error of a rank that the sketch keeps in 99 of 100 cases
    rows = melt(df, cols, by)
    drawn = groups.withColumn("_g", _grid("_s", "n"))
    stats = measured(drawn.select(*keys, "n", *extra, *_brackets(ranks, [("_g", F.lit(0), F.col("n"))] * len(probs), width)))
    while True:
        share = 2 * (width + 1 / GRID)
        inside = (stats.agg(F.max("n")).first()[0] or 0) * share
        bounds = stats.where("n > 0").select(*keys, "n", *sides)
        while inside > LIMIT:
            bounds, inside = _narrowed(rows, bounds, keys, ranks, width), inside * share
        found = measured(_looked_up(rows, bounds, keys, ranks))
        if found.where("not _sure").isEmpty():
            break
        width *= 4
        stats = measured(drawn.select(*keys, "n", *extra, *_brackets(ranks, [("_g", F.lit(0), F.col("n"))] * len(probs), width)))
    q = F.array(*[F.when(F.col(f"_a{i}") == F.col(f"_b{i}"), F.col(f"_a{i}")).otherwise(
        F.col(f"_a{i}") * (F.ceil(r) - r) + F.col(f"_b{i}") * (r - F.floor(r))) for i, r in enumerate(ranks)])
    out = found.select(*keys, "n", q.alias("q"))
    if not extra:
        return out
    return null_safe_join(stats.drop("n", *sides), out, keys, "left").select(*keys, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "q", *extra)


def _grid(sketch: str, n: str) -> Column:
    """The values at GRID + 1 even ranks: a sketch tells values at fixed ranks only. Null where there are none."""
    ranks = ", ".join(f"{k / GRID}D" for k in range(GRID + 1))
    return F.expr(f"if({n} > 0, kll_sketch_get_quantile_double({sketch}, array({ranks})), null)")


def _brackets(ranks: list[Column], parts: list[tuple[str, Column, Column]], width: float) -> list[Column]:
    """For every rank the values around it, from (grid, rows below it, rows in it); open at the ends, and for few rows."""
    out = []
    for i, (r, (grid, below, size)) in enumerate(zip(ranks, parts)):
        low = F.floor(((F.floor(r) - below) / size - width) * GRID).cast("int")
        high = F.ceil(((F.ceil(r) + 1 - below) / size + width) * GRID).cast("int")
        few = size * width < 2
        out.append(F.when(few | (low <= 0), F.lit(float("-inf"))).otherwise(F.get(grid, F.least(low, F.lit(GRID)))).alias(f"_lo{i}"))
        out.append(F.when(few | (high >= GRID), F.lit(float("inf"))).otherwise(F.get(grid, F.greatest(high, F.lit(0)))).alias(f"_hi{i}"))
    return out


def _within(i: int) -> Column:
    return F.col("value").between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))


def _narrowed(rows: DataFrame, bounds: DataFrame, keys, ranks: list[Column], width: float) -> DataFrame:
    """The brackets drawn anew from sketches of what they hold; a bracket that misses its rank is opened."""
    met = null_safe_join(rows, bounds, keys, "inner")
    each = [x for i in range(len(ranks)) for x in (
        F.count_if(F.col("value") < F.col(f"_lo{i}")).alias(f"_c{i}"), F.count_if(_within(i)).alias(f"_n{i}"),
        F.kll_sketch_agg_double(F.when(_within(i), F.col("value")), F.lit(SKETCH)).alias(f"_s{i}"))]
    held = [F.first(F.struct(*[f"_{x}{i}" for x in ("lo", "hi")])).alias(f"_old{i}") for i in range(len(ranks))]
    sums = met.groupBy(*keys, "n").agg(*each, *held).withColumns({f"_g{i}": _grid(f"_s{i}", f"_n{i}") for i in range(len(ranks))})
    new = _brackets(ranks, [(f"_g{i}", F.col(f"_c{i}"), F.col(f"_n{i}")) for i in range(len(ranks))], width)
    drawn = sums.select("*", *new)
    out = []
    for i, r in enumerate(ranks):
        missed = (F.floor(r) < F.col(f"_c{i}")) | (F.ceil(r) >= F.col(f"_c{i}") + F.col(f"_n{i}"))
        out += [F.when(missed, float("-inf")).otherwise(F.greatest(f"_lo{i}", f"_old{i}._lo{i}")).alias(f"_lo{i}"),
                F.when(missed, float("inf")).otherwise(F.least(f"_hi{i}", f"_old{i}._hi{i}")).alias(f"_hi{i}")]
    return measured(drawn.select(*keys, "n", *out))


def _looked_up(rows: DataFrame, bounds: DataFrame, keys, ranks: list[Column]) -> DataFrame:
    """keys, n, _a<i> and _b<i> (the values at the ranks' floor and ceiling), _sure (all of them came from inside a bracket)."""
    met = null_safe_join(rows, bounds, keys, "inner")
    inside, above = F.lit(False), F.lit(0)
    for i in range(len(ranks)):
        inside, above = inside | _within(i), above + (F.col("value") > F.col(f"_hi{i}")).cast("int") + (F.col("value") >= F.col(f"_lo{i}")).cast("int")
    # what lies between two brackets is one row, found by the borders it is above of
    counts = met.select(*keys, "n", "value", F.when(inside, F.col("value")).alias("_v"), F.when(~inside, above).alias("_gap")).groupBy(
        *keys, "n", "_gap", "_v").agg(F.count("*").alias("c"), F.max("value").alias("_at"))
    before = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("_upto", F.sum("c").over(before))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") - F.col("c") <= rank) & (rank < F.col("_upto")), F.col("_v")))

    ends = [x for i, r in enumerate(ranks) for x in (at(F.floor(r)).alias(f"_a{i}"), at(F.ceil(r)).alias(f"_b{i}"))]
    sure = F.lit(True)
    for i in range(len(ranks)):
        sure = sure & F.col(f"_a{i}").isNotNull() & F.col(f"_b{i}").isNotNull()
    return ranked.groupBy(*keys, "n").agg(*ends).withColumn("_sure", sure)


def quantile_struct(df: DataFrame, cols, probs):
    """Quantiles of whole columns as one scalar-subquery struct: field per column, array per field."""
    q = exact_quantiles(df, cols, probs)
    one = [F.max(F.when(F.col("column") == c, F.col("q"))).alias(c) for c in cols]
    return q.agg(F.struct(*one)).scalar()


def medians(df: DataFrame, col: str, by, name: str = "median") -> DataFrame:
    """by..., median."""
    return exact_quantiles(df, [col], [0.5], by).select(*by, F.col("q")[0].alias(name))
