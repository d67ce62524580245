"""Mixing sources to target weights by Poisson replication.

A source whose share of the corpus differs from its target is repeated (or thinned) at a mean rate. Each document's
number of copies inverts the Poisson distribution at a number drawn from a hash of its id, so the expected mixture is
exact, any document's copies depend on nothing but its id and its source's rate, and a rerun gives the same corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.common import uniform, unused
from tablewright.session import measured

SEED = 20
LARGEST = 64.0  # a larger mean rate is drawn as the sum of several, whose smallest terms do not underflow


def rates(docs: DataFrame, source: str = "source", units: Column | None = None, weights: dict[str, float] | None = None,
          power: float = 0.5, size: float = 1.0) -> DataFrame:
    """(source, units, rate): what a document of each source is repeated on average.

    ``units`` is what is mixed (default: rows). Targets are ``weights`` by source (sources not named get none), or else
    each source's units to the ``power``; they are brought to a sum of one. The mixture has ``size`` times the units
    of the input. A null source is a source of its own. Sources are counted by a partial aggregate, so a hot one costs
    no more than others.
    """
    unit = F.lit(1) if units is None else units
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.sum(unit).cast("double").alias("units"))
    if weights is None:
        target = F.pow("units", F.lit(power))
    else:
        named = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, float(v))])
        target = F.coalesce(named[F.col("source")], F.lit(0.0))
    counts = measured(counts.withColumn("target", target))
    total = counts.agg(F.sum("units").alias("u"), F.sum("target").alias("t")).first()
    if not total["u"]:
        return counts.select("source", "units", F.lit(0.0).alias("rate"))
    if not total["t"]:
        raise ValueError("no source has a target weight")
    rate = F.when(F.col("units") > 0, F.lit(size * total["u"] / total["t"]) * F.col("target") / F.col("units")).otherwise(0.0)
    return counts.select("source", "units", rate.alias("rate"))


def poisson_inverse(u: Column, rate: Column) -> Column:
    """The smallest k with P(Poisson(rate) <= k) > u, by adding up the terms; for rates up to some hundreds."""
    most = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("term"), F.exp(-rate).alias("sum"), F.lit(0).alias("k"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * rate / i
        more = acc["sum"] <= u
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"), (acc["k"] + F.when(more, 1).otherwise(0)).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda acc: acc["k"])


def poisson_count(key: Column, rate: Column, seed: int) -> Column:
    """A Poisson count that depends on the key alone. Rates above LARGEST are split into equal parts, one draw each."""
    draws = F.greatest(F.ceil(rate / LARGEST), F.lit(1)).cast("int")
    first = poisson_inverse(uniform(key, seed=seed), rate / draws)
    more = F.aggregate(F.sequence(F.lit(1), draws - 1), F.lit(0), lambda acc, i: acc + poisson_inverse(uniform(key, i, seed=seed), rate / draws))
    return first + F.when(draws > 1, more).otherwise(0)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5, size: float = 1.0, doc_id: str = "doc_id",
        source: str = "source", units: Column | None = None, seed: int = SEED, extra: bool = True) -> DataFrame:
    """The mixture in random order: the columns of ``docs``, with ``extra`` also _copy, _rate and _order (with more
    underscores where ``docs`` has such columns).

    Every row is repeated by its Poisson count (0 leaves it out), all columns kept. Rows that repeat an id are repeated
    alike. A null id draws as the empty id. The order is that of a hash of seed, id and copy number, which is uniform: its
    equal parts are the ranges of the one shuffle of the exploded rows, sorted within. An empty table gives no rows.
    """
    table = rates(docs, source, units, weights, power, size)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("id"), F.col(source).alias("of"))
    joined = rows.join(table.select(F.col("source").alias("name"), "rate"), F.col("of").eqNullSafe(F.col("name")))
    drawn = joined.withColumn("copies", poisson_count(F.col("id"), F.col("rate"), seed)).where("copies > 0")
    many = drawn.select("row", "id", "rate", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = many.withColumn("place", uniform(F.col("id"), F.col("copy"), seed=seed + 1))
    dealt = placed.repartitionById(parts, F.floor(F.col("place") * parts).cast("int")).sortWithinPartitions("place", "id", "copy")
    own = [F.col(c).alias(unused(docs.columns, n)) for c, n in (("copy", "_copy"), ("rate", "_rate"), ("place", "_order"))]
    return dealt.select("row.*", *(own if extra else []))
