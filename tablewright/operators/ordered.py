"""Order-dependent operators for series of any length.

A window over one long series would sort that series in a single task. Here the rows are dealt into ranges of the whole
order tuple first, whatever its types and however often one value occurs; windows run inside (series, range) and only
one carry row per range crosses borders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T, Window

from tablewright.operators.joining import null_safe_join
from tablewright.session import cut_lineage, deal_by_range, measured

TIE = ["_tie", "_row"]


def in_ranges(df: DataFrame, keys, order, chunks: int | None = None) -> DataFrame:
    """Rows with ``_chunk``, which never falls along (keys, order), and the tie-breakers of equal order values.

    Ties are broken by a hash of the row, then by the row's place, so that a busy order value can be split as well.
    ``chunks`` defaults to the session's shuffle partitions. The result is stored: its ranges stay as they are.
    """
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in plain])).withColumn("_row", F.monotonically_increasing_id())
    return cut_lineage(deal_by_range(rows, [*keys, *order, *TIE], "_chunk", chunks), "ranges")


def _running(keys, order, upto: int = 0) -> Window:
    """Frame from the first row on. Backward scans use it too, over the reversed order: a frame that
    ends at the last row is evaluated anew for every row."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)


def fill_along(df: DataFrame, keys, order, cols, chunks: int | None = None,
               back: bool = True) -> DataFrame:
    """Forward fill, then (``back``) fill what is left backwards, along ``order`` within a series."""
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    part = in_ranges(df, keys, order, chunks)
    order = [*order, *TIE]
    at = F.struct(*order)
    edges = part.groupBy(*keys, "_chunk").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_last_{c}") for c in cols],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_first_{c}") for c in cols])
    before, after = _running(keys, ["_chunk"], -1), _running(keys, [F.desc("_chunk")], -1)
    carry = edges.select(
        *keys, "_chunk",
        *[F.last(f"_last_{c}", True).over(before).alias(f"_before_{c}") for c in cols],
        *[F.last(f"_first_{c}", True).over(after).alias(f"_after_{c}") for c in cols])
    carry = measured(carry)  # series + ranges rows
    group = [*keys, "_chunk"]
    upto, onward = _running(group, order), _running(group, [F.desc(o) for o in order])
    local = part.withColumns({f"_f_{c}": F.last(c, True).over(upto) for c in cols})
    if back:
        local = local.withColumns({f"_b_{c}": F.last(c, True).over(onward) for c in cols})
    out = null_safe_join(local, carry, group, "left")
    for c in cols:
        sources = [f"_f_{c}", f"_before_{c}"] + ([f"_b_{c}", f"_after_{c}"] if back else [])
        out = out.withColumn(c, F.coalesce(*sources))
    return out.select(*df.columns)


def lag_along(df: DataFrame, keys, order, col: str, into: str, chunks: int | None = None) -> DataFrame:
    """The previous row's value along ``order`` within a series (``keys`` may be empty)."""
    keys, order = list(keys), [order] if isinstance(order, str) else list(order)
    part = in_ranges(df, keys, order, chunks)
    order = [*order, *TIE]
    edges = part.groupBy(*keys, "_chunk").agg(F.max_by(F.struct(F.col(col).alias("v")), F.struct(*order)).alias("e"))
    # a series' last values per range, as many entries as ranges it reaches into
    listed = edges.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_chunk", "e"))).alias("_l"))
    placed = listed.select(*keys, "_l", F.posexplode("_l").alias("_i", "_x"))
    carry = measured(placed.select(*keys, F.col("_x._chunk").alias("_chunk"),
                                   F.when(F.col("_i") > 0, F.get("_l", F.col("_i") - 1)["e"]["v"]).alias("_carry")))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    local = part.withColumn("_lag", F.lag(col).over(inside)).withColumn("_rn", F.row_number().over(inside))
    out = null_safe_join(local, carry, [*keys, "_chunk"], "left")
    return out.withColumn(into, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag"))).select(
        *[c for c in df.columns if c != into], into)
