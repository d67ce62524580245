"""Exact k-nearest-neighbour imputation as a partitioned join.

Donors are split into leaves of a k-d partition (split points from bounded samples; they
steer the work, not the result). Every query point first meets only its own leaf, which
gives a radius, and then exactly those other leaves whose box reaches into that radius.
Neither side is broadcast. The partition has two levels. The driver holds the upper tree and one box
per branch, at most TREE_LEAVES of them; with more donors than these can hold, each branch is split again
by a tree of its own, from its own sample. These lower trees and their boxes are rows of a table that donors and
queries meet branch by branch, so a leaf keeps about LEAF_ROWS donors as the donors grow (TREE_LEAVES squared leaves).
A leaf that cannot be split is dealt into shares of about LEAF_ROWS donors, each of which a query of the
leaf meets; busy branches and leaves spread their rows over tasks. So no task holds more than one share
of donors and one of queries. Neighbouring leaves with few queries travel in bundles, for a group costs far more than
its few rows; inside a bundle they stay apart. Equal points are merged beforehand: at most k donors of one point
can be among the k nearest, and equal queries share an answer.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

from tablewright.functions.numbers import finite
from tablewright.operators.filters import require
from tablewright.operators.joining import null_safe_join
from tablewright.session import cut_lineage, measured

LEAF_ROWS = 1024
TREE_LEAVES = 4096
SAMPLE_PER_LEAF = 32
QUERIES_PER_TASK = 8192
BUNDLE = 32              # leaves that travel together, if each has few queries
CELLS_PER_BLOCK = 4_000_000
PAIRS_PER_FRAME = 200_000


def _cut(part: np.ndarray) -> tuple[int, float] | None:
    """Dimension and value of a split with points on both sides, near the median of the widest dimension that has one."""
    for dim in np.argsort(part.min(0) - part.max(0), kind="stable"):
        values, many = np.unique(part[:, dim], return_counts=True)
        if len(values) > 1:
            # of all borders between neighbouring distinct values the one that halves the points best
            at = int(np.argmin(np.abs(np.cumsum(many)[:-1] - len(part) / 2)))
            middle = values[at] / 2 + values[at + 1] / 2
            return int(dim), float(values[at] if middle >= values[at + 1] else middle)
    return None


def _split_points(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Split dimension and value of each inner node of a binary k-d partition; -1 where the sample gives no split."""
    dims, cuts = np.full(2**depth, -1), np.zeros(2**depth)
    groups = {1: sample}
    for node in range(1, 2**depth):
        part = groups.pop(node)
        found = _cut(part) if len(part) > 1 else None
        if found:
            dims[node], cuts[node] = found
            right = part[:, dims[node]] > cuts[node]
        else:
            right = np.zeros(len(part), bool)
        groups[2 * node], groups[2 * node + 1] = part[~right], part[right]
    return dims, cuts


def _leaves(x: np.ndarray, dims: np.ndarray, cuts: np.ndarray, depth: int) -> np.ndarray:
    node, rows = np.ones(len(x), int), np.arange(len(x))
    for _ in range(depth):
        node = 2 * node + ((dims[node] >= 0) & (x[rows, dims[node]] > cuts[node]))
    return node - 2**depth


def _reached(x: np.ndarray, r: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int):
    """(rows, leaf) pairs of the leaves whose box lies within a row's squared radius, by descent from the root.

    ``low`` and ``high`` are the boxes of all nodes in heap order; an empty node has an empty box.
    """
    todo = [(1, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        gap = np.maximum(np.maximum(low[node] - x[rows], x[rows] - high[node]), 0)
        rows = rows[(gap**2).sum(1) <= r[rows]] if (low[node] <= high[node]).all() else rows[:0]
        if len(rows):
            if node >= 2**depth:
                yield rows, node - 2**depth
            else:
                todo += [(2 * node, rows), (2 * node + 1, rows)]


def _together(pairs):
    """(rows, leaf of each) of many (rows, leaf) pairs at a time: PAIRS_PER_FRAME or a little more."""
    held, size = [], 0
    for rows, leaf in pairs:
        held.append((rows, leaf))
        size += len(rows)
        if size >= PAIRS_PER_FRAME:
            yield _joined(held)
            held, size = [], 0
    if held:
        yield _joined(held)


def _joined(pairs: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    rows = [r for r, _ in pairs]
    return np.concatenate(rows), np.repeat(np.array([leaf for _, leaf in pairs], np.int64), [len(r) for r in rows])


def _nearest(points: np.ndarray, donors: np.ndarray, k: int):
    """Index and squared distance of the k nearest donors per point; donors come in id order."""
    k = min(k, len(donors))
    block = max(1, CELLS_PER_BLOCK // max(1, len(donors)))
    for start in range(0, len(points), block):
        part = points[start:start + block]
        d = sum((part[:, [j]] - donors[:, j]) ** 2 for j in range(points.shape[1]))
        best = np.argpartition(d, k - 1, axis=1)[:, :k]
        # the k-th distance may be shared: smallest ids win, as a stable sort keeps id order
        reach = np.take_along_axis(d, best, 1).max(1)
        tied = np.count_nonzero(d <= reach[:, None], axis=1) > k
        best[tied] = np.argsort(d[tied], axis=1, kind="stable")[:, :k]
        yield start, best, np.take_along_axis(d, best, 1)


def _heap(boxes: pd.DataFrame, names: list[str], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lows and highs of all nodes of a tree in heap order, from those of its leaves; an empty node has an empty box."""
    low, high = np.full((2 ** (depth + 1), len(names)), np.inf), np.full((2 ** (depth + 1), len(names)), -np.inf)
    at = boxes["_leaf"].to_numpy(int) % 2**depth + 2**depth
    low[at], high[at] = boxes[[f"lo{c}" for c in names]].to_numpy(float), boxes[[f"hi{c}" for c in names]].to_numpy(float)
    for node in range(2**depth - 1, 0, -1):
        low[node] = np.minimum(low[2 * node], low[2 * node + 1])
        high[node] = np.maximum(high[2 * node], high[2 * node + 1])
    return low, high


def _lower_trees(placed: DataFrame, names: list[str], lower: int, fraction: float) -> DataFrame:
    """(_leaf, dims, cuts): a tree of its own for every branch, from a sample of about SAMPLE_PER_LEAF donors a leaf."""
    def build(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        dims, cuts = _split_points(sample[names].to_numpy(float), lower)
        return pd.DataFrame({"_leaf": [key[0]], "dims": [dims.astype(np.int32).tobytes()], "cuts": [cuts.tobytes()]})

    sample = placed.select("_leaf", *names).sample(fraction=min(1.0, fraction), seed=8)
    return sample.groupBy("_leaf").applyInPandas(build, "_leaf int, dims binary, cuts binary")


def _shared(rows: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with _part: the rows of a branch in parts of about QUERIES_PER_TASK, its row of the table once for each part."""
    parts = measured(rows.groupBy("_leaf").agg(F.ceil(F.count("*") / QUERIES_PER_TASK).cast("int").alias("_parts")))
    dealt = rows.join(parts, "_leaf").withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.col("_parts")).cast("int")).drop("_parts")
    copies = table.join(parts, "_leaf").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return dealt, copies


def _in_branches(rows: DataFrame, trees: DataFrame, names: list[str], lower: int) -> DataFrame:
    """``rows`` with the number of the leaf within the branch added to _leaf; a branch without a tree is one leaf."""
    def place(own: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        inner = 0
        if len(tree) and len(own):
            dims, cuts = np.frombuffer(tree["dims"].iloc[0], np.int32), np.frombuffer(tree["cuts"].iloc[0])
            inner = _leaves(own[names].to_numpy(float), dims, cuts, lower)
        return own.assign(_leaf=own["_leaf"].astype("int64") * 2**lower + inner)[out]

    out = rows.columns
    schema = ", ".join(f"{f.name} {'bigint' if f.name == '_leaf' else f.dataType.simpleString()}" for f in rows.schema)
    dealt, copies = _shared(rows, trees)
    return dealt.groupBy("_leaf", "_part").cogroup(copies.groupBy("_leaf", "_part")).applyInPandas(place, schema)


def _reached_below(asked: DataFrame, boxes: DataFrame, names: list[str], lower: int) -> DataFrame:
    """names..., _leaf: from (query, branch, _own, _r) the leaves of the branch within the squared radius, but the query's own."""
    own = boxes.withColumn("_branch", F.expr(f"_leaf div {2**lower}"))
    fields = ["_leaf", *[f"{p}{c}" for c in names for p in ("lo", "hi")]]
    table = own.groupBy("_branch").agg(F.collect_list(F.struct(*fields)).alias("boxes")).withColumnRenamed("_branch", "_leaf")  # TREE_LEAVES at most

    def reach(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(held):
            leaves = pd.DataFrame([tuple(b.values()) if isinstance(b, dict) else tuple(b) for b in held["boxes"].iloc[0]], columns=fields)
            low, high = _heap(leaves, names, lower)
            x, mine, base = rows[names].to_numpy(float), rows["_own"].to_numpy(), int(rows["_leaf"].iloc[0]) * 2**lower
            for at, leaf in _reached(x, rows["_r"].to_numpy(float), low, high, lower):
                found.append((at[mine[at] != base + leaf], base + leaf))
        at, leaf = _joined(found) if found else (np.zeros(0, int), np.zeros(0, np.int64))
        return pd.DataFrame(rows[names].to_numpy(float)[at], columns=names).assign(_leaf=leaf)

    dealt, copies = _shared(asked, table)
    schema = ", ".join(f"{c} double" for c in names) + ", _leaf long"
    return dealt.groupBy("_leaf", "_part").cogroup(copies.groupBy("_leaf", "_part")).applyInPandas(reach, schema)


def knn_mean(donors: DataFrame, queries: DataFrame, key: str, features, target: str, k: int = 5) -> DataFrame:
    """features..., estimate: mean target of the k nearest donors of each distinct query point.

    Ties in distance are broken by the smaller ``key``.
    """
    features = list(features)
    xs = [finite(F.col(c).cast("double")).alias(f"_x{i}") for i, c in enumerate(features)]
    names = [f"_x{i}" for i in range(len(features))]
    same_point = Window.partitionBy(*names).orderBy("_id")
    points = require(donors.select(F.col(key).alias("_id"), *xs, F.col(target).cast("double").alias("_y")), *names, "_y")
    points = points.withColumn("_rn", F.row_number().over(same_point)).where(F.col("_rn") <= k).drop("_rn")
    points = cut_lineage(points)
    wanted = require(queries.select(*xs), *names).distinct()

    n = points.count()
    depth = lower = 0
    while 2**depth < TREE_LEAVES and n > LEAF_ROWS * 2**depth:
        depth += 1
    while depth and 2**lower < TREE_LEAVES and n > LEAF_ROWS * 2**(depth + lower):
        lower += 1
    fraction = min(1.0, SAMPLE_PER_LEAF * 2**depth / max(n, 1))
    sample = points.select(*names).sample(fraction=fraction, seed=7).toPandas().to_numpy(float) if depth else np.zeros((0, len(names)))
    dims, cuts = _split_points(sample, depth)

    @F.pandas_udf("int")
    def leaf_of(*cols: pd.Series) -> pd.Series:
        return pd.Series(_leaves(np.column_stack([c.to_numpy(float) for c in cols]), dims, cuts, depth))

    placed = points.withColumn("_leaf", leaf_of(*names))
    wanted = wanted.withColumn("_leaf", leaf_of(*names))
    if lower:
        placed = cut_lineage(placed, "branches")
        trees = cut_lineage(_lower_trees(placed, names, lower, SAMPLE_PER_LEAF * 2**(depth + lower) / n), "trees")
        placed, wanted = (cut_lineage(_in_branches(df, trees, names, lower)) for df in (placed, wanted))
    else:
        placed = placed.withColumn("_leaf", F.col("_leaf").cast("long"))
        wanted = cut_lineage(wanted.withColumn("_leaf", F.col("_leaf").cast("long")))
    shares = measured(placed.groupBy("_leaf").agg(F.ceil(F.count("*") / (2 * LEAF_ROWS)).cast("int").alias("_shares")))
    placed = placed.join(shares, "_leaf").withColumn("_share", F.pmod(F.xxhash64("_id"), F.col("_shares")).cast("int")).drop("_shares")

    id_type = donors.schema[key].dataType.simpleString()
    schema = ", ".join(f"{c} double" for c in names) + f", _id {id_type}, _d double, _y double"

    def local(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=[*names, "_id", "_d", "_y"])
        right = right.sort_values(["_leaf", "_id"])
        p, donors, leaf = left[names].to_numpy(float), right[names].to_numpy(float), right["_leaf"].to_numpy()
        at, best, far = [], [], []
        for own, rows in left.groupby("_leaf").indices.items():
            low, high = np.searchsorted(leaf, own), np.searchsorted(leaf, own, side="right")
            if low == high:
                continue
            for start, found, d in _nearest(p[rows], donors[low:high], k):
                at.append(np.repeat(rows[start:start + len(found)], found.shape[1]))
                best.append(found.ravel() + low)
                far.append(d.ravel())
        if not at:
            return pd.DataFrame(columns=[*names, "_id", "_d", "_y"])
        best = np.concatenate(best)
        return pd.DataFrame(p[np.concatenate(at)], columns=names).assign(
            _id=right["_id"].to_numpy()[best], _d=np.concatenate(far), _y=right["_y"].to_numpy()[best])

    # leaves of a bundle: fewer where there are not enough bundles for all tasks
    bundle = min(BUNDLE, max(1, 2**(depth + lower) // (4 * points.sparkSession.sparkContext.defaultParallelism)))

    def meet(asked: DataFrame) -> DataFrame:
        """Nearest donors of each (query, share of a leaf) pair, busy leaves split over tasks, leaves with few queries bundled."""
        few = f"_shares = 1 and _n <= {max(1, QUERIES_PER_TASK // 8)}"
        load = asked.groupBy("_leaf").agg(F.count("*").alias("_n")).join(shares, "_leaf")
        load = measured(load.select("_leaf", "_shares", F.ceil(F.col("_n") / QUERIES_PER_TASK).cast("int").alias("_parts"),
                                    F.expr(f"if({few}, _leaf div {bundle}, -1 - _leaf)").alias("_bundle")))
        left = asked.join(load, "_leaf").withColumn("_part", F.pmod(F.xxhash64(*names), F.col("_parts")).cast("int")).withColumn(
            "_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
        copies = load.select(F.col("_leaf").alias("_l"), F.col("_bundle").alias("_bundle"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
        right = placed.join(copies, F.col("_leaf") == F.col("_l")).drop("_l")
        group = ["_bundle", "_share", "_part"]
        left = left.select(*group, "_leaf", *names)
        return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(local, schema)

    if depth == 0:
        found = meet(wanted)
    else:
        first = cut_lineage(meet(wanted))
        nearest_own = Window.partitionBy(*names).orderBy("_d", "_id")
        first = first.withColumn("_rn", F.row_number().over(nearest_own)).where(F.col("_rn") <= k).drop("_rn")
        radius = first.groupBy(*names).agg(F.max("_d").alias("_r"), F.count("*").alias("_k"))
        bounds = [f(c).alias(f"{p}{c}") for c in names for f, p in ((F.min, "lo"), (F.max, "hi"))]
        boxes = placed.groupBy("_leaf").agg(*bounds)
        boxes = cut_lineage(boxes, "boxes") if lower else boxes
        whole = [f(f"{p}{c}").alias(f"{p}{c}") for c in names for f, p in ((F.min, "lo"), (F.max, "hi"))]
        branches = boxes.groupBy(F.expr(f"_leaf div {2**lower}").alias("_leaf")).agg(*whole).toPandas()  # TREE_LEAVES at most
        low, high = _heap(branches, names, depth)

        def reach(batches):
            for b in batches:
                x, own = b[names].to_numpy(float), b["_leaf"].to_numpy()
                r = np.where(b["_k"].to_numpy() >= k, b["_r"].to_numpy(float), np.inf)
                for rows, leaf in _together(_reached(x, r, low, high, depth)):
                    if not lower:
                        other = own[rows] != leaf
                        rows, leaf = rows[other], leaf[other]
                    yield pd.DataFrame(x[rows], columns=names).assign(_leaf=leaf, _own=own[rows], _r=r[rows])

        # queries whose own leaf held no donor have no radius yet and visit every leaf
        asked = wanted.join(radius, names, "left").fillna({"_r": 0.0, "_k": 0})
        # few bytes, much work: dealt evenly, and by leaves within a task, so that a batch descends to few of them
        asked = asked.repartition(2 * points.sparkSession.sparkContext.defaultParallelism, *names).sortWithinPartitions("_leaf")
        others = asked.mapInPandas(reach, ", ".join(f"{c} double" for c in names) + ", _leaf long, _own long, _r double")
        if lower:
            others = _reached_below(cut_lineage(others, "reached"), boxes, names, lower)
        found = first.unionByName(meet(cut_lineage(others.select(*names, "_leaf"))))

    nearest = Window.partitionBy(*names).orderBy("_d", "_id")
    best = found.withColumn("_rn", F.row_number().over(nearest)).where(F.col("_rn") <= k)
    estimate = best.groupBy(*names).agg(F.avg("_y").alias("estimate"))
    return estimate.withColumnsRenamed(dict(zip(names, features)))


def knn_impute(df: DataFrame, key: str, features, target: str, k: int = 5) -> DataFrame:
    """Replace only the missing targets by the mean of the k nearest rows that have one.

    Distances use the raw features; rows missing a feature keep their missing target.
    """
    known = F.col(target).isNotNull()
    estimate = knn_mean(df.where(known), df.where(~known), key, features, target, k)
    at = [f"_p{i}" for i in range(len(features))]
    keyed = df.withColumns({a: F.col(c).cast("double") for a, c in zip(at, features)})
    joined = null_safe_join(keyed, estimate.withColumnsRenamed(dict(zip(features, at))), at, "left")
    return joined.withColumn(target, F.coalesce(F.col(target), F.col("estimate"))).select(*df.columns)
