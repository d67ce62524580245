"""Embedding near-duplicates by int8 tile products.

Vectors are scaled to length one and quantised to int8 per vector; a tile pair's cosines come from one product of small
integers. The quantisation error of each vector bounds that of every cosine, so only pairs whose cosine may reach the
threshold are computed again in double precision, and none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.common import components
from tablewright.session import cut_lineage

TILE = 8192   # vectors of a tile
STRIP = 1024  # rows of a tile multiplied at once; bounds the memory of a product


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (whole numbers up to 127, kept as float32 for the product), scale, error norm and length of the rebuilt vector."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    rebuilt = codes * scale[:, None]
    return codes.astype(np.float32), scale, np.linalg.norm(unit - rebuilt, axis=1), np.linalg.norm(rebuilt, axis=1)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    big = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return big / np.linalg.norm(big, axis=1, keepdims=True)


def linked(left: np.ndarray, right: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with cosine at or above the threshold; within one tile only i < j.

    For unit x, y and rebuilt x', y': |x.y - x'.y'| <= |x - x'| + |x'| |y - y'|. Sums of products of codes stay
    below 2^24 up to 1040 dimensions, so the float32 product is exact; beyond that the product runs in double.
    """
    qa, sa, ea, na = quantise(left)
    qb, sb, eb, _ = quantise(right)
    if left.shape[1] > 1040:
        qa, qb = qa.astype(float), qb.astype(float)
    for at in range(0, len(left), STRIP):
        part = slice(at, at + STRIP)
        # x'.y' >= threshold - error, divided by the scales
        about = (qa[part] @ qb.T) * sa[part, None] * sb[None, :]
        about += na[part, None] * eb[None, :]
        about += ea[part, None] + 1e-9
        i, j = np.nonzero(about >= threshold)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for c in range(0, len(i), 1 << 18):
            x, y = i[c: c + (1 << 18)], j[c: c + (1 << 18)]
            hit = np.einsum("ij,ij->i", left[x], right[y]) >= threshold
            yield x[hit], y[hit]


def forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable by the pairs, for each of n nodes (repeated minimum over links with pointer jumps)."""
    root = np.arange(n)
    if not pairs:
        return root
    a, b = (np.concatenate(x) for x in zip(*pairs))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding",
                    tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors``; other columns are not returned.

    n_links counts the other rows with cosine >= threshold in double precision, component_id is the smallest vec_id
    reachable by such links. Null, empty and zero vectors and vectors with null or non-finite components link with
    nothing, nor do vectors of different lengths with each other. Repeated rows are rows of their own. A null id has
    component_id null and is kept.

    Equal vectors are merged first and counted, so copies cost one vector. The others are dealt into tiles by a hash;
    each pair of tiles is one task's work of bounded size. A task returns at most one count and one link to its
    smallest partner per vector, never the pairs.
    """
    item = F.col(embedding)
    fine = F.coalesce((F.size(item) > 0) & F.forall(item, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
                      & F.exists(item, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.when(fine, item).alias("v"))
    # the digest of the components stands for the vector from here on; equality is that of all components
    merged = rows.where("v is not null and id is not null").groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    merged = cut_lineage(merged, "vectors")
    tiles = max(1, -(-merged.count() // tile))
    home = F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int")
    dealt = merged.withColumn("tile", home).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(
        F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"), "tile", "id", "copies", "v")

    def pair(key: tuple, group: pa.Table) -> pa.Table:
        first, second = (x.as_py() for x in key)
        count, low = {}, {}
        lists = group["v"].combine_chunks()
        tile_of, ids, copies = (group[c].to_numpy() for c in ("tile", "id", "copies"))
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
        start = np.cumsum(sizes) - sizes
        links, least = np.zeros(len(ids), np.int64), ids.copy()
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            own = own[np.argsort(ids[own], kind="stable")]
            unit = unit_rows(flat[start[own][:, None] + np.arange(size)[None, :]])
            a = np.flatnonzero(tile_of[own] == first)
            b = a if first == second else np.flatnonzero(tile_of[own] == second)
            found = []
            for i, j in linked(unit[a], unit[b], threshold, first == second):
                i, j = a[i], b[j]
                np.add.at(links, own[i], copies[own[j]])
                np.add.at(links, own[j], copies[own[i]])
                found.append((i, j))
            least[own] = ids[own][forest(len(own), found)]
        hit = np.flatnonzero(links > 0)
        return pa.table({"id": ids[hit], "n": links[hit], "low": least[hit]})

    part = cut_lineage(dealt.groupBy("p", "q").applyInArrow(pair, "id long, n long, low long"), "tiles")
    found = components(part.select(F.col("id").alias("a"), F.col("low").alias("b")))
    counted = part.groupBy("id").agg(F.sum("n").alias("n"))
    known = merged.join(counted, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("c"))
    component = F.coalesce("c", "id")
    return rows.join(known, "v", "left").select(
        F.col("id").alias(vec_id), F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
