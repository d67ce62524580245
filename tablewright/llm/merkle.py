"""A Merkle tree over a dataset: a tree of runs of three per source, and one over the sources' roots.

Leaves are hashed in SQL. What follows works on digests. Every leaf gets its position in its source, the positions are
cut into superblocks of 3^DEPTH leaves, and each superblock is reduced to one node. These nodes are the leaves of the next
round, until one node is left a source; the sources' roots go the same way. Then the rounds are walked back: the nodes
of a superblock meet, in one cogroup, the siblings that lie outside of it, and go on with their whole proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, GroupedData, Window, functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from tablewright.session import cut_lineage, measured

DEPTH = 5                # levels of a superblock
BLOCK = 3 ** DEPTH       # its leaves: the bound of every Python group
_NODES = "tree string, pos long, size long, digest string"
_PATH = "tree string, pos long, path array<string>, cut int"


def _h(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _levels(digests: list[str], size: int) -> list[list[str]]:
    """The levels of a superblock in a tree of ``size`` nodes, its own nodes first: DEPTH more, or fewer where the tree ends."""
    out = [digests]
    for _ in range(DEPTH):
        if size <= 1:
            break
        last = out[-1]
        out.append([_h(*last[i: i + 3]) for i in range(0, len(last), 3)])
        size = -(-size // 3)
    return out


def _sides(levels: list[list[str]], at: int) -> list[str]:
    """Level by level, the siblings left and the siblings right of the node that node ``at`` of the lowest level belongs to."""
    out = []
    for level in levels[:-1]:
        run = at - at % 3
        out += ["".join(level[run: at]), "".join(level[at + 1: run + 3])]
        at //= 3
    return out


def _fold(digest: str, path: list[str]) -> str:
    for left, right in zip(path[::2], path[1::2]):
        digest = _h(left, digest, right)
    return digest


def _positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows(tree, ...)`` with pos (from 0, by ``order`` within the tree) and size, the tree's number of rows.

    Rows are dealt by ranges of (tree, order), numbered in sorted ranges, and moved by the counts of the ranges before,
    so a tree of any size is spread over tasks.
    """
    names = rows.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", part int, nth long"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, met = TaskContext.get().partitionId(), None, 0
        for b in batches:
            trees = b.column(0).dictionary_encode()
            code = trees.indices.to_numpy()
            starts = np.flatnonzero(np.diff(code, prepend=-1))
            nth = np.arange(len(code)) - np.repeat(starts, np.diff(starts, append=len(code)))
            if len(code):
                if trees.dictionary[int(code[0])].as_py() == held:
                    nth[: starts[1] if len(starts) > 1 else len(code)] += met
                held, met = trees.dictionary[int(code[-1])].as_py(), int(nth[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(code), part, np.int32)), pa.array(nth.astype(np.int64))],
                                             names=[*names, "part", "nth"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    found = cut_lineage(dealt.mapInArrow(number, schema), "numbered")
    counts = measured(found.groupBy("tree", "part").agg(F.count("*").alias("n")))
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = measured(counts.select("tree", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                                    F.sum("n").over(whole).alias("size")))
    placed = found.join(before, ["tree", "part"])
    return placed.withColumn("pos", F.col("nth") + F.col("before")).drop("part", "nth", "before")


def _blocks(nodes: DataFrame) -> GroupedData:
    return nodes.withColumn("block", F.expr(f"pos div {BLOCK}")).groupBy("tree", "block")


def _met(nodes: DataFrame, paths: DataFrame) -> PandasCogroupedOps:
    """The superblocks of ``nodes``, each with its path."""
    return _blocks(nodes).cogroup(paths.withColumnRenamed("pos", "block").groupBy("tree", "block"))


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of nodes(tree, pos, size, digest) with a size above 1, lowest first, and every tree's root(tree, digest)."""
    def reduce(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        size = int(block["size"].iloc[0])
        top = _levels(block["digest"].tolist(), size)[-1]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "size": [-(-size // BLOCK)], "digest": [top[0]]})

    rounds, roots = [], nodes.where("size = 1").select("tree", "digest")
    now = nodes.where("size > 1").select("tree", "pos", "size", "digest")
    while not now.isEmpty():
        rounds.append(now)
        above = cut_lineage(_blocks(now).applyInPandas(reduce, _NODES), "nodes")
        roots = roots.union(above.where("size = 1").select("tree", "digest"))
        now = above.where("size > 1")
    return rounds, roots


def _outer(rounds: list[DataFrame], roots: DataFrame) -> DataFrame:
    """What the lowest round's superblocks need from outside: paths(tree, pos, path, cut), pos the number of the superblock.

    ``roots`` holds (tree, path, cut): what lies outside of whole trees. ``cut`` is the number of levels of the path that
    belong to the tree itself.
    """
    def down(key: tuple, block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        levels = _levels(block["digest"].tolist(), int(block["size"].iloc[0]))
        path, cut = list(outer["path"].iloc[0]), int(outer["cut"].iloc[0])
        paths = [_sides(levels, i) + path for i in range(len(block))]
        return pd.DataFrame({"tree": block["tree"], "pos": block["pos"], "path": paths, "cut": cut + len(levels) - 1})

    paths = roots.select("tree", F.lit(0).cast("long").alias("pos"), "path", "cut")
    for nodes in reversed(rounds[1:]):
        trees = nodes.select("tree").distinct()
        inside = cut_lineage(_met(nodes, paths.join(trees, "tree", "left_semi")).applyInPandas(down, _PATH), "paths")
        # the paths of other trees stay in hand for the lower rounds in which they end
        paths = inside.union(paths.join(trees, "tree", "left_anti"))
    return paths


def manifest(docs: DataFrame, source: str = "source", doc_id: str = "doc_id",
             columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), text: str = "text",
             tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of ``docs``.

    A leaf is the SHA-256 (lower-case hex, as everywhere) of the ``columns``: ``-`` for null, else the UTF-8 byte count, a colon
    and the value. Per source, leaves ascend by id, a null id first, equal ids by leaf; a null source comes before all.
    While several nodes remain, every three consecutive ones, or what is left of them at the end, become the hash of their
    digests side by side. ``tampered`` (default: where crc32 of the id is even) marks rows that lost the line feeds of their
    text; their folded root comes from what is left and the original siblings, and ``verified`` tells whether it is the root.
    Without siblings the proof is empty. Repeated rows are leaves of their own; other columns are not read. An empty table
    gives no rows.

    The texts are read once; three shuffles of the digests follow, and rounds over a 243rd of them.
    """
    def leaf(value: Column | None = None) -> Column:
        cols = [value if value is not None and c == text else F.col(c).cast("string") for c in columns]
        return F.sha2(F.concat(*[F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c), F.lit(":"), c)) for c in cols]).cast("binary"), 256)

    if tampered is None:
        tampered = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0
    cleaned = F.when(F.coalesce(tampered, F.lit(False)) & F.contains(F.col(text), F.lit("\n")), leaf(F.replace(F.col(text), F.lit("\n"), F.lit(""))))
    tree = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))
    rows = docs.select(tree.alias("tree"), F.col(doc_id).cast("long").alias("doc_id"), leaf().alias("digest"), cleaned.alias("changed"))
    rows = cut_lineage(rows.withColumn("uid", F.monotonically_increasing_id()), "leaves")
    leaves = cut_lineage(_positions(rows, ["doc_id", "digest", "uid"]).drop("uid"), "placed")

    rounds, subroots = _climb(leaves)
    subroots = cut_lineage(subroots, "subroots")
    # the sources are a tree of their own, whose leaves ascend by name
    sources = _positions(subroots.select(F.lit("all").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    sources = cut_lineage(sources, "sources")
    upper, _ = _climb(sources)
    top = sources.select("tree").distinct().select("tree", F.expr("cast(array() as array<string>)").alias("path"), F.lit(0).alias("cut"))
    above = _outer([sources.select("tree", "pos", "size", "digest")] + upper[1:], top)

    def of_sources(key: tuple, block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        levels = _levels(block["digest"].tolist(), int(block["size"].iloc[0]))
        path = list(outer["path"].iloc[0])
        return pd.DataFrame({"tree": block["name"], "path": [_sides(levels, i) + path for i in range(len(block))], "cut": 0})

    named = _met(sources, above).applyInPandas(of_sources, "tree string, path array<string>, cut int")
    outer = _outer([leaves] + rounds[1:], cut_lineage(named, "source_paths"))

    def prove(key: tuple, block: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        digests, size = block["digest"].tolist(), int(block["size"].iloc[0])
        levels = _levels(digests, size)
        path, cut = list(outside["path"].iloc[0]), 2 * int(outside["cut"].iloc[0])
        subroot = _fold(levels[-1][0], path[:cut])
        root = _fold(subroot, path[cut:])
        proofs, folded = [], []
        for i, (own, changed) in enumerate(zip(digests, block["changed"])):
            sides = _sides(levels, i)
            proofs.append(_h(*sides, *path))
            folded.append(_fold(_fold(own if changed is None else changed, sides), path))
        return pd.DataFrame({"doc_id": block["doc_id"], "leaf": digests, "subroot": subroot, "root": root, "proof_sha256": proofs,
                             "folded_root": folded, "verified": [x == root for x in folded]})

    out = _met(leaves, outer).applyInPandas(
        prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return out if doc_id == "doc_id" else out.withColumnRenamed("doc_id", doc_id)
