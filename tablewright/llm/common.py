"""Shared pieces of the text operators: word hashing, fixed train/held-out folds, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(df: DataFrame, rows: int = 500) -> DataFrame:
    """``df``, after the session's Arrow batches are limited to ``rows`` rows.

    A row holds a text, and the usual ten thousand of them take more memory on both sides of a Python stage than their
    processing. The setting stays: plans read it when they run. A smaller one is kept.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= rows:
        df.sparkSession.conf.set(name, str(rows))
    return df


def unused(columns: list[str], name: str) -> str:
    """``name``, with as many more underscores before it as no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def uniform(*parts: Column, seed: int) -> Column:
    """A reproducible number in [0, 1) with 52 bits, from the MD5 of the seed and the given text columns."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def sliced(texts, rows: int = 250):
    """A batch of texts in pieces of a few rows, so that a task holds the words of few texts at a time."""
    for at in range(0, len(texts), rows):
        yield texts[at: at + rows].tolist()
    pa.default_memory_pool().release_unused()


def parts(batches, rows: int = 250):
    """Arrow batches in pieces of a few rows, for the same end; what a batch took goes back before the next."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
        del b
        pa.default_memory_pool().release_unused()


def grown(table: np.ndarray, more: np.ndarray, used: int) -> np.ndarray:
    """``table`` with the rows ``more`` as its last of ``used``; room is doubled when it runs out."""
    if used > len(table):
        table = np.vstack([table, np.empty((max(used, 2 * len(table)) - len(table), table.shape[1]))])
    table[used - len(more): used] = more
    return table


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def by_length(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words as code-point matrices: (indices, matrix) for every word length that occurs, zero excluded."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    out = []
    for own in np.split(order, cuts):
        if len(own) and lengths[own[0]]:
            out.append((own, points[starts[own][:, None] + np.arange(lengths[own[0]])[None, :]]))
    return out


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links ``edges(a, b)``: one row (node, component_id) per linked node.

    component_id is the smallest node reachable. Large-star and small-star rounds (Kiveris et al., 2014):
    every round is two shuffles of the links, written to the shared folder; nothing is gathered per node, so a
    node with very many links costs no more than its links. No links: an empty frame.
    """
    def key(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first())

    now = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen, fresh = None, key(now)
    while fresh != seen:
        both = now.union(now.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        small = met.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct()
        now = cut_lineage(small, "links")
        seen, fresh = fresh, key(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component_id")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct())
