"""Packing documents into sequences of a fixed number of tokens, by lengths rather than by rows.

Which sequence a piece goes to depends on its length only. The pieces are therefore counted by length (a table of at most
``capacity`` rows), the counts are packed by best fit, and every piece finds its place from its rank among the pieces of its
length. Large pieces, above a third of the capacity, go at most two to a sequence: they are matched greedily, the largest with
the largest that still fits. Smaller ones, in falling length, take the tightest gap.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.llm.bpe import read_ranks
from tablewright.llm.common import parts, text_batches
from tablewright.session import cut_lineage, measured, small_frame

END = 0  # the id that ends every document
_LOOK = r"|\s+(?!\S)"
_RUNS = ("  ", "\n\n", " \n", "\n ")
#: White space besides the space and the line feed.
_OTHER = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


class Place(NamedTuple):
    """Pieces of one length with ranks from ``first`` on: ``each`` to a sequence from ``sequence`` on, side by side from ``offset`` on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> tuple[list[Place], int]:
    """Places for ``counts`` pieces of every length (1 to ``capacity``), and the number of sequences.

    Sequences that hold the same lengths are kept as one run, so the work and the result grow with the number of lengths,
    not of pieces: a run is split at most twice a length.
    """
    places: list[Place] = []
    ranks = dict.fromkeys(counts, 0)
    left = {n: c for n, c in counts.items() if c}
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first sequence, sequences)
    open_gaps: list[int] = []
    total = 0

    def put(length: int, sequence: int, sequences: int, each: int, offset: int) -> None:
        n = sequences * each
        places.append(Place(length, ranks[length], n, sequence, each, offset))
        ranks[length] += n
        left[length] -= n

    def leave(gap: int, sequence: int, sequences: int) -> None:
        if gap and sequences:
            if gap not in gaps:
                gaps[gap] = []
                insort(open_gaps, gap)
            gaps[gap].append((sequence, sequences))

    large = sorted(n for n in left if 3 * n > capacity)
    for x in reversed(large):
        at = bisect_left(large, capacity - x + 1) - 1
        while left[x]:
            while at >= 0 and left[large[at]] < (2 if large[at] == x else 1):
                at -= 1
            if at < 0 or large[at] > x:
                n = left[x]
                put(x, total, n, 1, 0)
                leave(capacity - x, total, n)
            elif large[at] == x:
                n = left[x] // 2
                put(x, total, n, 2, 0)
                leave(capacity - 2 * x, total, n)
            else:
                y = large[at]
                n = min(left[x], left[y])
                put(x, total, n, 1, 0)
                put(y, total, n, 1, x)
                leave(capacity - x - y, total, n)
            total += n
    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[s]:
            at = bisect_left(open_gaps, s)
            if at == len(open_gaps):
                gap, sequence = capacity, total
                sequences = -(-left[s] // (capacity // s))
                total += sequences
            else:
                gap = open_gaps[at]
                sequence, sequences = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], open_gaps[at]
            each = gap // s
            full = min(sequences, left[s] // each)
            if full:
                put(s, sequence, full, each, capacity - gap)
                leave(gap - each * s, sequence, full)
            rest = left[s] if full < sequences else 0
            if rest:
                put(s, sequence + full, 1, rest, capacity - gap)
                leave(gap - rest * s, sequence + full, 1)
                full += 1
            leave(gap, sequence + full, sequences - full)
    return places, total


class Encoder:
    """Ids of texts by ranks and a pattern of pre-tokens.

    ``pattern`` may look ahead only to leave the last of several white-space characters to what follows; ``_LOOK`` is that
    part. Where no two white-space characters meet it decides nothing, and a pattern without it runs much faster.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        from tiktoken import Encoding

        self.full = Encoding("full", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        plain = pattern.replace(_LOOK, "") if pattern.endswith(_LOOK + r"|\s+") else pattern
        self.plain = Encoding("plain", pat_str=plain, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode(self, text: str) -> np.ndarray:
        met = any(x in text for x in _RUNS) or any(c in text for c in _OTHER)
        return np.frombuffer(array("I", (self.full if met else self.plain)(text)), np.uint32)


def pieces(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text",
           ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, _part, _rank) for every piece of every text; with ``ids``, also ids array<int>.

    Only documents of more than ``capacity`` tokens (their end included) are cut, from their end on, so the first piece may
    be shorter. _rank counts the pieces of one length within task _part; write the frame before it is read twice.
    """
    schema = f"{doc_id} long, piece int, start long, length long, ids_crc32 long, _part int, _rank long" + (", ids array<int>" if ids else "")
    shape = to_arrow_schema(T.StructType.fromDDL(schema))
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))  # bounded by the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part, met = Encoder(sent.value, pattern), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b in parts(batches, 100):
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seq = np.append(tool.encode(t), np.uint32(END)).astype("<u4")
                cut = len(seq) % capacity or capacity
                for k, (lo, hi) in enumerate(zip([0, *range(cut, len(seq), capacity)], range(cut, len(seq) + 1, capacity))):
                    own, n = seq[lo:hi], hi - lo
                    rows.append((i, k, lo, n, zlib.crc32(own.tobytes()), part, met[n], *([own.astype(np.int32)] if ids else [])))
                    met[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)

    chosen = text_batches(docs).select(F.col(doc_id).cast("long").alias(doc_id), F.coalesce(F.col(text), F.lit("")).alias("t"))
    return chosen.mapInArrow(run, schema)


def pack(docs: DataFrame, ranks_path: str, pattern: str, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text",
         ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; with ``ids``, also the ids themselves.

    A document is the ids of its text (null: no text) and END, so an empty one takes one token. Strings of special tokens are
    ordinary text. Repeated rows and null ids are packed like others; other columns are not returned; an empty table gives
    no rows. ``ranks_path`` names a file of byte-level BPE ranks and ``pattern`` its pre-tokens; the ids are those that the
    `tokenizers` library gives for the same vocabulary.

    Texts are read once; the pieces are written without shuffle, numbered by length within their task. What goes to the
    driver, and from there to all tasks, is bounded by ``capacity``: counts per length, and some places per length.
    """
    spark = docs.sparkSession
    found = cut_lineage(pieces(docs, ranks_path, pattern, capacity, doc_id, text, ids), "pieces")
    counts = measured(found.groupBy("_part", "length").agg(F.count("*").alias("n")))
    sums = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``capacity`` rows
    places, _ = plan({r.length: r.n for r in sums}, capacity)
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = measured(counts.select("_part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")))
    ranked = found.join(before, ["_part", "length"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    table = small_frame(spark, places, "length long, first long, count long, sequence long, each long, offset long")
    fits = (F.col("d.length") == F.col("p.length")) & (F.col("_rank") >= F.col("first")) & (F.col("_rank") < F.col("first") + F.col("count"))
    met = ranked.alias("d").join(F.broadcast(table.alias("p")), fits)  # a few rows per length
    return met.select(doc_id, "piece", "start", "d.length", "ids_crc32", F.expr("sequence + (_rank - first) div each").alias("sequence_id"),
                      F.expr("p.offset + (_rank - first) % each * d.length").alias("offset"), *(["ids"] if ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids array<int> in order, from `pack` with ``ids``. A sequence holds at most its capacity of ids."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return rows.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
