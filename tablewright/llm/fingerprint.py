"""Quartile digests of texts and their likeness.

Hashed byte triplets are counted in 256 buckets. The digest holds a check byte, the length on a logarithmic scale, the
ratios of the counts' quartiles and, per bucket, the quartile its count falls into. Two digests differ by a bounded
sum over these parts; unrelated texts come out near zero likeness.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.llm.common import text_batches

BUCKETS = 256
#: Mean sum of bucket differences between unrelated digests: 1.25 for two independent quartiles.
UNRELATED = 1.25 * BUCKETS
_PICKS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_FIRST = -(1 << 63)


def fingerprint(data: bytes) -> str:
    """Hex digest: check byte, length byte, quartile-ratio byte, 64 bytes of bucket quartiles. Empty bytes have one too."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    for salt, pick in enumerate(_PICKS):
        n = len(b) - pick[-1]
        if n > 0:
            h = np.full(n, np.uint32(salt + 1))
            for k, m in zip(pick, _MIX):
                h = (h ^ b[k: k + n]) * m
            counts += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    q = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts[:, None] > q[None, :]).sum(axis=1).astype(np.uint8)
    ratio = [min(15, int(16 * x / q[2])) if q[2] else 0 for x in q[:2]]
    length = min(255, int(np.log(max(len(b), 1)) * 10))
    head = bytes([zlib.crc32(data) & 255, length, ratio[0] * 16 + ratio[1]])
    return (head + (code.reshape(-1, 4) << np.array([6, 4, 2, 0], np.uint8)).sum(axis=1).astype(np.uint8).tobytes()).hex()


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 from the difference of unrelated ones on; symmetric."""
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint8).astype(np.int64) for s in (a, b))
    codes = [(v[3:, None] >> np.array([6, 4, 2, 0])) & 3 for v in (x, y)]
    diff = np.abs(codes[0] - codes[1]).sum() + (x[0] != y[0]) + 2 * max(0, abs(x[1] - y[1]) - 1)
    diff += sum(max(0, abs((x[2] >> s & 15) - (y[2] >> s & 15)) - 1) for s in (4, 0))
    return max(0.0, 1.0 - float(diff) / UNRELATED)


def with_edit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Digest of every text and of its edited form, in which the last quarter makes way for the next text's start.

    One row per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The next
    text is that of the next row by (doc_id, text), the first row's after the last; a null text counts as empty and a
    null id comes first. An empty table gives no rows. Rows are dealt once, by id ranges that begin at ids that exist;
    only the row a range begins with is sent to the range before it as well. Each task walks its sorted range with one
    row in hand. Other columns are not returned.
    """
    spark = text_batches(docs).sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(_FIRST)).alias("k"))
    marks = [i / parts for i in range(1, parts)] or [0.5]
    found = rows.agg(F.min("k"), F.percentile_approx("k", marks, max(10_000, 20 * parts))).first()
    if found[0] is None:
        found = (0, [])
    low, cuts = found[0], np.array(sorted({x for x in found[1] if x > found[0]}), np.int64)  # at most ``parts``

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row for its own range; the first of a range also, marked, for the range before."""
        for b in batches:
            k = b.column(2).to_numpy()
            home = np.searchsorted(cuts, k, side="right")
            first = np.flatnonzero((home > 0) & (cuts[np.maximum(home - 1, 0)] == k)) if len(cuts) else np.empty(0, np.int64)
            wrap = np.flatnonzero(k == low)
            own = pa.RecordBatch.from_arrays([*b.columns, pa.array(home.astype(np.int32)), pa.array(np.zeros(len(k), np.int32))], schema=shape)
            yield own
            for at, to in ((first, home[first] - 1), (wrap, np.full(len(wrap), len(cuts)))):
                if len(at):
                    picked = b.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(to.astype(np.int32)), pa.array(np.ones(len(at), np.int32))], schema=shape)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, False
        for b in batches:
            out = []
            for i, t, lent in zip(*(b.column(c).to_pylist() for c in range(3))):
                if done:
                    continue
                print_of = fingerprint(t.encode())
                if held:
                    j, s, own = held
                    n = len(s)
                    edited = (s[: n - n // 4] + t[: n // 4]).encode()
                    changed = fingerprint(edited)
                    out.append((j, n, hashlib.sha256(edited).hexdigest(), own, changed, likeness(own, changed), likeness(own, print_of)))
                held, done = (i, t, print_of), lent == 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), result)], schema=result)

    shape = to_arrow_schema(T.StructType.fromDDL("id long, t string, k long, part int, lent int"))
    schema = (f"{doc_id} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    result = to_arrow_schema(T.StructType.fromDDL(schema))
    dealt = rows.mapInArrow(homes, "id long, t string, k long, part int, lent int").repartitionById(len(cuts) + 1, F.col("part"))
    return dealt.sortWithinPartitions("lent", "k", "t").select("id", "t", "lent").mapInArrow(walk, schema)
