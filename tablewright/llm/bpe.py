"""Byte-level BPE encoding and decoding in which every distinct word is encoded once.

Texts are cut into pre-tokens. A task writes its texts as positions in the list of its own distinct words; that list
is dealt by word over all tasks, each distinct word is encoded once there, and the ids go back to the lists and are
put in place by position. Decoding gathers the bytes of the ids from the token table.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from array import array
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tablewright.llm.common import parts, text_batches


KNOWN = 1_000_000  # distinct words whose ids a task remembers before it starts anew


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges in rank order: always the lowest-ranked adjacent pair, leftmost first."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i: i + 1] for i in range(len(word))]
    if len(parts) > 200:
        return _encode_long(parts, ranks)
    while len(parts) > 1:
        at, best = -1, None
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                at, best = i, r
        if best is None:
            break
        parts[at: at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _encode_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a very long word, with a heap over a linked list of parts."""
    import heapq

    after = list(range(1, len(parts))) + [-1]
    before = list(range(-1, len(parts) - 1))
    heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] is not left or j < 0 or parts[j] is not right:
            continue
        parts[i], parts[j] = left + right, b""
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] >= 0 and (r := ranks.get(parts[a] + parts[after[a]])) is not None:
                heapq.heappush(heap, (r, a, parts[a], parts[after[a]]))
    return [ranks[p] for p in parts if p]


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative integers as compressed 7-bit groups."""
    numbers = numbers.astype(np.uint64)
    groups = np.stack([(numbers >> np.uint64(7 * i)) & np.uint64(127) for i in range(5)], axis=1).astype(np.uint8)
    more = np.stack([numbers >= np.uint64(1 << (7 * (i + 1))) for i in range(4)], axis=1)
    groups[:, :4] |= more.astype(np.uint8) << 7
    keep = np.hstack([np.ones((len(numbers), 1), bool), more])
    return zstandard.ZstdCompressor(3).compress(groups[keep].tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    value = (raw & 127).astype(np.int64) << (7 * place)
    return np.add.reduceat(value, first) if len(first) else value


def _pack_words(words: list[bytes]) -> bytes:
    return _joined(pack(np.fromiter(map(len, words), np.int64, len(words))), zstandard.ZstdCompressor(3).compress(b"".join(words)))


def _unpack_words(data: bytes) -> list[bytes]:
    sizes, text = _split(data)
    sizes, text = unpack(sizes), zstandard.ZstdDecompressor().decompress(text)
    ends = np.cumsum(sizes)
    return [text[e - s: e] for s, e in zip(sizes.tolist(), ends.tolist())]


class Derived(NamedTuple):
    """Columns computed from id sequences: their DDL, and a function from the sequences to Arrow arrays."""

    schema: str
    columns: Callable[[list[np.ndarray]], list[pa.Array]]


def _joined(a: bytes, b: bytes) -> bytes:
    return len(a).to_bytes(4, "little") + a + b


def _split(data: bytes) -> tuple[bytes, bytes]:
    cut = 4 + int.from_bytes(data[:4], "little")
    return data[4:cut], data[cut:]


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", carry: str = "doc_id long",
           buckets: int | None = None, block_words: int = 120_000, derive: Derived | None = None) -> DataFrame:
    """Columns ``carry`` (a DDL list) plus ids array<int>, one row per row of ``docs``.

    ``derive`` adds columns computed from the ids in the task that puts them together (`digests`).

    A null or empty text has no ids. Repeated rows give repeated rows; other columns are not returned. A block ends
    once it has ``block_words`` distinct words (or as many tokens times eight), which bounds a task's memory; a text is
    never cut. ``buckets`` (default: the session's shuffle partitions) is the number of parts the distinct words are
    dealt over.

    Token streams and word lists leave the tokenising task through one shuffle, which both the encoding of the lists
    and the reassembly read. A block's name holds a digest of its word list, so ids computed for another run of a lost
    task cannot be mistaken for its own: the job fails instead.
    """
    spark = text_batches(docs).sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = T.StructType.fromDDL(carry).names
    sent = spark.sparkContext.broadcast(read_ranks(ranks_path))  # bounded by the vocabulary file
    schema = f"_route string, _block string, _data binary, {carry}"
    shape = to_arrow_schema(T.StructType.fromDDL(schema))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block: each text as ranks of the block's words by frequency (routed to the block), and the words (to their buckets)."""
        find = regex.compile(pattern).findall
        part, number, total = TaskContext.get().partitionId(), 0, 0
        at: dict[str, int] = {}
        rows: list[tuple] = []

        def flush() -> Iterator[pa.RecordBatch]:
            words = [w.encode() for w in at]
            used = np.zeros(len(words), np.int64)
            for seq, _ in rows:
                np.add.at(used, seq, 1)
            order = np.argsort(-used, kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            digest = zlib.crc32(b"\0".join(words[i] for i in order))
            block = f"{part}-{len(words)}-{digest:08x}-{number}"
            home = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
            out = [("b" + block, block, pack(rank[seq]), *own) for seq, own in rows]
            for b in np.unique(home):
                mine = np.flatnonzero(home == b)
                mine = mine[np.argsort(rank[mine])]
                out.append((f"w{b}", block, _joined(pack(np.diff(rank[mine], prepend=0)), _pack_words([words[i] for i in mine])), *[None] * len(names)))
            for k in range(0, len(out), 500):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[k: k + 500]), shape)], schema=shape)

        for b in parts(batches):
            for t, *own in zip(*(c.to_pylist() for c in b.columns)):
                rows.append((np.array([at.setdefault(w, len(at)) for w in find(t)] if t else [], np.int32), own))
                total += len(rows[-1][0])
                if len(at) >= block_words or total >= 8 * block_words or len(rows) >= 200_000:
                    yield from flush()
                    number, total = number + 1, 0
                    at.clear()
                    rows.clear()
        if rows:
            yield from flush()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Word lists to id lists; each distinct word is encoded once, or anew after KNOWN others. Token streams are passed over."""
        ranks, known = sent.value, {}
        for b in batches:
            lists = b.filter(pc.starts_with(b.column("_route"), "w"))
            out = []
            for block, data in zip(lists.column("_block").to_pylist(), lists.column("_data").to_pylist()):
                places, words = _split(data)
                ids = []
                if len(known) > KNOWN:
                    known.clear()
                for w in _unpack_words(words):
                    if w not in known:
                        known[w] = array("i", encode_word(w, ranks))
                    ids.append(known[w])
                flat = np.concatenate([np.frombuffer(x, np.int32) for x in ids])
                out.append(("b" + block, places, pack(np.fromiter(map(len, ids), np.int64, len(ids))), pack(flat)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), listed)], schema=listed)

    def placed(words: pa.Table, texts: pa.Table) -> pa.Table:
        if words.num_rows == 0 and texts["_route"][0].as_py().startswith("w"):
            texts = texts.slice(0, 0)
        rank, length, flat = ([unpack(x) for x in words[c].to_pylist()] for c in ("ranks", "lengths", "ids"))
        none = np.empty(0, np.int64)
        order = np.concatenate([np.cumsum(r) for r in rank] or [none])
        length, flat = (np.concatenate(x or [none]) for x in (length, flat))
        if texts.num_rows and len(order) != int(texts["_block"][0].as_py().split("-")[1]):
            raise ValueError("the ids of a block are not those of its words")
        start, size = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        start[order], size[order] = np.cumsum(length) - length, length
        out = []
        for data in texts["_data"].to_pylist():
            seq = unpack(data)
            n = size[seq]
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out.append(flat[np.repeat(start[seq], n) + inner].astype(np.int32))
        more = derive.columns(out) if derive else []
        return pa.Table.from_arrays([*texts.select(names).columns, pa.array(out, pa.list_(pa.int32())), *more], schema=result)

    result = to_arrow_schema(T.StructType.fromDDL(f"{carry}, ids array<int>" + (f", {derive.schema}" if derive else "")))
    listed = to_arrow_schema(T.StructType.fromDDL("_route string, ranks binary, lengths binary, ids binary"))
    mixed = docs.select(text, *names).mapInArrow(tokens, schema).repartition(buckets, "_route")
    ids = mixed.mapInArrow(encoded, "_route string, ranks binary, lengths binary, ids binary")
    return ids.groupBy("_route").cogroup(mixed.groupBy("_route")).applyInArrow(placed, from_arrow_schema(result))


def decoder(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token table as (start, length, all bytes), indexed by id."""
    size = max(ranks.values(), default=-1) + 1
    table = [b""] * size
    for token, i in ranks.items():
        table[i] = token
    length = np.fromiter(map(len, table), np.int64, size)
    return np.cumsum(length) - length, length, np.frombuffer(b"".join(table), np.uint8)


def join_bytes(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    """The bytes of an id sequence: each id meets its row of the token table."""
    start, length, data = table
    n = length[ids]
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return data[np.repeat(start[ids], n) + inner].tobytes()


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` plus decoded binary, one row per row; null ids decode to null, no ids to no bytes.

    The token table is bounded by the vocabulary file and therefore sent to the tasks.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(decoder(read_ranks(ranks_path)))

    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([None if x is None else join_bytes(np.asarray(x, np.int64), sent.value) for x in b], dtype=object)

    return text_batches(encoded).select(*carry, F.pandas_udf(decoded, "binary")(F.col(ids)).alias("decoded"))


def digests(spark: SparkSession, ranks_path: str) -> Derived:
    """n_tokens, and the SHA-256 of the ids (little-endian unsigned 32 bit) and of the bytes they decode to."""
    sent = spark.sparkContext.broadcast(decoder(read_ranks(ranks_path)))

    def columns(seqs: list[np.ndarray]) -> list[pa.Array]:
        return [pa.array([len(x) for x in seqs], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in seqs], pa.string()),
                pa.array([hashlib.sha256(join_bytes(x, sent.value)).hexdigest() for x in seqs], pa.string())]

    return Derived("n_tokens long, ids_sha256 string, decoded_sha256 string", columns)
