"""Frequent phrases of a corpus from the weighted de Bruijn graph of its longest grams.

Every word of a text emits one gram: itself and the words after it, up to ``longest`` and to the end of the piece. Longest
grams are the edges of a graph whose nodes are the grams one word shorter; shorter grams are corrections at nodes whose text
ends there. Counts of shorter phrases are the flows through the nodes plus these corrections, so one aggregation serves
all lengths.

Most grams of a corpus are rare, and no rare gram can be a phrase, a part of one or hold one. A first pass therefore counts
hashed grams in ranges of hash values and marks the values met often enough; a word then emits the longest gram all of whose
beginnings are marked. That is exact: a marked value may hold rare grams, but each occurrence of a frequent one is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.llm.common import mix64, parts, text_batches
from tablewright.session import cut_lineage

BLOCK_WORDS = 1_000_000  # words a task holds at a time (one text at least)
RANGES = 1024            # of hash values: a task counts one at a time, in 8 bytes a value
VALUES = 1 << 22         # hash values of a range
FOLD = 16                # hash values that share one of the marks sent to all tasks: 32 MB at most, at any size of the corpus
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CUT = b"\xff"           # no byte of UTF-8; stands for the end of a piece
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz" + _CUT * 10)


class _Numbers(dict):
    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[str], np.ndarray, np.ndarray]]:
    """Blocks of texts as (words, languages, word numbers, language numbers); number 0 ends a piece."""
    words, langs, seqs, of, held = _Numbers({_CUT: 0}), _Numbers(), [], [], 0

    def block() -> tuple[list[bytes], list[str], np.ndarray, np.ndarray]:
        return list(words), list(langs), np.concatenate(seqs), np.repeat(of, list(map(len, seqs)))

    for b in parts(batches):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if not text:
                continue
            found = text.translate(_BYTES).replace(_CUT, b" \xff ").split()
            found.append(_CUT)
            seqs.append(np.fromiter(map(words.__getitem__, found), np.int64, len(found)))
            of.append(langs[lang])
            held += len(found)
            if held >= BLOCK_WORDS:
                yield block()
                words, langs, seqs, of, held = _Numbers({_CUT: 0}), _Numbers(), [], [], 0
    if seqs:
        yield block()


def _hashes(words: list[bytes], langs: list[str], ids: np.ndarray, of: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1: the 32-bit hash of the gram that begins at every place, and whether there is one."""
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    lang = np.fromiter(map(xxhash.xxh3_64_intdigest, langs), np.uint64, len(langs))
    h, there = lang[of], np.ones(len(ids), bool)
    for k in range(longest):
        h = mix64(h[: len(ids) - k] * _STEP + word[ids[k:]])
        there = there[: len(ids) - k] & (ids[k:] > 0)
        yield (h >> np.uint64(32)).astype(np.uint32), there


def _packed(places: np.ndarray, squeeze: zstandard.ZstdCompressor) -> bytes:
    """Ascending 32-bit numbers, as byte planes of their differences."""
    return squeeze.compress(np.diff(places, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def _marks(texts: DataFrame, least: int, longest: int) -> np.ndarray:
    """A bit per FOLD hash values: whether one of them was met ``least`` times. Packed, the lowest bit of a byte first."""
    shape = to_arrow_schema(T.StructType.fromDDL("part int, data binary"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(1)
        for block in _blocks(batches):
            places = np.sort(np.concatenate([h[there] for h, there in _hashes(*block, longest)]))
            cuts = np.searchsorted(places, np.arange(1, RANGES, dtype=np.uint64) * np.uint64(VALUES))
            found = [(i, _packed(own - np.uint32(i * VALUES), squeeze)) for i, own in enumerate(np.split(places, cuts)) if len(own)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), shape)], schema=shape)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The marks of each range. Its rows follow one another; few values are sorted, more are counted in place."""
        at, waiting, size, met = None, [], 0, None

        def sums() -> tuple[np.ndarray, np.ndarray]:
            return np.unique(np.concatenate(waiting or [np.empty(0, np.uint32)]), return_counts=True)

        def marks() -> pa.RecordBatch:
            values, count = sums()
            if met is not None:
                met[values] += count
                values = np.flatnonzero(met >= least)
            else:
                values = values[count >= least]
            often = np.zeros(VALUES // FOLD, bool)
            often[values // FOLD] = True
            bits = zstandard.ZstdCompressor(1).compress(np.packbits(often, bitorder="little").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([bits])], schema=shape)

        for b in batches:
            for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i != at:
                    if at is not None:
                        yield marks()
                    at, waiting, size, met = i, [], 0, None
                waiting.append(_unpacked(data))
                size += len(waiting[-1])
                if size > VALUES // 4:
                    met = np.zeros(VALUES, np.int64) if met is None else met
                    values, count = sums()
                    met[values] += count
                    waiting, size = [], 0
        if at is not None:
            yield marks()

    tasks = min(RANGES, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = texts.mapInArrow(hashed, "part int, data binary").repartition(tasks, "part").sortWithinPartitions("part")
    out = np.zeros(RANGES * VALUES // FOLD // 8, np.uint8).reshape(RANGES, -1)
    for i, data in dealt.mapInArrow(counted, "part int, data binary").toLocalIterator():  # RANGES rows at most, 32 KB each
        out[i] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), np.uint8)
    return out.ravel()


def grams(texts: DataFrame, least: int, longest: int) -> DataFrame:
    """(lang, gram, k, c): counts of the emitted grams of k words, space-joined; k = 0 counts all words of a language."""
    marks = texts.sparkSession.sparkContext.broadcast(_marks(texts, least, longest))
    schema = "lang string, gram string, k int, c long"
    shape = to_arrow_schema(T.StructType.fromDDL(schema))

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = marks.value
        for words, langs, ids, of in _blocks(batches):
            size, on = np.zeros(len(ids), np.int8), np.ones(len(ids), bool)
            for k, (h, there) in enumerate(_hashes(words, langs, ids, of, longest)):
                bit = h // np.uint32(FOLD)
                on = on[: len(h)] & there & (marked[bit >> np.uint32(3)] >> (bit & np.uint32(7)).astype(np.uint8) & 1).astype(bool)
                size[: len(h)] += on
            out = [(langs[i], "", 0, int(n)) for i, n in enumerate(np.bincount(of[ids > 0], minlength=len(langs)))]
            for k in range(1, longest + 1):
                at = np.flatnonzero(size == k)
                code = of[at]
                for i in range(k):  # a number for each beginning, from those of its own beginning: never above 64 bits
                    code = np.unique(code * len(words) + ids[at + i], return_inverse=True)[1] if i < k - 1 else code * len(words) + ids[at + i]
                _, first, count = np.unique(code, return_index=True, return_counts=True)
                for p, c in zip(at[first].tolist(), count.tolist()):
                    out.append((langs[of[p]], b" ".join([words[w] for w in ids[p: p + k].tolist()]).decode(), k, c))
            for i in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[i: i + 20_000]), shape)], schema=shape)

    return texts.mapInArrow(emitted, schema).groupBy("lang", "gram", "k").agg(F.sum("c").alias("c"))


def _first(n: int, gram: str = "gram") -> Column:
    return F.substring_index(gram, " ", n)


def paths(found: DataFrame, longest: int) -> DataFrame:
    """(lang, words, c): the graph's edges with unary paths joined, words array<string> of ``longest`` or more.

    A node is passed over if it has one edge in, one out, of equal weight, and no text ends there. Then no text starts there
    either, so no closed ring of such nodes exists, and doubling the reach of every edge ends after the logarithm of
    the longest path. A path is at most as long as a piece of a text.
    """
    edges = found.where(F.col("k") == longest).select("lang", "gram", "c", F.monotonically_increasing_id().alias("id"))
    edges = cut_lineage(edges, "edges")

    def degree(node: Column, name: str) -> DataFrame:
        each = edges.groupBy("lang", node.alias("node")).agg(F.count("*").alias("n"), F.min("c").alias("c"), F.min("id").alias(name))
        return each.where("n = 1").drop("n")

    ends = found.where(F.col("k") == longest - 1).select("lang", F.col("gram").alias("node"))
    unary = degree(_first(longest - 1), "id").join(degree(_first(1 - longest), "prev"), ["lang", "node", "c"]).join(ends, ["lang", "node"], "left_anti")
    reach = edges.select("id").join(unary.select("id", "prev"), "id", "left").select(
        "id", F.coalesce("prev", "id").alias("prev"), F.when(F.col("prev").isNull(), 0).otherwise(1).cast("long").alias("steps"))
    reach, longest_step = cut_lineage(reach, "reach"), 1
    while not reach.where(F.col("steps") >= longest_step).isEmpty():
        ahead = reach.select(F.col("id").alias("prev"), F.col("prev").alias("p"), F.col("steps").alias("more"))
        reach = cut_lineage(reach.join(ahead, "prev").select("id", F.col("p").alias("prev"), (F.col("steps") + F.col("more")).alias("steps")), "reach")
        longest_step *= 2
    joined = reach.join(edges, "id").groupBy("prev").agg(
        F.first("lang").alias("lang"), F.first("c").alias("c"), F.array_sort(F.collect_list(F.struct("steps", "gram"))).alias("g"))
    rest = F.transform(F.slice("g", 2, F.greatest(F.size("g") - 1, F.lit(0))), lambda x: F.substring_index(x["gram"], " ", -1))
    return joined.select("lang", F.concat(F.split(F.col("g")[0]["gram"], " "), rest).alias("words"), "c")


def phrase_counts(found: DataFrame, longest: int) -> DataFrame:
    """(lang, gram, k, f): occurrences of every phrase of 1 to ``longest`` words; exact for those met often enough to be marked."""
    joined = cut_lineage(paths(found, longest), "paths")

    def windows(k: int) -> DataFrame:
        """The ``k`` words every edge of a path begins with."""
        starts = F.sequence(F.lit(1), F.size("words") - (longest - 1))
        each = F.transform(starts, lambda i: F.array_join(F.slice("words", i, F.lit(k)), " "))
        return joined.select("lang", F.explode(each).alias("gram"), "c")

    by = [windows(longest).withColumnRenamed("c", "f")]
    flow = windows(longest - 1)
    for k in range(longest - 1, 0, -1):
        own = flow.union(found.where(F.col("k") == k).select("lang", "gram", "c"))
        by.append(cut_lineage(own.groupBy("lang", "gram").agg(F.sum("c").alias("f")), "flow"))
        flow = by[-1].select("lang", _first(k - 1).alias("gram"), F.col("f").alias("c"))
    out = None
    for k, part in zip(range(longest, 0, -1), by):
        part = part.select("lang", "gram", F.lit(k).alias("k"), "f")
        out = part if out is None else out.union(part)
    return out


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, longest: int = 4, covered: int = 80, lang: str = "lang",
                 text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. A null language counts as
    ``und``, a null or empty text has no words. Candidates occur ``least`` times or more (a). Cut after its first words, one
    has l occurrences of the first part and r of the rest, and scores floor(2000000 a / (l + r)); its lowest cut counts, the
    earliest of equals. A candidate inside a longer one that has ``covered`` percent of its occurrences is left out. n counts
    the words of the language. Ranks go by score and a, falling, then by the phrase's bytes. Repeated rows count each;
    other columns are not read. An empty table gives no rows.
    """
    chosen = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    found = cut_lineage(grams(text_batches(chosen), least, longest), "grams")
    counts = cut_lineage(phrase_counts(found, longest).where(F.col("f") >= least), "phrases")
    f = counts.select("lang", "gram", "f")
    candidates = counts.where("k >= 2").select("lang", "gram", "k", F.col("f").alias("a"))

    words = F.split("gram", " ")

    def part(start, size) -> Column:
        return F.array_join(F.slice(words, start, size), " ")

    def cut(j: Column) -> Column:
        return F.struct(j.alias("j"), part(F.lit(1), j).alias("left"), part(j + 1, F.col("k") - j).alias("right"))

    cuts = candidates.select("lang", "gram", "k", "a", F.explode(F.transform(F.sequence(F.lit(1), F.col("k") - 1), cut)).alias("cut"))
    cuts = cuts.select("lang", "gram", "a", "cut.*").join(f.toDF("lang", "left", "l"), ["lang", "left"]).join(f.toDF("lang", "right", "r"), ["lang", "right"])
    score = F.expr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + r)")
    best = cuts.withColumn("score", score).groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "j", "l", "r")).alias("m"))

    def inside(k: Column) -> Column:
        """All phrases of 2 to k - 1 words within a phrase of k."""
        def of_size(size: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), k - size + 1), lambda i: part(i, size))
        return F.flatten(F.transform(F.sequence(F.lit(2), k - 1), of_size))

    longer = candidates.where("k > 2").select("lang", F.explode(F.array_distinct(inside(F.col("k")))).alias("gram"), F.col("a").alias("f"))
    longer = longer.groupBy("lang", "gram").agg(F.max("f").alias("f"))
    kept = best.join(longer, ["lang", "gram"], "left").where(
        f"f is null or cast(f as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {int(covered)}")
    total = found.where("k = 0").select("lang", F.col("c").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = kept.select("lang", F.col("gram").alias("phrase"), "a", "m.l", "m.r", "m.score").withColumn("rank", F.row_number().over(order))
    return rows.where(F.col("rank") <= top).join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
