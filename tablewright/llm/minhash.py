"""Near-duplicate texts by fast similarity sketches, banding and exact verification.

A text is the set of its distinct word shingles. The sketch (Dahlgaard, Knudsen and Thorup, 2017) fills ``t`` coordinates in
rounds: in round i < t each element falls into one hashed bin, in round t + j all elements fall into bin j, and a bin
keeps the smallest value of the first round that reached it. So every coordinate is filled, in time about
t log t + n instead of t n, and agreement concentrates as with independent minima.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.llm.common import components, mix64, parts, text_batches
from tablewright.session import cut_lineage

MISS = 1e-7       # probability that a pair at the threshold shares no band
WIDE = 4096       # bits of the sketch that compares texts of one bucket in different components
MARKS = 1 << 23   # bits of the bitmap that picks candidates' texts, and keys with company
TILE = 256        # members of a bucket that are compared with as many others at a time
SLACK = 7.0       # standard deviations by which a linked pair's sketch may disagree more than expected
_NONE, _LOW40 = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64((1 << 40) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shape_of(threshold: float) -> tuple[int, int, int]:
    """(bands, coordinates per band, sketch bits).

    A band's length makes a pair at the threshold share it with probability near 0.27; the number of bands brings the
    probability that it shares none below MISS.
    """
    rows = max(1, round(math.log(0.27) / math.log(threshold)))
    bands = math.ceil(math.log(MISS) / math.log1p(-(threshold ** rows)))
    return bands, rows, bands * rows // 64 * 64


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles: A-Z lower-cased, words cut at ASCII white space; fewer words make one shingle."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    known: dict[bytes, int] = {}
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    k = min(size, len(h))
    out = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        out = mix64(out * _STEP + h[i: len(h) - k + 1 + i])
    return np.unique(out)


def sketch(items: np.ndarray, t: int) -> np.ndarray:
    """The ``t`` coordinates of a non-empty set of 64-bit hashes.

    A value holds its round above 40 hash bits, so the minimum per bin is the earliest round's smallest hash.
    """
    low = np.full(t, _NONE)
    done = 0
    while done < t and (low == _NONE).any():
        some = min(t - done, max(1, 2 * t // len(items)))
        turn = np.arange(done, done + some, dtype=np.uint64)[:, None]
        h = mix64(items[None, :] ^ mix64((turn + np.uint64(1)) * _STEP))
        place = ((h >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(low, place.ravel(), (turn << np.uint64(40) | h & _LOW40).ravel())
        done += some
    for j in np.flatnonzero(low == _NONE).tolist():
        turn = np.array([t + j], np.uint64)
        low[j] = (turn << np.uint64(40) | (mix64(items ^ mix64((turn + np.uint64(1)) * _STEP)) & _LOW40).min())[0]
    return mix64(low)


def _signature(items: np.ndarray, bands: int, length: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash per band and the lowest bit of the first ``bits`` coordinates, packed into longs."""
    s = sketch(items, bands * length)
    rows = s.reshape(bands, length)
    band = np.arange(1, bands + 1, dtype=np.uint64) * _STEP
    for i in range(length):
        band = mix64(band * _STEP + rows[:, i])
    packed = np.packbits((s[:bits] & np.uint64(1)).astype(np.uint8)).view(np.int64)
    return band.view(np.int64), packed


def sketched(docs: DataFrame, doc_id: str, text: str, size: int, threshold: float) -> DataFrame:
    """(doc_id, n, d1, d2, bands, bits): size and 128-bit digest of the set, band hashes and sketch bits (null for an empty set)."""
    bands, length, bits = shape_of(threshold)
    schema = "doc_id long, n long, d1 long, d2 long, bands array<long>, bits array<long>"
    shape = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            cols: list[list] = [[] for _ in range(6)]
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                items = shingle_hashes(x, size)
                row = (None, None, None, None)
                if len(items):
                    digest = xxhash.xxh3_128_intdigest(items.tobytes())
                    halves = np.array([digest >> 64, digest & 0xFFFFFFFFFFFFFFFF], np.uint64).view(np.int64).tolist()
                    row = (*halves, *_signature(items, bands, length, bits))
                for c, v in zip(cols, (i, len(items), *row)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, shape)], schema=shape)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose full shingle sets reach ``percent``; texts meet their pairs by joins."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = _one_text(texts, cut_lineage(ids, "ids"))
    right = pairs.join(texts.withColumnsRenamed({"doc_id": "b", "text": "tb"}), "b")
    both = right.join(texts.withColumnsRenamed({"doc_id": "a", "text": "ta"}), "a").select("a", "b", "ta", "tb")

    shape = to_arrow_schema(T.StructType.fromDDL("a long, b long"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, items = None, np.empty(0, np.uint64)
        for b in parts(batches):
            keep = []
            for x, ta, tb in zip(*(b.column(c).to_pylist() for c in (0, 2, 3))):
                if (x, ta) != held:
                    held, items = (x, ta), shingle_hashes(ta, size)
                other = shingle_hashes(tb, size)
                common = len(np.intersect1d(items, other, assume_unique=True))
                keep.append(100 * common >= percent * (len(items) + len(other) - common) and common > 0)
            yield pa.RecordBatch.from_arrays(b.select([0, 1]).filter(pa.array(keep)).columns, schema=shape)

    return both.mapInArrow(check, "a long, b long")


def _wide(texts: DataFrame, size: int) -> DataFrame:
    """(doc_id, wide): one bit of each of WIDE coordinates, packed into longs; for texts that need a sharper sketch."""
    shape = to_arrow_schema(T.StructType.fromDDL("doc_id long, wide array<long>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            bits = [np.packbits((sketch(shingle_hashes(t, size), WIDE) & np.uint64(1)).astype(np.uint8)).view(np.int64)
                    for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bits, shape.field(1).type)], schema=shape)

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, wide array<long>")


def _open_buckets(labelled: DataFrame) -> DataFrame:
    """key, top, tiles, others of the buckets whose members (doc_id, key, component_id) are in different components.

    ``top`` is the component most members are in; all members make ``tiles`` of about TILE, those outside of it ``others``.
    """
    each = labelled.groupBy("key", "component_id").agg(F.count("*").alias("c"))
    found = each.groupBy("key").agg(F.count("*").alias("n"), F.sum("c").alias("c"), F.max(F.struct("c", "component_id")).alias("t")).where("n > 1")

    def tiles(c: Column) -> Column:
        return F.ceil(c / TILE).cast("int")

    return found.select("key", F.col("t.component_id").alias("top"), tiles(F.col("c")).alias("tiles"), tiles(F.col("c") - F.col("t.c")).alias("others"))


def _dealt(rest: DataFrame) -> DataFrame:
    """The members of open buckets with the groups (i, j) they go to: tile i of those outside of ``top`` meets tile j of all.

    Members of ``top`` need not meet each other, so they go to the tiles of the others only.
    """
    hashed = F.xxhash64("doc_id", F.lit(7))
    mine = rest.withColumns({"left": F.when(F.col("component_id") != F.col("top"), F.pmod(hashed, "others").cast("int")),
                             "right": F.pmod(hashed, "tiles").cast("int")})
    as_right = F.expr("transform(sequence(0, others - 1), i -> struct(i as i, right as j))")
    as_left = F.expr("transform(sequence(0, tiles - 1), j -> struct(left as i, j as j))")
    groups = F.when(F.col("left").isNull(), as_right).otherwise(F.array_union(as_left, as_right))
    return mine.withColumn("g", F.explode(groups)).select("doc_id", "key", "component_id", "top", "left", "right", "g.i", "g.j")


def _across(rest: DataFrame, full: DataFrame, threshold: float, percent: int) -> DataFrame:
    """(a, b): pairs of a bucket in different components whose sizes and wide sketches allow a link.

    ``rest`` holds (doc_id, key, component_id) with the columns of `_open_buckets`. A group compares two tiles of a bucket, so no
    group grows with the bucket. A pair is told in the first of the buckets it shares.
    """
    apart = (1 - threshold) / 2
    most = WIDE * apart + SLACK * math.sqrt(WIDE * apart * (1 - apart))
    dealt = _dealt(rest).join(full, "doc_id")
    shape = to_arrow_schema(T.StructType.fromDDL("a long, b long"))

    def compare(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        band, i, j = (k.as_py() for k in key)
        ids, own, top, right, n = (group[c].to_numpy() for c in ("doc_id", "component_id", "top", "right", "n"))
        main = own == top
        asked = np.flatnonzero(~main & (group["left"].fill_null(-1).to_numpy() == i))
        if own.min() == own.max() or not len(asked):
            return shape.empty_table()
        sketches = group["wide"].combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(ids), -1)
        bands = group["bands"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        found = []
        for x in asked:
            # two members outside of the main component meet twice
            fits = (right == j) & (own != own[x]) & (main | (ids > ids[x])) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
            at = np.flatnonzero(fits)
            at = at[np.bitwise_count(sketches[at] ^ sketches[x]).sum(axis=1, dtype=np.int64) <= most]
            same = bands[at] == bands[x]
            at = at[bands[x][same.argmax(axis=1)] == band] if len(at) else at
            found += [(min(a, b), max(a, b)) for a, b in zip(ids[at].tolist(), [int(ids[x])] * len(at))]
        return pa.Table.from_pylist([{"a": a, "b": b} for a, b in found], schema=shape)

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``; other columns are not returned.

    Two texts are linked if 100 |A and B| >= percent |A or B| over their distinct ``size``-word shingles; component_id is
    the smallest id reachable by links. Null texts and texts without words have the empty set and no links. Repeated
    ids with equal texts share a component; an id that stands for several texts links them. A null id is left alone:
    component_id null, kept.

    Equal sets are merged first, so a group of copies counts once from then on. Band buckets are not expanded into
    pairs: every text meets the smallest id of all its buckets, one pair a text. Only buckets whose members are still
    in different components after that compare those members, tile by tile behind the size bound and a sharper sketch (members of
    the bucket's largest component not with each other), so no
    link between different texts is lost beyond MISS and SLACK. All links are confirmed on full shingle sets.
    """
    threshold = percent / 100
    docs = text_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = docs.where("doc_id is not null")
    base = cut_lineage(sketched(docs, "doc_id", "text", size, threshold), "sketches")
    sets = base.where("n > 0 and doc_id is not null").groupBy("n", "d1", "d2").agg(
        F.min("doc_id").alias("doc_id"), F.min_by(F.struct("bands", "bits"), "doc_id").alias("s"))
    sets = cut_lineage(sets.select("doc_id", "n", "s.bands", "s.bits"), "sets")

    def fits(x: str, y: str, bits: int, name: str = "bits") -> str:
        """SQL: the sizes allow a link, and the sketch bits differ in no more places than a link explains."""
        apart = (1 - threshold) / 2
        most = bits * apart + SLACK * math.sqrt(bits * apart * (1 - apart))
        differing = " + ".join(f"bit_count({x}.{name}[{i}] ^ {y}.{name}[{i}])" for i in range(bits // 64))
        return f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n) and {differing} <= {most}"

    keys = sets.select("doc_id", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("c"), F.min("doc_id").alias("first")).where("c > 1").select("key", "first")
    buckets = cut_lineage(buckets, "buckets")
    # most keys are alone in their bucket and stay where they are
    members = cut_lineage(keys.where(_marked(buckets.select("key"), F.col("key"))).join(buckets, "key"), "members")
    star = members.where("doc_id <> first").groupBy(F.col("doc_id").alias("b")).agg(F.min("first").alias("a"))
    side = sets.select("doc_id", F.struct("n", "bits").alias("s"))
    star = star.join(side.toDF("b", "y"), "b").join(side.toDF("a", "x"), "a")
    star = cut_lineage(star.where(fits("x", "y", shape_of(threshold)[2])).select("a", "b"), "pairs")
    linked = cut_lineage(_confirmed(star, texts, size, percent), "links")
    found = components(linked)

    labelled = members.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id"))
    open_keys = cut_lineage(_open_buckets(labelled), "open")
    rest = cut_lineage(labelled.join(open_keys, "key").select("doc_id", "key", "component_id", "top", "tiles", "others"), "rest")
    wide = _wide(_one_text(texts, rest.select("doc_id").distinct()), size)
    full = cut_lineage(wide.join(sets.select("doc_id", "n", "bands"), "doc_id"), "wide")
    more = cut_lineage(_across(rest, full, threshold, percent).distinct(), "pairs")
    extra = cut_lineage(_confirmed(more, texts, size, percent), "links")
    found = found if extra.isEmpty() else components(linked.union(extra))

    known = base.drop("bands", "bits").where("n > 0 and doc_id is not null")
    first = known.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    copies = known.join(cut_lineage(first, "copies"), ["n", "d1", "d2"], "left").select("doc_id", "n", F.coalesce("first", "doc_id").alias("first"))
    alone = base.where("n = 0 or doc_id is null").select("doc_id", "n", F.col("doc_id").alias("first"))
    owner = copies.union(alone)
    out = owner.join(found.withColumnRenamed("node", "first"), "first", "left")
    component = F.coalesce("component_id", "first")
    return out.select(F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      (F.coalesce(component == F.col("doc_id"), F.lit(True))).alias("kept"))


def _one_text(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of the given ids, repeated rows once (dealt by id already, so this moves nothing)."""
    near = texts.where(_marked(ids.select("doc_id"), F.col("doc_id")))
    return near.join(ids, "doc_id").groupBy("doc_id", "text").agg(F.lit(1).alias("one")).drop("one")


def _marked(ids: DataFrame, of: Column) -> Column:
    """True for every number in the only column of ``ids``, and for few others: a bitmap of hashes, of MARKS bits at most, so
    that a join need not move all rows. Beyond some millions of numbers it passes more, and the join decides."""
    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(MARKS))

    number = F.col(ids.columns[0])
    each = ids.groupBy(F.bitmap_bucket_number(place(number)).alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place(number))).alias("m"))
    marks = each.agg(F.map_from_entries(F.collect_list(F.struct("k", "m")))).scalar()
    bit = F.bitmap_bit_position(place(of))
    byte = F.substring(F.try_element_at(marks, F.bitmap_bucket_number(place(of))), F.floor(bit / 8).cast("int") + 1, F.lit(1))
    on = F.call_function("shiftright", F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")).bitwiseAND(F.lit(1))
    return F.coalesce(on == 1, F.lit(False))
