"""Regression forests grown to purity, with any number of outputs.

A tree takes its rows with weights drawn per row and tree (Poisson with mean 1, the bootstrap of a table that nobody
counts out). While a node holds more than ``task_rows`` rows it is split by histograms: one pass gives the ranges of its
features, the next one sums the outputs over equal parts of these ranges. As soon as a node fits a task, its rows are
sent there and the whole subtree is grown in memory, all subtrees side by side. So a forest costs a few passes over the
table plus one shuffle, whatever the depth of its trees. Rows of one place lie side by side, so that most blocks of rows fall
in one node of a tree as a whole and are added up there from one sorted order for all trees. Where the features take few distinct values together (hours, days,
categories), a tree depends on its rows by their sums per point only: one pass adds these up, and whole trees are grown from them.

Splits lower the summed squared error of all outputs. Large nodes split at one of BINS parts, small ones at the best midpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tablewright.operators.filters import require
from tablewright.session import cut_lineage, small_frame

BINS = 64                # parts of a feature's range in a histogram
HIST_BYTES = 128 << 20   # of histograms a task holds at a time
SENT_BYTES = 64 << 20    # a model up to this size is sent to all tasks; a larger one meets its rows in a shuffle
BUSY_ROWS = 50_000       # rows that meet one subtree in one task
FEW_POINTS = 4096        # distinct points up to which a tree is grown from sums per point
NEAR_ROWS = 16_384       # rows whose nodes are grown together once they are small
BLOCK_BYTES = 4 << 20    # of rows a task sorts by node at a time; those of a node travel together
AREA_BYTES = 1 << 20     # of rows of one place that are added up together
CELL_ROWS = 4096         # rows of a cell of the guide, the tree by which training rows are laid out
GUIDE_CELLS = 4096       # cells of the guide at most, each from SAMPLE_PER_CELL rows of a sample
SAMPLE_PER_CELL = 32
ENDS = 32                # rows at the ends of an order that are looked at for the first one drawn
BOND = 16                # nodes of about one place, in other trees, that are grown in one task

MODEL = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("data", pa.binary())])  # of the stored subtrees


class Tree(NamedTuple):
    """Nodes in arrays: a split sends x[feature] <= threshold to ``left``, else to left + 1; feature -1 is a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def find(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        at = np.zeros(len(x), np.int64)
        todo = np.flatnonzero(self.feature[at] >= 0)
        while len(todo):
            own = at[todo]
            right = ~(x[todo, self.feature[own]] <= self.threshold[own])
            at[todo] = self.left[own] + right
            todo = todo[self.feature[at[todo]] >= 0]
        return at

    def whole(self, low: np.ndarray, high: np.ndarray) -> int:
        """The leaf that all rows of a box fall in, or the first node that may part them."""
        node = 0
        while (f := self.feature[node]) >= 0:
            if high[f] <= self.threshold[node]:
                node = self.left[node]
            elif low[f] > self.threshold[node]:
                node = self.left[node] + 1
            else:
                break
        return int(node)

    def parts(self, x: np.ndarray, rows: np.ndarray, node: int = 0) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf below ``node``, its rows in their order) of some rows of x, best laid out by columns; for trees of few nodes."""
        todo = [(node, rows)]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.feature[node] < 0:
                yield node, rows
                continue
            goes = x[:, self.feature[node]].take(rows) <= self.threshold[node]
            todo += [(int(self.left[node]) + 1, rows.compress(~goes)), (int(self.left[node]), rows.compress(goes))]

    def pack(self) -> bytes:
        head = np.array([len(self.feature), self.value.shape[1]], np.int64)
        return b"".join(a.tobytes() for a in (head, self.threshold, self.value, self.left.astype(np.int32), self.feature.astype(np.int32)))

    @staticmethod
    def unpack(data: bytes) -> Tree:
        n, k = np.frombuffer(data, np.int64, 2).tolist()
        threshold = np.frombuffer(data, np.float64, n, 16)
        value = np.frombuffer(data, np.float64, n * k, 16 + 8 * n).reshape(n, k)
        left, feature = np.frombuffer(data, np.int32, 2 * n, 16 + 8 * n + 8 * n * k).reshape(2, n)
        return Tree(feature, threshold, left, value)


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int | None = None, min_split: int = 2) -> Tree:
    """The tree of rows with positive weights: all nodes of a level at a time, on one sorted order per feature.

    A node is a leaf where all outputs are equal, all features are equal, fewer than ``min_split`` rows are left, or ``depth`` is
    reached. Of equal splits the first feature's lowest one is taken.
    """
    cols, outs = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    return _levels(cols, outs, w, [_ascending(c) for c in cols], np.array([len(y)]), 0, depth, min_split)


def _levels(cols: np.ndarray, outs: np.ndarray, w: np.ndarray, order: list[np.ndarray], size: np.ndarray, level: int,
            depth: int | None, min_split: int) -> Tree:
    """The subtrees of several nodes, which come first; ``order`` holds the rows in no leaf yet, those of a node together.

    As soon as all nodes have at most NEAR_ROWS rows, they are grown in groups of about as many, in memory close to the core.
    """
    (k, n), total = outs.shape, len(size)
    pairs, left = np.zeros(((k + 2) // 2, n, 2)), np.empty(n, bool)  # weights and weighted residuals: two running sums at a time
    moments, pairs[0, :, 0] = pairs.view(complex)[..., 0], w
    features, thresholds, lefts, values = [], [], [], []

    while len(size):
        if len(order[0]) > 2 * NEAR_ROWS and size.max() <= NEAR_ROWS:
            lows = _grouped(cols, outs, w, order, size, level, depth, min_split)
            base = total
            for part in (0, 1):  # the nodes of this level, then those below
                for low, m in lows:
                    some = slice(0, m) if part == 0 else slice(m, None)
                    if part == 0:
                        offset = base - m
                        base += len(low.feature) - m
                        low.left[low.left >= 0] += offset
                    for out, of in zip((features, thresholds, lefts, values), (low.feature, low.threshold, low.left, low.value)):
                        out.append(of[some])
            break
        m, o = len(size), order[0]
        own, starts = np.repeat(np.arange(m), size), np.cumsum(size) - size
        wr = w.take(o)
        weight = np.add.reduceat(wr, starts)
        mean, spread, scale = np.empty((m, k)), np.zeros(m), np.zeros(m)
        for j in range(k):
            yr = outs[j].take(o)
            wy = wr * yr
            mean[:, j] = np.add.reduceat(wy, starts) / weight
            off = yr - np.repeat(mean[:, j], size)
            moved = wr * off
            spread += np.add.reduceat(moved * off, starts)
            scale += np.add.reduceat(wy * yr, starts)
            pairs[(j + 1) // 2, :, (j + 1) % 2][o] = moved
        values.append(mean)
        at = np.flatnonzero((spread > 1e-24 * scale) & (size >= max(2, min_split)) & (depth is None or level < depth))
        feature, threshold = np.full(m, -1, np.int64), np.zeros(m)
        if len(at):
            order, own, starts, size = _kept(order, own, size, at)
            best, on, cut = np.full(len(at), -1.0), np.full(len(at), -1, np.int64), np.zeros(len(at))
            whole, last, ok = np.repeat(weight[at], size), starts + size - 1, np.empty(len(own), bool)
            for f, o in enumerate(order):
                xs = cols[f].take(o)
                for i, pair in enumerate(moments):
                    sums = np.cumsum(pair.take(o))
                    sums -= np.repeat(np.append(0.0, sums[last[:-1]]), size)
                    if i == 0:
                        both, gain = whole - sums.real, np.square(sums.imag)
                        both *= sums.real
                    else:
                        gain += np.square(sums.real) + np.square(sums.imag)
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain /= both  # but for a factor of the node
                np.greater(xs[1:], xs[:-1], out=ok[:-1])
                ok[last] = False
                gain = np.where(ok, gain, -1.0)
                top = np.maximum.reduceat(gain, starts)
                better = top > best
                if better.any():
                    hit = np.flatnonzero(gain == np.repeat(np.where(better, top, np.inf), size))
                    met = own[hit]
                    new = np.append(True, met[1:] != met[:-1])
                    first, met = hit[new], met[new]
                    middle = xs[first] + (xs[first + 1] - xs[first]) / 2
                    best[met], on[met] = top[met], f
                    cut[met] = np.where(middle < xs[first + 1], middle, xs[first])
            feature[at], threshold[at] = on, cut
        split = np.flatnonzero(feature >= 0)
        child = np.full(m, -1, np.int64)
        child[split] = total + 2 * np.arange(len(split))
        features.append(feature)
        thresholds.append(threshold)
        lefts.append(child)
        total += 2 * len(split)
        level += 1
        if not len(split):
            break
        order, own, starts, size = _kept(order, own, size, np.flatnonzero(on >= 0))
        goes = cols.ravel().take(np.repeat(feature[split] * n, size) + order[0]) <= np.repeat(threshold[split], size)
        left[order[0]] = goes
        lower = np.add.reduceat(goes, starts, dtype=np.int64)
        # where the rows of each child go, in their order: the same places for every feature
        size = np.stack((lower, size - lower), axis=1).ravel()
        place = _places(size)
        for f, o in enumerate(order):
            goes = left.take(o)
            order[f] = new = np.empty_like(o)
            new[place[0]], new[place[1]] = o.compress(goes), o.compress(~goes)
    return Tree(np.concatenate(features), np.concatenate(thresholds), np.concatenate(lefts), np.concatenate(values))


def _grouped(cols, outs, w, order, size, level, depth, min_split) -> list[tuple[Tree, int]]:
    """(subtrees, number of nodes) of consecutive nodes with about NEAR_ROWS rows together."""
    ends = np.cumsum(size)
    group = (ends - 1) // NEAR_ROWS
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    place, out = np.empty(len(w), np.int64), []
    for a, z in zip(first.tolist(), [*first[1:].tolist(), len(size)]):
        some = slice(int(ends[a] - size[a]), int(ends[z - 1]))
        rows = np.sort(order[0][some])
        place[rows] = np.arange(len(rows))
        out.append((_levels(cols.take(rows, axis=1), outs.take(rows, axis=1), w.take(rows), [place.take(o[some]) for o in order],
                            size[a:z], level, depth, min_split), z - a))
    return out


def _kept(order: list[np.ndarray], own: np.ndarray, size: np.ndarray, nodes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The orders without the rows of all but some nodes, with the new number of each row's node, and the nodes' starts and sizes."""
    if len(nodes) < len(size):
        keep = np.zeros(len(size), bool)
        keep[nodes] = True
        rows = np.flatnonzero(keep.take(own))
        order, size = [o.take(rows) for o in order], size[nodes]
        own = np.repeat(np.arange(len(size)), size)
    return order, own, np.cumsum(size) - size, size


def _places(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all rows of left children, and of all rows of right ones, from the children's sizes in turn."""
    starts = np.cumsum(size) - size
    return tuple(np.arange(size[s::2].sum()) + np.repeat(starts[s::2] - (np.cumsum(size[s::2]) - size[s::2]), size[s::2]) for s in (0, 1))


def _draws() -> tuple[np.ndarray, np.ndarray]:
    """The Poisson weights' distribution, and the weight that the first 16 bits of a hash tell; UNSURE where they do not."""
    upto = np.cumsum(np.exp(-1) / np.concatenate(([1.0], np.cumprod(np.arange(1.0, 19.0)))))
    first = np.arange((1 << 16) + 1) / (1 << 16)
    low, high = np.searchsorted(upto, first[:-1], side="right"), np.searchsorted(upto, first[1:], side="right")
    return upto, np.where(low == high, low, UNSURE).astype(np.uint8)


UNSURE = 255
UPTO, DRAWN = _draws()


def weights(uid: np.ndarray, tree: int, seed: int, bootstrap: bool) -> np.ndarray:
    """Poisson weights with mean 1, inverted from a hash of row, tree and seed."""
    if not bootstrap:
        return np.ones(len(uid))
    h = uid.astype(np.uint64)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h += np.uint64((tree * 0x85EBCA6B + seed * 0xC2B2AE35 + 1) & 0xFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h ^= h >> np.uint64(31)
    w = DRAWN.take((h >> np.uint64(48)).view(np.int64))
    rest = np.flatnonzero(w == UNSURE)
    w[rest] = np.searchsorted(UPTO, (h.take(rest) >> np.uint64(11)) / float(1 << 53), side="right")
    return w.astype(np.float64)


def _ascending(c: np.ndarray) -> np.ndarray:
    """The stable order of numbers, by sorts of 16 bits at a time, which take linear time."""
    bits = (c + 0.0).view(np.int64)  # no negative zeros
    bits ^= (bits >> 63) & np.int64(np.iinfo(np.int64).max)
    bits ^= np.int64(np.iinfo(np.int64).min)
    order = None
    for part in bits.astype("<i8").view(np.uint16).reshape(-1, 4).T:
        if order is None:
            order = np.argsort(part, kind="stable")
        elif (part != part[0]).any():
            order = order.take(np.argsort(part.take(order), kind="stable"))
    return order


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            yield b.column(0).to_numpy(), _matrix(b.column(1)), _matrix(b.column(2))


def _blocks(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As `_batches`, in blocks of about BLOCK_BYTES: what a node costs per block is paid seldom."""
    held, size, most = [], 0, most or BLOCK_BYTES
    for uid, x, y in _batches(batches):
        a_row = 8 * (1 + x.shape[1] + y.shape[1])
        step = max(1, most // a_row)
        for at in range(0, len(uid), step):
            held.append((uid[at: at + step], x[at: at + step], y[at: at + step]))
            size += a_row * len(held[-1][0])
            if size + a_row > most:
                yield tuple(np.concatenate(c) for c in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _sorted_by(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their nodes, and where each node met starts: one pass, however many nodes there are."""
    short = len(node) and node.max() < 1 << 16
    order = np.argsort(node.astype(np.uint16) if short else node, kind="stable")
    own = node[order]
    return order, np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)


def _by_node(node: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(node, its rows in their order) for all nodes met."""
    order, starts = _sorted_by(node)
    for a, z in zip(starts.tolist(), [*starts[1:].tolist(), len(order)]):
        yield int(node[order[a]]), order[a:z]


class _Top:
    """The levels of all trees that were split by histograms, on the driver: at most some rows / task_rows nodes a tree."""

    def __init__(self, trees: int, mean: list[float]):
        self.nodes = [[[-1, 0.0, -1, mean]] for _ in range(trees)]
        self.open = {(t, 0): 0 for t in range(trees)}  # nodes still to be judged, and their depth

    def split(self, tree: int, node: int, feature: int, threshold: float, mean: list[float]) -> None:
        """Until they are known, the children have the value of their parent."""
        nodes = self.nodes[tree]
        nodes[node][:3] = feature, threshold, len(nodes)
        depth = self.open.pop((tree, node))
        for _ in range(2):
            self.open[(tree, len(nodes))] = depth + 1
            nodes.append([-1, 0.0, -1, mean])

    def close(self, tree: int, node: int, mean: list[float] | None = None) -> int:
        if mean:
            self.nodes[tree][node][3] = mean
        return self.open.pop((tree, node))

    def frozen(self) -> list[Tree]:
        return [Tree(*(np.array([n[i] for n in t]) for i in range(4))) for t in self.nodes]


class _Area:
    """A block of rows in the order of every feature, for all trees that have it in one node."""

    def __init__(self, uid: np.ndarray, x: np.ndarray, y: np.ndarray):
        n, width = x.shape
        self.order = np.stack([_ascending(x[:, f]) for f in range(width)])
        self.x = np.stack([x[:, f].take(o) for f, o in enumerate(self.order)])
        self.y = [y[:, j].take(self.order) for j in range(y.shape[1])]
        some = min(ENDS, n)
        at = np.concatenate((self.order[:, :some], self.order[:, :-some - 1:-1]))
        self.end, self.last = uid.take(at), np.concatenate((self.x[:, :some], -self.x[:, :-some - 1:-1]))

    def ends(self, tree: int, seed: int, bootstrap: bool) -> np.ndarray | None:
        """The features' lows and negative highs among the drawn rows, or None where the rows at the ends do not tell."""
        drawn = weights(self.end.ravel(), tree, seed, bootstrap).reshape(self.end.shape) > 0
        if not drawn.any(axis=1).all():
            return None
        return self.last[np.arange(len(drawn)), drawn.argmax(axis=1)].reshape(2, -1)

    def add(self, sums: np.ndarray, w: np.ndarray, limits: np.ndarray) -> None:
        """Weight and weighted outputs per feature and bin, added to ``sums``."""
        low, high = limits
        for f, (order, x) in enumerate(zip(self.order, self.x)):
            upto = np.searchsorted(x, low[f] + (high[f] - low[f]) * np.arange(1, BINS) / BINS)
            starts = np.append(0, upto)
            held = np.flatnonzero(np.append(upto, len(x)) > starts)
            ws = w.take(order)
            sums[f, held, 0] += np.add.reduceat(ws, starts[held])
            for j, ys in enumerate(self.y):
                sums[f, held, 1 + j] += np.add.reduceat(ws * ys[f], starts[held])


def _histograms(rows: DataFrame, top: list[Tree], wanted: dict[tuple[int, int], np.ndarray | None], seed: int, bootstrap: bool,
                width: int, outputs: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(tree, node, sums) over all rows. With None: the features' lows and negative highs; with ranges: weight, outputs
    per feature and bin, and the first of them all squares. Tasks add up, a shuffle by node adds the tasks."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(([tuple(t) for t in top], wanted))
    first = next(iter(wanted.values())) is None
    schema = "tree int, node int, sums binary"
    shape = to_arrow_schema(T.StructType.fromDDL(schema))
    form = (2, width) if first else (width, BINS, outputs + 2)
    merge = np.minimum if first else np.add

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, wanted = sent.value
        top = [Tree(*t) for t in top]
        nodes: dict[int, list[int]] = {}
        for t, own in sorted(wanted):
            nodes.setdefault(t, []).append(own)
        rank, limits, out, met = {}, {}, {}, {}
        for t, own in nodes.items():
            rank[t] = np.full(len(top[t].feature), -1)
            rank[t][own] = np.arange(len(own))
            limits[t] = None if first else np.stack([wanted[t, m] for m in own])
            out[t] = np.full((len(own), *form), np.inf if first else 0.0)
            met[t] = np.zeros(len(own), bool)
        for uid, x, y in _blocks(batches, AREA_BYTES):
            x, squares = np.asfortranarray(x), None if first else np.square(y).sum(axis=1)
            place, box, area = np.empty(len(uid), np.int64), (x.min(axis=0), x.max(axis=0)), None
            for t in nodes:
                at_node = top[t].whole(*box)
                if top[t].feature[at_node] < 0:  # the block as a whole
                    n = rank[t][at_node]
                    if n < 0:
                        continue
                    area = area or _Area(uid, x, y)
                    if first:
                        low = area.ends(t, seed, bootstrap)
                        if low is not None:
                            out[t][n] = np.minimum(out[t][n], low)
                            met[t][n] = True
                            continue
                    else:
                        w = weights(uid, t, seed, bootstrap)
                        met[t][n] |= bool(w.any())
                        area.add(out[t][n], w, limits[t][n])
                        out[t][n][0, 0, -1] += w @ squares
                        continue
                w, m = weights(uid, t, seed, bootstrap), len(nodes[t])
                at = []
                for leaf, own in top[t].parts(x, np.flatnonzero(w > 0), at_node):
                    n = rank[t][leaf]
                    if n < 0:
                        continue
                    met[t][n] = True
                    if first:
                        for f in range(width):
                            xs = x[:, f].take(own)
                            out[t][n, :, f] = np.minimum(out[t][n, :, f], (xs.min(), -xs.max()))
                    else:
                        place[own] = n
                        at.append(own)
                if not at:
                    continue
                at = np.sort(np.concatenate(at)) if len(at) > 1 else at[0]
                own, wa = place.take(at), w.take(at)
                parts = [wa, *(wa * y[:, j].take(at) for j in range(outputs))]
                for f in range(width):
                    low, span = limits[t][:, 0, f], limits[t][:, 1, f] - limits[t][:, 0, f]
                    bin_ = (x[:, f].take(at) - low.take(own)) / np.where(span > 0, span, np.inf).take(own) * BINS
                    bin_ = bin_.astype(np.int64).clip(0, BINS - 1) + own * BINS
                    for j, p in enumerate(parts):
                        out[t][:, f, :, j] += np.bincount(bin_, p, m * BINS).reshape(m, BINS)
                out[t][:, 0, 0, -1] += np.bincount(own, wa * squares.take(at), m)
        yield from _rows(((t, nodes[t][i], out[t][i].tobytes()) for t in nodes for i in np.flatnonzero(met[t]).tolist()), shape)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = None, None
        for b in batches:
            for t, n, data in zip(*(c.to_pylist() for c in b.columns)):
                found = np.frombuffer(data).reshape(form)
                if (t, n) == held:
                    sums = merge(sums, found)
                    continue
                if held:
                    yield from _rows([(*held, sums.tobytes())], shape)
                held, sums = (t, n), found
        if held:
            yield from _rows([(*held, sums.tobytes())], shape)

    dealt = rows.mapInArrow(counted, schema).repartition("tree", "node").sortWithinPartitions("tree", "node")
    for t, n, data in dealt.mapInArrow(added, schema).collect():  # the nodes wanted: HIST_BYTES at most
        yield t, n, np.frombuffer(bytes(data)).reshape(form)


def _rows(rows, shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = list(rows)
    for i in range(0, len(rows), 64):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i: i + 64]), shape)], schema=shape)


def _split_large(rows: DataFrame, n: int, width: int, mean: list[float], trees: int, depth: int | None, seed: int,
                 bootstrap: bool, task_rows: int) -> tuple[_Top, dict[tuple[int, int], int]]:
    """Levels by histograms until every open node fits a task: (top levels, depth of the nodes left to be grown)."""
    top, left, outputs = _Top(trees, mean), {}, len(mean)
    sizes = dict.fromkeys(top.open, float(n))
    while top.open:
        for key in [key for key in top.open if sizes[key] <= task_rows]:
            left[key] = top.close(*key)
        if not top.open:
            break
        frozen = top.frozen()
        a_time = max(1, HIST_BYTES // (width * BINS * (outputs + 2) * 8))
        todo = sorted(top.open)
        for some in (todo[i: i + a_time] for i in range(0, len(todo), a_time)):
            ranges = {(t, m): np.stack((s[0], -s[1])) for t, m, s in _histograms(rows, frozen, dict.fromkeys(some), seed, bootstrap, width, outputs)}
            for t, m, s in _histograms(rows, frozen, ranges, seed, bootstrap, width, outputs):
                low, high = ranges[t, m]
                whole = s[0].sum(axis=0)
                mean = whole[1:-1] / whole[0]
                if np.all(low == high) or whole[-1] - (whole[1:-1] * mean).sum() <= 1e-14 * whole[-1] or top.open[t, m] == depth:
                    top.close(t, m, mean.tolist())
                    continue
                upto = np.cumsum(s, axis=1)[:, :-1]
                wl, wr = upto[..., 0], whole[0] - upto[..., 0]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.square(upto[..., 1:-1] - wl[..., None] * mean).sum(axis=2) * (1 / wl + 1 / wr)
                gain[(wl <= 0) | (wr <= 0)] = -1
                f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                # the edge that the place of a value is rounded by
                edge = low[f] + (high[f] - low[f]) * (b + 1) / BINS
                sizes[t, len(top.nodes[t])], sizes[t, len(top.nodes[t]) + 1] = float(wl[f, b]), float(wr[f, b])
                top.split(t, m, int(f), float(np.nextafter(edge, -np.inf)), mean.tolist())
            for key in some:
                if key in top.open and key not in ranges:  # no row of it drew a weight
                    top.close(*key)
    return top, left


def mean_of_trees(x: np.ndarray, top: list[Tree], below: dict[tuple[int, int], bytes], opened: dict[tuple[int, int], Tree]) -> np.ndarray:
    """Mean of the trees' values for every row; ``opened`` keeps the subtrees that were met."""
    total = np.zeros((len(x), top[0].value.shape[1]))
    for t, upper in enumerate(top):
        for own, at in _by_node(upper.find(x)):
            if (t, own) in below:
                if (t, own) not in opened:
                    opened[t, own] = Tree.unpack(below[t, own])
                low = opened[t, own]
                total[at] += low.value[low.find(x[at])]
            else:
                total[at] += upper.value[own]
    return total / len(top)


class Forest:
    """A fitted forest: the top levels of its trees, and a stored table (tree, node, data) of the subtrees below them."""

    def __init__(self, features: list[str], top: list[Tree], subtrees: DataFrame, size: int, outputs: int):
        self.features, self.top, self.subtrees, self.size, self.outputs = features, top, subtrees, size, outputs
        self._sent: Broadcast | None = None

    @property
    def small(self) -> bool:
        return self.size <= SENT_BYTES

    def sent(self) -> Broadcast:
        """(top levels, subtrees) for `mean_of_trees` in tasks; for a ``small`` model."""
        if not self.small:
            raise ValueError(f"a model of {self.size} bytes is too large to be sent to every task")
        if self._sent is None:
            below = {(r.tree, r.node): bytes(r.data) for r in self.subtrees.collect()}
            self._sent = self.subtrees.sparkSession.sparkContext.broadcast((self.top, below))
        return self._sent

    def predict(self, df: DataFrame, into: str, vector: bool = False) -> DataFrame:
        """``df`` without its rows that miss a feature, with the mean of the trees as ``into``; ``vector``: all outputs as an array.

        A model of up to SENT_BYTES is sent to the tasks. With a larger one the rows are routed to the subtrees they fall in,
        busy subtrees to several tasks, and the trees' values are averaged per row.
        """
        ready = require(df, *self.features)
        if self.small:
            sent, opened = self.sent(), {}

            def mean(xs: Iterator[pd.Series]) -> Iterator[pd.Series]:
                for x in xs:
                    yield pd.Series(list(mean_of_trees(np.array(x.tolist(), float).reshape(len(x), -1), *sent.value, opened)))

            out = ready.withColumn(into, F.pandas_udf(mean, "array<double>")(F.array(*[F.col(f"`{f}`").cast("double") for f in self.features])))
        else:
            out = self._meet(ready, into)
        return out if vector else out.withColumn(into, F.col(into)[0])

    def _meet(self, ready: DataFrame, into: str) -> DataFrame:
        top = ready.sparkSession.sparkContext.broadcast(self.top)

        def route(xs: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in xs:
                x = np.array(x.tolist(), float).reshape(len(x), -1)
                yield pd.Series(list(np.stack([t.find(x) for t in top.value], axis=1).astype(np.int32)))

        rows = cut_lineage(ready.select(F.struct(*[F.col(f"`{c}`") for c in ready.columns]).alias("row"), F.monotonically_increasing_id().alias("uid"),
                                        F.array(*[F.col(f"`{f}`").cast("double") for f in self.features]).alias("x")), "rows")
        met = rows.select("uid", "x", F.posexplode(F.pandas_udf(route, "array<int>")("x")).alias("tree", "node"))
        met = cut_lineage(met, "routes")
        busy = met.groupBy("tree", "node").agg(F.ceil(F.count("*") / BUSY_ROWS).cast("int").alias("shares"))
        shares = self.subtrees.join(busy, ["tree", "node"]).select("tree", "node", "data", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
        dealt = met.join(busy, ["tree", "node"]).select("tree", "node", "uid", "x", F.pmod(F.xxhash64("uid"), "shares").cast("int").alias("share"))
        schema = "uid long, value array<double>"
        shape = to_arrow_schema(T.StructType.fromDDL(schema))

        def value(key: tuple[pa.Scalar, ...], own: pa.Table, model: pa.Table) -> pa.Table:
            if not own.num_rows:
                return shape.empty_table()
            x = _matrix(own["x"].combine_chunks())
            if model.num_rows:
                low = Tree.unpack(model["data"][0].as_py())
                found = low.value[low.find(x)]
            else:
                found = np.repeat(top.value[key[0].as_py()].value[key[1].as_py()][None, :], len(x), axis=0)
            return pa.Table.from_arrays([own["uid"].combine_chunks(), pa.array(list(found), shape.field(1).type)], schema=shape)

        keys = ["tree", "node", "share"]
        each = dealt.groupBy(*keys).cogroup(shares.groupBy(*keys)).applyInArrow(value, schema)
        mean = each.groupBy("uid").agg(F.array(*[F.avg(F.col("value")[j]) for j in range(self.outputs)]).alias("mean"))
        return rows.join(mean, "uid").select("row.*", F.col("mean").alias(into))


def fit_forest(df: DataFrame, features, outputs, trees: int = 100, depth: int | None = None, min_split: int = 2, seed: int = 42,
               bootstrap: bool = True, task_rows: int = 200_000) -> Forest:
    """A forest for one or several output columns, over the rows that have all features and outputs.

    Every feature is considered at each split. ``min_split`` is the least number of rows a node is split at, ``depth`` None
    grows to purity. The same rows in the same order give the same forest. No rows: an error.
    """
    features, outputs = list(features), [outputs] if isinstance(outputs, str) else list(outputs)
    ready = require(df, *features, *outputs)

    return fit_arrays(ready.select(_vector(features).alias("x"), _vector(outputs).alias("y")), features, trees, depth, min_split, seed, bootstrap, task_rows)


def _vector(names: list[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in names])


def fit_arrays(df: DataFrame, features: list[str], trees: int = 100, depth: int | None = None, min_split: int = 2, seed: int = 42,
               bootstrap: bool = True, task_rows: int = 200_000) -> Forest:
    """As `fit_forest`, from columns x and y that hold the features and the outputs of a row as arrays of equal lengths."""
    rows, top, left, homes = _prepared(df, trees, depth, min_split, seed, bootstrap, task_rows)
    if left is None:
        subtrees = cut_lineage(_from_points(rows, len(top.nodes[0][0][3]), trees, depth, seed, bootstrap), "subtrees")
        return _fitted(features, top.frozen(), subtrees, len(top.nodes[0][0][3]))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, pieces, _ in _at_home(batches):
            for (t, m), low in zip(homes[home], _grown(pieces, homes[home], left, depth, min_split, seed, bootstrap)):
                if low is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([m], pa.int32()), pa.array([low.pack()], pa.binary())], schema=MODEL)

    pieces = _dealt(rows, top, left, homes, seed, bootstrap)
    subtrees = pieces.repartitionById(len(homes), F.col("home")).sortWithinPartitions("home", "kind", "first").mapInArrow(made, from_arrow_schema(MODEL))
    return _fitted(features, top.frozen(), cut_lineage(subtrees, "subtrees"), len(top.nodes[0][0][3]))


def _prepared(df: DataFrame, trees: int, depth: int | None, min_split: int, seed: int, bootstrap: bool,
              task_rows: int) -> tuple[DataFrame, _Top, dict[tuple[int, int], int] | None, list[list[tuple[int, int]]]]:
    """(training rows, top levels, depth of the nodes left to be grown, leaves of the top levels by the task they are grown in);
    instead of depths None where sums per point tell whole trees."""
    rows = df.select(F.monotonically_increasing_id().alias("uid"), "x", "y")
    # a pass costs far more than reading its rows: they are dealt evenly, however the input lies in files
    rows = cut_lineage(rows.repartition(_even(rows), "uid").sortWithinPartitions("uid"), "training")
    width, outputs = rows.agg(F.max(F.size("x")), F.max(F.size("y"))).first()
    if not outputs:
        raise ValueError("no row has all features and outputs: nothing to learn from")
    n, about, *mean = rows.agg(F.count("*"), F.approx_count_distinct(F.xxhash64("x"), 0.02), *[F.avg(F.col("y")[j]) for j in range(outputs)]).first()
    # with min_split 2 a node may be split wherever it holds two points; few sums, for a task holds those of all trees
    if about <= FEW_POINTS < n and min_split <= 2 and about * (outputs + 1) * trees * 8 <= HIST_BYTES:
        return rows, _Top(trees, mean), None, []
    rows, sample = _laid_out(rows, n, width, outputs) if n > task_rows else (rows, None)
    top, left = _split_large(rows, n, width, mean, trees, depth, seed, bootstrap, task_rows)
    return rows, top, left, _homes(top.frozen(), sample, rows.sparkSession.sparkContext.defaultParallelism)


def _homes(top: list[Tree], sample: tuple[np.ndarray, np.ndarray] | None, tasks: int) -> list[list[tuple[int, int]]]:
    """All leaves of the top levels, (tree, node), in bonds of up to BOND, few enough for all tasks.

    Those of a bond lie in about one place, told by the mean cell of a sample, so they share most of their rows.
    """
    leaves = [np.flatnonzero(t.feature < 0).tolist() for t in top]
    bond, out = min(BOND, max(1, sum(map(len, leaves)) // (4 * tasks))), []
    for first in range(0, len(top), bond):
        found = []
        for t in range(first, min(first + bond, len(top))):
            cell = np.zeros(len(top[t].feature))
            if sample:
                own = top[t].find(sample[0])
                cell = np.bincount(own, sample[1], len(cell)) / np.maximum(np.bincount(own, minlength=len(cell)), 1)
            found += sorted((float(cell[m]), t, m) for m in leaves[t])
        found = [(t, m) for _, t, m in sorted(found)]
        out += [found[i: i + bond] for i in range(0, len(found), bond)]
    return out


def _even(df: DataFrame) -> int:
    return 2 * df.sparkSession.sparkContext.defaultParallelism


def _laid_out(rows: DataFrame, n: int, width: int, outputs: int) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray] | None]:
    """The training rows, dealt evenly, with those of one place side by side: by the cells of a tree grown on a bounded sample.

    With them the sample's features and cells. The cells steer the work, not the result.
    """
    cells = min(GUIDE_CELLS, n // CELL_ROWS, max(2, HIST_BYTES // (8 * SAMPLE_PER_CELL * (width + outputs))))
    if cells < 2:
        return rows, None
    sample = rows.sample(fraction=min(1.0, SAMPLE_PER_CELL * cells / n), seed=9).select("x", "y").toArrow()
    if not sample.num_rows:
        return rows, None
    x, y = (_matrix(sample[c].combine_chunks()) for c in ("x", "y"))
    guide = grow(x, y, np.ones(len(x)), min_split=2 * SAMPLE_PER_CELL)
    place, todo = np.zeros(len(guide.feature), np.int32), [0]  # cells from left to right
    while todo:
        node = todo.pop()
        if guide.feature[node] < 0:
            place[node] = place.max() + 1
        else:
            todo += [int(guide.left[node]) + 1, int(guide.left[node])]
    sent = rows.sparkSession.sparkContext.broadcast((tuple(guide), place))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guide, place = sent.value
        guide = Tree(*guide)
        for b in batches:
            if b.num_rows:
                cell = pa.array(place[guide.find(_matrix(b.column(1)))], pa.int32())
                yield pa.RecordBatch.from_arrays([*b.columns, cell], schema=b.schema.append(pa.field("cell", pa.int32())))

    dealt = rows.mapInArrow(placed, "uid long, x array<double>, y array<double>, cell int")
    laid = dealt.repartitionByRange(_even(rows), "cell", "uid").sortWithinPartitions("cell", "uid").drop("cell")
    return cut_lineage(laid, "training"), (x, place[guide.find(x)])


# rows of a home: drawn ones, or (kind 1) asked ones; held: a bit for each node of the home that has the row
PIECES = pa.schema([("home", pa.int32()), ("kind", pa.int32()), ("first", pa.int64()), *((c, pa.binary()) for c in ("uid", "x", "y", "held"))])


def _pieces(kind: int, held: dict[int, np.ndarray], uid: np.ndarray, x: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
    each = ((h, bits, np.flatnonzero(bits)) for h, bits in held.items())
    return _rows(((h, kind, int(uid[0]), uid[at].tobytes(), x[at].tobytes(), y[at].tobytes(), bits[at].tobytes()) for h, bits, at in each), PIECES)


def _bits(homes: list[list[tuple[int, int]]], of=None) -> dict[tuple[int, int], tuple[int, np.uint16]]:
    return {node: (h, np.uint16(1 << i)) for h, own in enumerate(homes) for i, node in enumerate(own) if of is None or node in of}


def _dealt(rows: DataFrame, top: _Top, left: dict[tuple[int, int], int], homes: list[list[tuple[int, int]]], seed: int, bootstrap: bool) -> DataFrame:
    """The drawn rows of all nodes left to be grown: a row travels once to a home, however many of its nodes drew it."""
    sent = rows.sparkSession.sparkContext.broadcast(([tuple(t) for t in top.frozen()], _bits(homes, left)))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, bits = sent.value
        upper = [Tree(*t) for t in upper]
        for uid, x, y in _blocks(batches, AREA_BYTES):
            by_column, box, held = np.asfortranarray(x), (x.min(axis=0), x.max(axis=0)), {}
            for t, tree in enumerate(upper):
                w = weights(uid, t, seed, bootstrap)
                for own, at in tree.parts(by_column, np.flatnonzero(w > 0), tree.whole(*box)):
                    if (t, own) in bits:
                        h, bit = bits[t, own]
                        held.setdefault(h, np.zeros(len(uid), np.uint16))[at] |= bit
            yield from _pieces(0, held, uid, x, y)

    return rows.mapInArrow(dealt, from_arrow_schema(PIECES))


def _at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, Iterator]]:
    """(home, pieces of drawn rows, those of asked rows) of sorted pieces; the last are read as they come."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
    for home, own in groupby(rows, key=lambda row: row[0]):
        first, rest = [], iter(())
        for row in own:
            if row[1]:
                rest = chain([row], own)
                break
            first.append(row[2:])
        yield home, first, rest


def _grown(pieces: list, nodes: list[tuple[int, int]], left: dict[tuple[int, int], int], depth: int | None, min_split: int, seed: int,
           bootstrap: bool) -> Iterator[Tree | None]:
    """The subtrees of a home's nodes, None for one without rows: the same in whatever order the pieces came."""
    pieces.sort(key=lambda p: p[0])
    uid, x, y, held = (np.frombuffer(b"".join(p[i] for p in pieces), d) for i, d in ((1, np.int64), (2, float), (3, float), (4, np.uint16)))
    n = len(uid)
    cols, outs = (np.ascontiguousarray(a.reshape(n, -1).T) if n else None for a in (x, y))
    orders = [_ascending(c) for c in cols] if n else []  # for all of the nodes
    for i, (t, m) in enumerate(nodes):
        member = held & np.uint16(1 << i) > 0
        rows = np.flatnonzero(member)
        if not len(rows):
            yield None
            continue
        place = np.cumsum(member) - 1
        order = [place.take(o.compress(member.take(o))) for o in orders]
        low = _levels(cols.take(rows, axis=1), outs.take(rows, axis=1), weights(uid.take(rows), t, seed, bootstrap), order, np.array([len(rows)]), 0,
                      None if depth is None else depth - left[t, m], min_split)
        yield Tree.unpack(low.pack())  # takes less room


def fit_predict(df: DataFrame, features, outputs, asked: DataFrame, into: str, trees: int = 100, depth: int | None = None, min_split: int = 2,
                seed: int = 42, bootstrap: bool = True, task_rows: int = 200_000) -> DataFrame:
    """As `fit_forest` and then `Forest.predict`, for a forest that nothing else needs: subtrees predict where they are grown.

    The rows asked about meet the drawn rows of their nodes, so the model, which may take more room than its rows, is not stored.
    """
    features, outputs = list(features), [outputs] if isinstance(outputs, str) else list(outputs)
    ready, k = require(df, *features, *outputs), len(outputs)
    rows, top, left, homes = _prepared(ready.select(_vector(features).alias("x"), _vector(outputs).alias("y")), trees, depth, min_split, seed, bootstrap, task_rows)
    if left is None:
        subtrees = cut_lineage(_from_points(rows, k, trees, depth, seed, bootstrap), "subtrees")
        return _fitted(features, top.frozen(), subtrees, k).predict(asked, into)
    asked = require(asked, *features)
    kept = asked.select(F.struct(*[F.col(f"`{c}`") for c in asked.columns]).alias("row"), F.monotonically_increasing_id().alias("uid"), _vector(features).alias("x"))
    kept = cut_lineage(kept.repartition(_even(kept), "uid"), "rows")
    sent = kept.sparkSession.sparkContext.broadcast(([tuple(t) for t in top.frozen()], left, homes))
    schema = "uid long, value array<double>"
    shape = to_arrow_schema(T.StructType.fromDDL(schema))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, bits = [Tree(*t) for t in sent.value[0]], _bits(sent.value[2])
        for uid, x, _ in _blocks(pa.RecordBatch.from_arrays([*b.columns, b.column(1)], ["uid", "x", "y"]) for b in batches):
            by_column, every, held = np.asfortranarray(x), np.arange(len(uid)), {}
            for t, tree in enumerate(upper):
                for own, at in tree.parts(by_column, every):
                    h, bit = bits[t, own]
                    held.setdefault(h, np.zeros(len(uid), np.uint16))[at] |= bit
            yield from _pieces(1, held, uid, x, x[:, :0])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, left, homes = sent.value
        for home, pieces, rest in _at_home(batches):
            lows = None
            for _, _, _, uid, x, _, held in rest:
                lows = lows or list(_grown(pieces, homes[home], left, depth, min_split, seed, bootstrap))
                uid, held = np.frombuffer(uid, np.int64), np.frombuffer(held, np.uint16)
                x, total = np.frombuffer(x).reshape(len(uid), -1), np.zeros((len(uid), k))
                for i, ((t, m), low) in enumerate(zip(homes[home], lows)):
                    at = np.flatnonzero(held & np.uint16(1 << i))
                    total[at] += upper[t][3][m] if low is None else low.value[low.find(x[at])]
                value = pa.ListArray.from_arrays(np.arange(0, total.size + 1, k, np.int32), total.ravel())
                yield pa.RecordBatch.from_arrays([pa.array(uid), value.cast(shape.field(1).type)], schema=shape)

    pieces = _dealt(rows, top, left, homes, seed, bootstrap).unionByName(kept.select("uid", "x").mapInArrow(routed, from_arrow_schema(PIECES)))
    pieces = pieces.repartitionById(len(homes), F.col("home")).sortWithinPartitions("home", "kind", "first")
    mean = pieces.mapInArrow(told, schema).groupBy("uid").agg(F.array(*[F.sum(F.col("value")[j]) / trees for j in range(k)]).alias("mean"))
    return kept.join(mean, "uid").select("row.*", F.col("mean")[0].alias(into))


def _fitted(features: list[str], top: list[Tree], subtrees: DataFrame, outputs: int) -> Forest:
    size = subtrees.agg(F.sum(F.octet_length("data").cast("long"))).first()[0] or 0
    return Forest(features, top, subtrees, size, outputs)


def _from_points(rows: DataFrame, outputs: int, trees: int, depth: int | None, seed: int, bootstrap: bool) -> DataFrame:
    """The table (tree, node, data) of whole trees, from weights and weighted outputs added up per tree and distinct point."""
    spark = rows.sparkSession
    x = np.array(sorted(list(r.x) for r in rows.select("x").distinct().collect()), float)  # FEW_POINTS or some more
    points = small_frame(spark, [(x.tolist(), i) for i, x in enumerate(x)], "x array<double>, point int")
    sent = spark.sparkContext.broadcast(x)
    schema = "tree int, first long, sums binary"
    shape = to_arrow_schema(T.StructType.fromDDL(schema))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, first = len(sent.value), None
        sums = np.zeros((trees, 1 + outputs, m))
        for b in batches:
            if not b.num_rows:
                continue
            uid, at, y = b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(b.column(2))
            first = int(uid[0]) if first is None else first
            for t in range(trees):
                w = weights(uid, t, seed, bootstrap)
                sums[t, 0] += np.bincount(at, w, m)
                for j in range(outputs):
                    sums[t, 1 + j] += np.bincount(at, w * y[:, j], m)
        if first is not None:
            yield from _rows(((t, first, sums[t].tobytes()) for t in range(trees)), shape)

    def grown(key: tuple[pa.Scalar, ...], own: pa.Table) -> pa.Table:
        each = sorted(zip(own["first"].to_pylist(), own["sums"].to_pylist()))  # the same tree however the sums came
        sums = sum(np.frombuffer(s).reshape(1 + outputs, -1) for _, s in each)
        drawn = np.flatnonzero(sums[0] > 0)
        low = grow(sent.value[drawn], (sums[1:, drawn] / sums[0, drawn]).T, sums[0, drawn], depth)
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([0], pa.int32()), pa.array([low.pack()], pa.binary())], schema=MODEL)

    met = rows.join(F.broadcast(points), "x").select("uid", "point", "y")
    return met.mapInArrow(added, schema).groupBy("tree").applyInArrow(grown, from_arrow_schema(MODEL))
