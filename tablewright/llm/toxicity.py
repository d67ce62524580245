"""Toxicity from averaged subword vectors.

A word is the bag of its hashed character 3- to 6-grams; a window's vector is the mean over the subwords of its
words; a linear softmax scores it. A text scores as its highest window, so a short insult in a long text counts. The
subword vectors and the softmax are trained together, and unseen spellings share the n-grams of known ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.common import by_length, grown, mix64, sliced, text_batches, uniform

WORD = regex.compile(r"[\p{L}\p{N}]+")
GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 15
WINDOW, STRIDE = 4, 2
CACHE_WORDS = 100_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of every word, in word order, and the number of them per word."""
    owners, buckets = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for own, points in by_length([f"<{w}>" for w in words]):
        for k in GRAMS:
            if points.shape[1] >= k:
                h = np.full((len(own), points.shape[1] - k + 1), np.uint64(k))
                for i in range(k):
                    h = mix64(h * np.uint64(0x100000001B3) + points[:, i: points.shape[1] - k + 1 + i])
                owners.append(np.repeat(own, h.shape[1]))
                buckets.append((h % np.uint64(BUCKETS)).astype(np.int64).ravel())
    owner, bucket = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owner, kind="stable")
    return bucket[order], np.bincount(owner, minlength=len(words))


def windows(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of overlapping windows that cover ``n`` words; one empty window for an empty text."""
    start = np.arange(0, max(n - STRIDE, 1), STRIDE)
    return start, np.minimum(start + WINDOW, n)


def _ranges(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[end] - total[start]


@dataclass
class ToxicityModel:
    """logit: what each subword bucket adds before averaging (its vector times the softmax difference); bias."""

    logit: np.ndarray
    bias: float


class _Batch:
    """Texts as word sequences over their own distinct words, with their windows."""

    def __init__(self, texts: list[str], labels: np.ndarray, weight: np.ndarray):
        listed = [words_of(t) for t in texts]
        index: dict[str, int] = {}
        self.seq = np.array([index.setdefault(w, len(index)) for ws in listed for w in ws], np.int64)
        self.bucket, self.per_word = subwords(list(index))
        self.first = np.concatenate(([0], np.cumsum(self.per_word)))
        spans = [windows(len(ws)) for ws in listed]
        base = np.concatenate(([0], np.cumsum([len(ws) for ws in listed])))
        self.start = np.concatenate([s + b for (s, _), b in zip(spans, base)])
        self.end = np.concatenate([e + b for (_, e), b in zip(spans, base)])
        many = np.array([len(s) for s, _ in spans])
        self.at = np.cumsum(many) - many
        self.doc = np.repeat(np.arange(len(listed)), many)
        self.grams = np.maximum(_ranges(self.per_word[self.seq].astype(float), self.start, self.end), 1.0)
        self.labels, self.weight = labels, weight

    def pull(self, logit: np.ndarray, bias: float, whole: bool) -> tuple[np.ndarray, float]:
        """Gradient of the log loss by subword bucket and for the bias: of the mean over a text's windows, or of its highest."""
        word = _ranges(logit[self.bucket], self.first[:-1], self.first[1:])
        z = _ranges(word[self.seq], self.start, self.end) / self.grams + bias
        many = np.bincount(self.doc)
        if whole:
            top, highest = np.arange(len(z)), np.add.reduceat(z, self.at) / many
        else:
            hit = np.flatnonzero(z >= np.maximum.reduceat(z, self.at)[self.doc])
            top = hit[np.unique(self.doc[hit], return_index=True)[1]]
            highest, many = z[top], np.ones(len(many))
        slope = (1 / (1 + np.exp(-np.clip(highest, -30, 30))) - self.labels) * self.weight
        share = (slope / many)[self.doc[top]] / self.grams[top]
        edge = np.bincount(self.start[top], share, len(self.seq) + 1) - np.bincount(self.end[top], share, len(self.seq) + 1)
        per_use = np.bincount(self.seq, np.cumsum(edge)[:-1], len(self.per_word))
        return np.bincount(self.bucket, np.repeat(per_use, self.per_word), BUCKETS), float(slope.sum())


def fit(texts: list[str], labels: np.ndarray, dim: int = 8, steps: int = 400, batch: int = 250, rate: float = 0.02,
        decay: float = 1e-5, lead: float = 0.25, seed: int = 5) -> ToxicityModel:
    """Subword vectors and softmax rows by Adam, together, on the class-balanced log loss: for the first ``lead`` of the steps of
    each text's mean window, then of its highest.

    With two classes every gradient with respect to the subword vectors is the outer product of the bucket weights of
    the windows concerned and the difference of the softmax rows, so a step costs one pass over a batch's subwords.
    """
    weight = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1)) * len(labels)
    rng = np.random.default_rng(seed)
    dealt = rng.permutation(len(texts))
    batches = [_Batch([texts[i] for i in own], labels[own], weight[own] / len(own))
               for own in np.array_split(dealt, max(1, len(texts) // batch))]
    params = [rng.normal(0, 0.1, (BUCKETS, dim)), rng.normal(0, 0.5, (2, dim)), np.zeros(2)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        vectors, rows, bias = params
        diff = rows[1] - rows[0]
        pull, slope = batches[step % len(batches)].pull(vectors @ diff, bias[1] - bias[0], step <= steps * lead)
        g_row = pull @ vectors
        now = rate * (1 - 0.9 * step / steps)
        for p, g, (m, v) in zip(params, [np.outer(pull, diff) + decay * vectors, np.stack([-g_row, g_row]), np.array([-slope, slope])], moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    vectors, rows, bias = params
    return ToxicityModel(vectors @ (rows[1] - rows[0]), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, learn: Column, max_rows: int = 4000, text: str = "text",
          label: str = "toxic", doc_id: str = "doc_id", seed: int = 7, max_chars: int = 200_000) -> ToxicityModel | None:
    """Fit on at most ``max_rows`` whole labelled texts, about a third of them toxic where there are enough.

    ``max_rows`` texts of up to ``max_chars`` characters bound what reaches the driver; longer ones are not learnt from, but
    scored like all others. A hash of the id picks the rows. Rows without text, or whose label is neither 0 nor 1, are
    left out. None if a class is missing.
    """
    marks = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("i")).agg(F.max(label).alias("y"))
    known = docs.where(learn & (F.length(text) <= max_chars)).select(F.col(doc_id).alias("i"), F.col(text).alias("t"))
    marked = known.select("i").join(marks, "i").withColumn("u", uniform(F.col("i"), seed=seed))
    n = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    want = {1: max_rows // 3, 0: max_rows - max_rows // 3}
    share = F.when(F.col("y") == 1, want[1] / n[1]).otherwise(want[0] / n[0])
    picked = marked.where(F.col("u") < share).orderBy("u", "i").limit(max_rows).select("i", "y")
    rows = known.join(picked, "i").orderBy("i", "t").toPandas()
    if not len(rows):
        return None
    return fit(rows["t"].tolist(), rows["y"].to_numpy(float))


def score(docs: DataFrame, model: ToxicityModel | None, text: str = "text", carry: tuple[Column | str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` plus score in [0, 1], one row per row of ``docs``; other columns are not returned.

    Null and empty texts, and texts without a letter or digit, have the score of an empty window; an untrained model
    scores 0. A task holds one Arrow batch and a bounded cache of word sums.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model and (model.logit, model.bias))  # BUCKETS numbers

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value and ToxicityModel(*sent.value)
        at: dict[str, int] = {}
        table = np.empty((0, 2))
        for batch in batches:
            out = []
            for texts in sliced(batch):
                listed = [words_of(t) if m else [] for t in texts]
                if len(at) > CACHE_WORDS:
                    at, table = {}, table[:0]
                new = list({w for ws in listed for w in ws if w not in at})
                if new:
                    bucket, per_word = subwords(new)
                    first = np.concatenate(([0], np.cumsum(per_word)))
                    at.update(zip(new, range(len(at), len(at) + len(new))))
                    table = grown(table, np.stack([_ranges(m.logit[bucket], first[:-1], first[1:]), per_word], axis=1), len(at))
                for ws in listed:
                    seq = np.fromiter(map(at.__getitem__, ws), np.int64, len(ws))
                    start, end = windows(len(ws))
                    out.append((_ranges(table[seq, 0], start, end) / np.maximum(_ranges(table[seq, 1], start, end), 1.0)).max())
            z = np.clip(np.array(out) + m.bias, -30, 30) if m else np.full(len(out), -np.inf)
            yield pd.Series(1 / (1 + np.exp(-z)))

    return text_batches(docs).select(*carry, F.pandas_udf(scored, "double")(F.col(text)).alias("score"))
