"""Language identification with unigram pieces, summed over every segmentation of a word.

Each language has its own probabilities for the pieces of one fixed public vocabulary. A word's probability is the
sum over all ways of cutting it into pieces (forward algorithm); a text's is the product over its words. The piece
probabilities come from expectation-maximisation over the same sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.common import by_length, grown, sliced, text_batches, uniform, unused
from tablewright.session import measured

WORD = regex.compile(r"\p{L}+")
START = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
CACHE_WORDS = 100_000


def vocabulary(path: str) -> list[str]:
    """All lower-cased letter pieces (with the word-start mark) of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if WORD.fullmatch(p.removeprefix(START) or "a"))


def _hashes(points: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k, hash of the k characters from each start) for k = 1..longest."""
    h = np.zeros(points.shape, np.uint64)
    for k in range(1, min(longest, points.shape[1]) + 1):
        h = h[:, : points.shape[1] - k + 1] * _BASE + points[:, k - 1:] + np.uint64(1)
        yield k, h


@dataclass
class LanguageModel:
    """langs: names; keys: sorted piece hashes; prob: piece x language, the last row for characters outside the vocabulary."""

    langs: list[str]
    keys: np.ndarray
    prob: np.ndarray
    longest: int

    def lattice(self, points: np.ndarray) -> dict[int, np.ndarray]:
        """Row of ``prob`` (or -1) for every piece length and start."""
        out = {}
        for k, h in _hashes(points, self.longest):
            at = np.searchsorted(self.keys, h)
            at[at == len(self.keys)] = 0
            hit = self.keys[at] == h
            out[k] = np.where(hit, at, len(self.keys) if k == 1 else -1)
        return out

    def forward(self, points: np.ndarray, prob: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, dict]:
        """Scaled forward sums per position, the log of their scale per word, and the lattice."""
        n, m = points.shape
        cells = self.lattice(points)
        padded = np.vstack([prob, np.zeros((1, prob.shape[1]))])
        sums, scale = [np.ones((n, prob.shape[1]))], np.zeros((n, m + 1))
        for j in range(1, m + 1):
            now = np.zeros((n, prob.shape[1]))
            for k in range(1, min(self.longest, j) + 1):
                now += sums[j - k] * padded[cells[k][:, j - k]] * np.exp(scale[:, j - k] - scale[:, j - 1])[:, None]
            top = now.max(axis=1)
            sums.append(now / top[:, None])
            scale[:, j] = scale[:, j - 1] + np.log(top)
        return sums, scale, cells

    def score(self, words: list[str]) -> np.ndarray:
        """Log probability of each word under each language."""
        out = np.empty((len(words), len(self.langs)))
        for own, points in by_length([START + w for w in words]):
            sums, scale, _ = self.forward(points, self.prob)
            out[own] = np.log(np.maximum(sums[-1], 1e-300)) + scale[:, -1:]
        return out


def _keys(pieces: list[str], longest: int) -> np.ndarray:
    """The pieces' hashes, sorted."""
    key = np.zeros(len(pieces), np.uint64)
    for own, points in by_length(pieces):
        for k, h in _hashes(points, longest):
            if k == points.shape[1]:
                key[own] = h[:, 0]
    return np.unique(key)


def fit(counts: pd.DataFrame, pieces: list[str], longest: int, rounds: int = 5, smooth: float = 0.1) -> LanguageModel:
    """Expectation-maximisation of each language's piece probabilities from its word counts (lang, word, n)."""
    langs = sorted(counts["lang"].unique())
    model = LanguageModel(langs, _keys(pieces, longest), np.empty(0), longest)
    size = len(model.keys) + 1
    model.prob = np.full((size, len(langs)), 1.0 / size)
    for c, lang in enumerate(langs):
        part = counts[counts["lang"] == lang]
        weights = part["n"].to_numpy(float)
        groups = by_length([START + w for w in part["word"]])
        for _ in range(rounds):
            prob = model.prob[:, c: c + 1]
            padded = np.append(prob[:, 0], 0.0)
            seen = np.zeros(size + 1)
            for own, points in groups:
                m = points.shape[1]
                sums, scale, cells = model.forward(points, prob)
                back = [np.zeros(len(own))] * m + [np.ones(len(own))]  # scaled by the total minus the scale at its place
                for i in range(m - 1, -1, -1):
                    now = np.zeros(len(own))
                    for k in range(1, min(longest, m - i) + 1):
                        # share of the total that goes through this piece from i to i + k
                        step = padded[cells[k][:, i]] * back[i + k] * np.exp(scale[:, i] - scale[:, i + k])
                        now += step
                        seen += np.bincount(cells[k][:, i] % (size + 1), weights[own] * sums[i][:, 0] * step, size + 1)
                    back[i] = now
            model.prob[:, c] = (seen[:size] + smooth) / (seen[:size].sum() + smooth * size)
    return model


def train(docs: DataFrame, vocab_path: str, rows_per_lang: int = 200,
          text: str = "text", lang: str = "lang", doc_id: str = "doc_id", seed: int = 11) -> LanguageModel | None:
    """Fit on about ``rows_per_lang`` whole texts of every language.

    A hash of the id picks the rows, so what one language learns from does not grow with the input. Each language is
    fitted by a task of its own; the driver gets its piece probabilities (eight bytes a piece and language). Rows without
    text or language are left out; None if no word is left.
    """
    known = text_batches(docs).where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).alias("i"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    total = known.groupBy("lang").agg(F.count("*").alias("n"))
    picked = known.join(measured(total), "lang").where(uniform(F.col("i"), seed=seed) < F.lit(float(rows_per_lang)) / F.col("n"))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(g, w) for g, t in zip(b["lang"], b["text"]) for w in WORD.findall(t.lower())], columns=["lang", "word"])

    pieces = vocabulary(vocab_path)
    longest = max(map(len, pieces))
    sent = docs.sparkSession.sparkContext.broadcast(pieces)

    def learnt(own: pd.DataFrame) -> pd.DataFrame:
        model = fit(own.sort_values("word", ignore_index=True), sent.value, longest)
        return pd.DataFrame({"lang": model.langs, "prob": [model.prob[:, 0].tobytes()]})

    counts = picked.select("lang", "text").mapInPandas(words, "lang string, word string").groupBy("lang", "word").agg(F.count("*").alias("n"))
    rows = sorted(counts.groupBy("lang").applyInPandas(learnt, "lang string, prob binary").collect(), key=lambda r: r["lang"])
    if not rows:
        return None
    return LanguageModel([r["lang"] for r in rows], _keys(pieces, longest), np.column_stack([np.frombuffer(r["prob"]) for r in rows]), longest)


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text", carry: tuple = ("doc_id",), prefix: str = "") -> DataFrame:
    """Columns ``carry`` plus lang_pred and score (their names after ``prefix``), one row per row of ``docs``.

    lang_pred is the language of highest posterior under equal priors (ties: first name), score that posterior. A null
    text, a text without a letter and an untrained model give ``und`` with score 0. Whole texts are scored; a task
    holds one Arrow batch and a bounded cache of word scores. Other columns of ``docs`` are not returned.
    """
    # plain arrays of the size of vocabulary x languages
    sent = docs.sparkSession.sparkContext.broadcast(model and (model.langs, model.keys, model.prob, model.longest))

    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = sent.value and LanguageModel(*sent.value)
        at: dict[str, int] = {}
        table = np.empty((0, len(m.langs) if m else 0))
        for batch in batches:
            pred, score = [], []
            for texts in sliced(batch):
                words = [WORD.findall(t.lower()) if m and t else [] for t in texts]
                if len(at) > CACHE_WORDS:
                    at, table = {}, table[:0]
                new = list({w for ws in words for w in ws if w not in at})
                if new:
                    at.update(zip(new, range(len(at), len(at) + len(new))))
                    table = grown(table, m.score(new), len(at))
                for ws in words:
                    if ws:
                        total = table[np.fromiter(map(at.__getitem__, ws), np.int64, len(ws))].sum(axis=0)
                        best = int(total.argmax())
                        pred.append(m.langs[best])
                        score.append(1.0 / np.exp(total - total[best]).sum())
                    else:
                        pred.append("und")
                        score.append(0.0)
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    udf = F.pandas_udf(scored, "lang_pred string, score double")
    names = docs.select(*carry).columns
    own = unused(names, "_p")
    out = text_batches(docs).select(*carry, udf(F.col(text)).alias(own))
    return out.select(*[F.col(f"`{n}`") for n in names], F.col(f"{own}.lang_pred").alias(f"{prefix}lang_pred"), F.col(f"{own}.score").alias(f"{prefix}score"))
