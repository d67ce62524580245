import base64
import hashlib
import time

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from helpers import TEXTS, edge_docs, none_of
from pyspark.sql import functions as F

from tablewright.llm import bpe, langid, queries, toxicity
from tablewright.session import small_frame

RANKS, PIECES = P.path("byte_bpe_50k.tiktoken"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def medium():
    return "/root/testdata/sf0.01"


def test_language_held_out(spark, medium):
    out = queries.op10(spark, medium).join(spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = out.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).collect()
    assert len(right) == 2 and all(v >= 0.98 for _, v in right)


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba"]
    import pandas as pd
    model = langid.fit(pd.DataFrame({"lang": ["x", "x", "y"], "word": ["aba", "ab", "ba"], "n": [3, 2, 5]}), pieces, 3)
    assert np.allclose(model.prob.sum(axis=0), 1)
    key = {}
    for own, points in langid.by_length(pieces):
        for k, h in langid._hashes(points, 3):
            if k == points.shape[1]:
                key |= {pieces[i]: v for i, v in zip(own, h[:, 0])}
    at = {w: int(np.searchsorted(model.keys, v)) for w, v in key.items()}

    def total(word, c):
        if not word:
            return 1.0
        return sum((model.prob[at[word[:k]], c] if word[:k] in at else model.prob[-1, c] if k == 1 else 0.0) * total(word[k:], c)
                   for k in range(1, min(3, len(word)) + 1))

    words = ["a", "aba", "babz", "zz"]
    assert np.allclose(model.score(words), [[np.log(total("▁" + w, c)) for c in range(2)] for w in words])


def test_language_edges(spark):
    docs = edge_docs(spark)
    model = langid.train(docs, PIECES)
    got = sorted(map(tuple, langid.identify(docs, model).collect()), key=repr)
    assert len(got) == len(TEXTS)
    by = {r[0]: r for r in got}
    assert by[1][1:] == by[2][1:] == by[3][1:] == by[7][1:] == ("und", 0.0) and by[4][1] == "en" and 0 <= by[4][2] <= 1
    assert langid.train(none_of(spark), PIECES) is None
    assert {r[1] for r in langid.identify(docs, None).collect()} == {"und"}
    assert langid.identify(none_of(spark), model).count() == 0


def test_every_language_is_learnt(spark):
    rows = [(i, f"{chr(97 + k // 26) * 3}{chr(97 + k % 26) * 3} {chr(97 + k % 26) * 2}{chr(97 + k // 26) * 4}" * 3, f"l{k:03d}") for i, k in enumerate(list(range(230)) * 2)]
    docs = small_frame(spark, rows, "doc_id long, text string, lang string")
    model = langid.train(docs, PIECES)
    assert model.langs == [f"l{k:03d}" for k in range(230)]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, model).collect()}
    assert sum(got[i] == n for i, _, n in rows) > 0.9 * len(rows)


def test_language_uses_the_whole_vocabulary(spark):
    pieces = langid.vocabulary(PIECES)
    model = langid.train(edge_docs(spark), PIECES)
    assert model.longest == max(map(len, pieces)) == 16
    assert len(model.keys) == len(set(pieces))


def test_toxicity_learns_unseen_spellings(spark):
    rng = np.random.default_rng(1)
    calm = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}en" for i in range(300)]

    def texts(n, insults):
        out = []
        for _ in range(n):
            words = list(rng.choice(calm, 60))
            if insults:
                words[rng.integers(60)] = rng.choice(insults)
            out.append(" ".join(words))
        return out

    learn = texts(400, ["horrible", "horribly", "dreadful", "dreadfuls"]) + texts(800, [])
    model = toxicity.fit(learn, np.array([1.0] * 400 + [0.0] * 800))
    unseen = texts(50, ["horribble", "dreadfull", "horriblest", "ddreadful"]) + texts(50, [])
    frame = spark.createDataFrame(list(enumerate(unseen)), "doc_id long, text string")
    score = [r["score"] for r in toxicity.score(frame, model).orderBy("doc_id").collect()]
    assert np.mean([a > b for a in score[:50] for b in score[50:]]) > 0.95


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op3(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in out.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) >= 0.85 and n.get((0, 1), 0) / n[0, 0] <= 0.02


def test_toxicity_edges(spark):
    docs = edge_docs(spark)
    model = toxicity.ToxicityModel(np.linspace(-1, 1, toxicity.BUCKETS), 0.25)
    got = [tuple(r) for r in toxicity.score(docs, model).collect()]
    assert len(got) == len(TEXTS) and all(0 <= s <= 1 for _, s in got)
    empty = {s for i, s in got if i in (1, 2, 3)}
    assert len(empty) == 1 and abs(empty.pop() - 1 / (1 + np.exp(-0.25))) < 1e-12
    assert {s for _, s in map(tuple, toxicity.score(docs, None).collect())} == {0.0}
    marks = docs.select("doc_id", F.lit(1).alias("toxic"))
    assert toxicity.train(docs, marks, F.lit(True)) is None
    assert toxicity.train(none_of(spark), marks, F.lit(True)) is None


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_round_trip(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(3)
    got = {r["doc_id"]: r for r in bpe.encode(docs, RANKS, P.PATTERN, buckets=5, block_words=2000, derive=bpe.digests(spark, RANKS)).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, text in rows:
        ids = library.encode_ordinary(text)
        assert got[i]["ids"] == ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_edges(spark, library):
    docs = edge_docs(spark)
    got = sorted(((r["doc_id"], r["ids"]) for r in bpe.encode(docs.drop("ids", "block"), RANKS, P.PATTERN).collect()), key=repr)
    want = sorted(((i, library.encode_ordinary(t or "")) for i, t in TEXTS), key=repr)
    assert got == want
    assert bpe.encode(docs, RANKS, P.PATTERN).count() == len(TEXTS)
    assert bpe.encode(none_of(spark), RANKS, P.PATTERN).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r[0]: r[1] for r in bpe.decode(odd, RANKS).collect()} == {1: None, 2: b""}


@pytest.mark.parametrize("word", ["a" * 500, "ab" * 400, " " * 301, "ünïcödé" * 60, "\U0001F600" * 90, "qzx" * 201])
def test_long_words_merge_alike(library, word):
    ranks = bpe.read_ranks(RANKS)
    assert bpe.encode_word(word.encode(), ranks) == library._core_bpe.encode_single_piece(word.encode())


def test_packed_numbers():
    for x in (np.array([], np.int64), np.array([0, 1, 127, 128, 16383, 16384, 2**31 - 1, 5])):
        assert bpe.unpack(bpe.pack(x)).tolist() == x.tolist()


def grams_by_hand(word):
    """Buckets of a word's n-grams, one after the other."""
    points, out = [ord(c) for c in f"<{word}>"], []
    for k in toxicity.GRAMS:
        for i in range(len(points) - k + 1):
            h = k
            for p in points[i: i + k]:
                x = (h * 0x100000001B3 + p) % 2 ** 64
                x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % 2 ** 64
                x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % 2 ** 64
                h = x ^ (x >> 31)
            out.append(h % toxicity.BUCKETS)
    return out


def score_by_hand(text, model):
    words = [grams_by_hand(w) for w in toxicity.WORD.findall((text or "").lower())]
    best = None
    for start in range(0, max(len(words) - toxicity.STRIDE, 1), toxicity.STRIDE):
        grams = [g for w in words[start: start + toxicity.WINDOW] for g in w]
        z = sum(model.logit[g] for g in grams) / max(len(grams), 1) + model.bias
        best = z if best is None else max(best, z)
    return 1 / (1 + np.exp(-best))


def test_toxicity_scores_by_hand(spark):
    """Whole texts and whole words, however long."""
    draw = np.random.default_rng(6)
    model = toxicity.ToxicityModel(draw.normal(size=toxicity.BUCKETS), -0.3)
    texts = [None, "", "...", "a", "One two", "It was the best of times, it WAS the worst of times; éà 12", "x" * 300 + " y", "ab " * 50]
    docs = small_frame(spark, list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(score_by_hand(t, model), abs=1e-12), t


@pytest.mark.parametrize("whole", [True, False])
def test_toxicity_gradient_is_the_difference_quotient(whole):
    draw = np.random.default_rng(7)
    texts, labels = ["a bad word here and there again", "good day", "", "the sun is out today my friend yes"], np.array([1.0, 0.0, 1.0, 0.0])
    batch = toxicity._Batch(texts, labels, np.array([0.3, 0.2, 0.4, 0.1]))
    logit, bias = draw.normal(size=toxicity.BUCKETS), 0.1

    def loss(logit, bias):
        total = 0.0
        for t, y, w in zip(texts, labels, batch.weight):
            words = [grams_by_hand(x) for x in toxicity.WORD.findall(t)]
            z = []
            for start in range(0, max(len(words) - toxicity.STRIDE, 1), toxicity.STRIDE):
                grams = [g for x in words[start: start + toxicity.WINDOW] for g in x]
                z.append(sum(logit[g] for g in grams) / max(len(grams), 1) + bias)
            v = np.mean(z) if whole else max(z)
            total += w * (np.log1p(np.exp(v)) - y * v)
        return total

    pull, slope = batch.pull(logit, bias, whole)
    assert slope == pytest.approx((loss(logit, bias + 1e-6) - loss(logit, bias - 1e-6)) / 2e-6, abs=1e-7)
    for g in np.flatnonzero(pull)[:25].tolist() + [int(np.flatnonzero(pull == 0)[0])]:
        up, down = logit.copy(), logit.copy()
        up[g] += 1e-6
        down[g] -= 1e-6
        assert pull[g] == pytest.approx((loss(up, bias) - loss(down, bias)) / 2e-6, abs=1e-7)


def test_toxicity_learns_from_bounded_texts_only(spark):
    docs = small_frame(spark, [(i, ("bad " if i % 2 else "fine ") * 5) for i in range(40)] + [(99, "bad " * 100)], "doc_id long, text string")
    labels = small_frame(spark, [(i, i % 2) for i in range(40)] + [(99, 0)], "doc_id long, toxic int")
    with_long = toxicity.train(docs, labels, F.lit(True), max_chars=50)
    without = toxicity.train(docs.where("doc_id < 99"), labels, F.lit(True))
    assert np.array_equal(with_long.logit, without.logit)


def segmentations(word, pieces):
    """Every way to cut a word into pieces; single characters stand in for the unknown."""
    if not word:
        return [[]]
    return [[word[:k], *rest] for k in range(1, len(word) + 1) if k == 1 or word[:k] in pieces for rest in segmentations(word[k:], pieces)]


def rows_of(model, pieces):
    """Row of ``prob`` for every piece."""
    out = {}
    for own, points in langid.by_length(pieces):
        for k, h in langid._hashes(points, model.longest):
            if k == points.shape[1]:
                out |= {pieces[i]: int(np.searchsorted(model.keys, v)) for i, v in zip(own, h[:, 0])}
    return out


def test_posterior_of_a_text_by_listing_segmentations(spark):
    import pandas as pd
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab"]
    model = langid.fit(pd.DataFrame({"lang": list("xxyyz"), "word": ["aba", "ab", "ba", "bb", "abab"], "n": [3, 2, 5, 1, 4]}), pieces, 3)
    at = rows_of(model, pieces)
    text = "Aba ba, zab AB! abba"
    logs = np.zeros(3)
    for w in langid.WORD.findall(text.lower()):
        for c in range(3):
            logs[c] += np.log(sum(np.prod([model.prob[at.get(p, len(model.keys)), c] for p in cut]) for cut in segmentations("▁" + w, pieces)))
    posterior = np.exp(logs - logs.max()) / np.exp(logs - logs.max()).sum()
    row = langid.identify(small_frame(spark, [(1, text)], "doc_id long, text string"), model).first()
    assert row.lang_pred == model.langs[posterior.argmax()] and row.score == pytest.approx(posterior.max(), abs=1e-9)


def test_em_counts_by_listing_segmentations():
    import pandas as pd
    pieces, words, smooth = ["▁", "a", "b", "ab", "▁a", "ba"], {"aba": 3, "ab": 2, "zb": 1}, 0.1
    model = langid.fit(pd.DataFrame({"lang": "x", "word": list(words), "n": list(words.values())}), pieces, 3, rounds=3, smooth=smooth)
    at = rows_of(model, pieces)
    size = len(model.keys) + 1
    prob = np.full(size, 1.0 / size)
    for _ in range(3):
        seen = np.zeros(size)
        for w, n in words.items():
            cuts = [[at.get(p, size - 1) for p in cut] for cut in segmentations("▁" + w, pieces)]
            weight = np.array([np.prod(prob[cut]) for cut in cuts])
            for cut, share in zip(cuts, weight / weight.sum()):
                np.add.at(seen, cut, n * share)
        prob = (seen + smooth) / (seen.sum() + smooth * size)
    assert np.allclose(model.prob[:, 0], prob)


def test_language_of_a_very_long_run(spark, medium):
    """A hundred thousand letters without a space are one word."""
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    model = langid.train(docs, PIECES, rows_per_lang=20)
    run = "".join("the quick brown fox jumps over this lazy dog and then that other one" .split()) * 1800
    started = time.time()
    row = langid.identify(small_frame(spark, [(1, run)], "doc_id long, text string"), model).first()
    assert time.time() - started < 120 and row.lang_pred == "en"
