import hashlib
import itertools
import random
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from helpers import LONG, TEXTS, edge_docs, none_of
from pyspark.sql import functions as F

from tablewright.llm import collocations, merkle, packing
from tablewright.llm.bpe import read_ranks
from tablewright.session import small_frame

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(JSON)
    tool.encode_special_tokens = True
    return lambda texts: [e.ids for e in tool.encode_batch_fast(texts, add_special_tokens=False)]


# --- packing

def by_rows(lengths, capacity):
    """Best fit, the longest first, one piece at a time: the number of sequences."""
    gaps, n = [], 0
    for x in sorted(lengths, reverse=True):
        k = bisect_left(gaps, x)
        if k == len(gaps):
            n, gap = n + 1, capacity - x
        else:
            gap = gaps.pop(k) - x
        insort(gaps, gap)
    return n


def used(places):
    """Sequence: its (offset, length) in order; every rank of a length is placed once."""
    out, seen = defaultdict(list), Counter()
    for p in places:
        assert p.first == seen[p.length]
        seen[p.length] += p.count
        for j in range(p.count):
            out[p.sequence + j // p.each].append((p.offset + j % p.each * p.length, p.length))
    return out, seen


@pytest.mark.parametrize("capacity,most,n", [(2048, 2048, 3000), (2048, 700, 3000), (2048, 9, 5000), (12, 12, 400), (3, 3, 10), (1, 1, 4)])
def test_plan_is_best_fit(capacity, most, n):
    draw = random.Random(capacity + most)
    lengths = [draw.randint(1, most) for _ in range(n)]
    counts = Counter(lengths)
    places, total = packing.plan(dict(counts), capacity)
    sequences, seen = used(places)
    assert seen == counts and len(sequences) == total
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in held) <= 2 or capacity < 3
    assert total <= by_rows(lengths, capacity)
    assert len(places) <= 4 * capacity


def test_plan_grows_with_lengths_only():
    few, _ = packing.plan({n: 3 for n in range(1, 2049)}, 2048)
    many, total = packing.plan({n: 3_000_000_000 for n in range(1, 2049)}, 2048)
    assert len(many) <= 4 * 2048 and len(few) <= 4 * 2048
    assert total >= sum(range(1, 2049)) * 3_000_000_000 // 2048


def test_ids_are_those_of_the_library(tokenizer):
    encode = packing.Encoder(read_ranks(RANKS), public_tokenizers.PATTERN).encode
    texts = ["", " ", "a  b", "a \n b", "x\n\ny", " a", "a ", "don't we'll 12 3.4", "<|endoftext|>", "a\x1cb \x85 c", LONG, "z" * 30_000]
    texts += [f"a{chr(c)}a {chr(c)}1{chr(c)}1 {chr(c)}.{chr(c)}" for c in itertools.chain(range(1, 0xD800, 7), range(0xE000, 0x20000, 31))]
    texts += [f"a{chr(c)} {chr(c)}b\n{chr(c)}" for c in range(1, 0x3100)]
    for text, ids in zip(texts, tokenizer(texts)):
        assert encode(text).tolist() == ids


def test_pack_keeps_every_token(spark, tokenizer):
    capacity = 64
    out = packing.pack(edge_docs(spark), RANKS, public_tokenizers.PATTERN, capacity, ids=True).cache()
    rows = out.collect()
    docs = defaultdict(list)
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.piece)):
        assert r.length == len(r.ids) <= capacity
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r.ids))
        docs[r.doc_id].append(r)
    want = defaultdict(list)
    for (i, t), ids in zip(TEXTS, tokenizer([t or "" for _, t in TEXTS])):
        want[i].append(ids + [0])
    for i, texts in want.items():
        if len(texts) == 1:
            assert [x for r in docs[i] for x in r.ids] == texts[0]
            assert [r.start for r in docs[i]] == list(itertools.accumulate((r.length for r in docs[i][:-1]), initial=0))
            assert all(r.length == capacity for r in docs[i][1:])
        else:
            assert sum(r.length for r in docs[i]) == sum(map(len, texts))
    whole = {r.sequence_id: r.ids for r in packing.sequences(out).collect()}
    assert max(map(len, whole.values())) <= capacity
    for r in rows:
        assert whole[r.sequence_id][r.offset: r.offset + r.length] == r.ids
    assert sum(map(len, whole.values())) == sum(r.length for r in rows)
    assert len(whole) == packing.plan(dict(Counter(r.length for r in rows)), capacity)[1]


def test_pack_nothing(spark):
    out = packing.pack(none_of(spark), RANKS, public_tokenizers.PATTERN)
    assert out.count() == 0
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_pack_query_is_best_fit(spark, sf):
    from tablewright.llm.queries import QUERIES

    rows = QUERIES["op12_best_fit_packing"](spark, sf).collect()
    assert len({r.sequence_id for r in rows}) <= by_rows([r.length for r in rows], 2048)
    ends = defaultdict(list)
    for r in rows:
        ends[r.sequence_id].append((r.offset, r.length))
    for held in ends.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048


# --- manifest

def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(digests):
    """The root and, per leaf, its siblings by level as (left, right)."""
    proofs, groups = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        runs = [range(i, min(i + 3, len(digests))) for i in range(0, len(digests), 3)]
        for run in runs:
            for k in run:
                side = ("".join(digests[j] for j in run if j < k), "".join(digests[j] for j in run if j > k))
                for i in groups[k]:
                    proofs[i].append(side)
        groups = [[i for k in run for i in groups[k]] for run in runs]
        digests = [h(*[digests[k] for k in run]) for run in runs]
    return digests[0], proofs


def by_hand(rows):
    """rows (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for i, source, lang, n, text in rows:
        bad = i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and text is not None
        leaf = leaf_of(i, source, lang, n, text)
        trees[source].append((i is not None, i or 0, leaf, i, leaf_of(i, source, lang, n, text.replace("\n", "")) if bad else leaf))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    low = {s: tree([x[2] for x in sorted(trees[s], key=lambda x: x[:3])]) for s in order}
    root, high = tree([low[s][0] for s in order])
    out = []
    for s, top in zip(order, high):
        for (*_, leaf, i, seen), own in zip(sorted(trees[s], key=lambda x: x[:3]), low[s][1]):
            folded = seen
            for left, right in own + top:
                folded = h(left, folded, right)
            proof = h(*[x + y for x, y in own + top])
            out.append((i, leaf, low[s][0], root, proof, folded, folded == root))
    return out


def random_rows(n, sources, seed):
    draw = random.Random(seed)
    for k in range(n):
        source = None if k % 11 == 0 else "s0" if k % 3 == 0 else draw.choice(sources)
        text = None if k % 13 == 0 else draw.choice(["", "one\ntwo", "a\n", "é \U0001F600", f"text {k}"])
        yield None if k % 17 == 0 else draw.randint(0, n), source, draw.choice([None, "en"]), draw.choice([None, 3]), text


def compared(spark, rows):
    docs = small_frame(spark, [(*r, 1, "x", 5) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, pos long, tree string, size int")
    got = sorted((tuple(r) for r in merkle.manifest(docs).collect()), key=repr)
    assert got == sorted(by_hand(rows), key=repr)


@pytest.mark.parametrize("n,sources", [(1, ["a"]), (60, ["a", "é", "ab", "B", ""]), (700, ["a"])])
def test_manifest_by_hand(spark, n, sources):
    compared(spark, list(random_rows(n, sources, n)))


def test_manifest_of_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    rows = list(random_rows(120, [f"s{k}" for k in range(12)], 3))
    compared(spark, rows + rows[:5])


def test_manifest_of_edge_rows(spark):
    out = merkle.manifest(edge_docs(spark)).collect()
    assert len(out) == len(TEXTS)
    assert all(r.verified == (r.folded_root == r.root) for r in out) and len({r.root for r in out}) == 1
    assert merkle.manifest(none_of(spark)).count() == 0


# --- phrases

def phrases_by_hand(docs, least, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3, 4):
                f.update((lang, *w[i: i + k]) for i in range(len(w) - k + 1))
    out = defaultdict(list)
    many = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    for g, a in many.items():
        lang, w = g[0], g[1:]
        score, k = min((2_000_000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        longer = [b for x, b in many.items() if x[0] == lang and len(x) > len(g) and any(x[i: i + len(w)] == w for i in range(1, len(x) - len(w) + 1))]
        if not any(100 * b >= 80 * a for b in longer):
            out[lang].append((-score, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted((lang, r, p.decode(), -a, x, y, n[lang], -s) for lang, rows in out.items()
                  for r, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1))


def phrase_docs(seed=5):
    draw = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "é", "\x00", "a b", "x", "UP"]
    passage = "it was a bright cold day in April and the clocks were striking thirteen times over the town"
    for k in range(150):
        text = " ".join(draw.choice(words) + draw.choice(["", "", "", "", ".", "\t", "\n", ","]) for _ in range(draw.randint(0, 60)))
        yield draw.choice(["en", "en", "fr", None, "und"]), (text + ". " + passage if k % 3 else text) if k % 10 else None
    yield "en", "ring around a " * 40
    yield "en", LONG


@pytest.mark.parametrize("least,top", [(2, 10_000), (5, 7), (30, 2000)])
def test_phrases_by_hand(spark, least, top):
    docs = list(phrase_docs())
    frame = small_frame(spark, [(lang, text, 1, "c") for lang, text in docs], "lang string, text string, k int, gram string")
    got = sorted(tuple(r) for r in collocations.collocations(frame, least, top).collect())
    assert got == phrases_by_hand(docs, least, top)


def test_phrases_of_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 100)
    docs = list(phrase_docs(6))
    frame = small_frame(spark, docs, "lang string, text string").repartition(3)
    assert sorted(tuple(r) for r in collocations.collocations(frame, 4).collect()) == phrases_by_hand(docs, 4, 2000)


def test_unary_paths_are_joined(spark):
    docs = [("en", "one two three four five six seven eight"), ("en", "one two three four five six seven eight"), ("en", "a b c a b c a b c d")]
    frame = small_frame(spark, docs, "lang string, text string").select("lang", F.col("text").cast("binary").alias("text"))
    found = collocations.grams(frame, 1, 4)
    got = {(" ".join(r.words), r.c) for r in collocations.paths(found, 4).collect()}
    assert ("one two three four five six seven eight", 2) in got
    assert {x for x in got if "one" not in x[0]} == {("a b c a b c", 2), ("a b c d", 1)}
    counts = {(r.gram, r.k): r.f for r in collocations.phrase_counts(found, 4).collect()}
    assert counts["a b c", 3] == 3 and counts["c", 1] == 3 and counts["d", 1] == 1 and counts["seven eight", 2] == 2


def test_phrases_of_edge_rows(spark):
    assert collocations.collocations(none_of(spark)).count() == 0
    out = collocations.collocations(edge_docs(spark), 2)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.count() > 0
