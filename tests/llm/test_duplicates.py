import numpy as np
import pytest
from helpers import TEXTS, edge_docs, none_of

from tablewright.llm import common, embeddings, minhash
from tablewright.session import small_frame


def reach(n, links):
    low = list(range(n))
    while True:
        new = low[:]
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == low:
            return low
        low = new


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(400 + i, 401 + i) for i in range(40)]
    low = reach(500, links)
    got = {r[0]: r[1] for r in common.components(small_frame(spark, links, "a long, b long")).collect()}
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: low[x] for x in touched}
    assert common.components(small_frame(spark, [(1, 1)], "a long, b long")).count() == 0


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i: i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size, percent):
    sets = [sets_of(t, size) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and
             100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    low = reach(len(rows), links)
    names = [min(rows[j][0] for j in range(len(rows)) if low[j] == low[i]) for i in range(len(rows))]
    return sorted((rows[i][0], len(sets[i]), names[i], names[i] == rows[i][0]) for i in range(len(rows)))


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_minhash_against_all_pairs(spark, size, percent):
    rng = np.random.default_rng(size)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for g in range(25):
        base = list(rng.choice(vocab, rng.integers(2, 160)))
        for _ in range(rng.integers(1, 9)):
            words = base[:]
            for _ in range(rng.integers(0, 1 + len(words) // 25)):
                words[rng.integers(len(words))] = rng.choice(vocab)
            rows.append((i, " ".join(words)))
            i += 1
    # many texts around one passage: buckets that hold unlinked texts
    passage = list(rng.choice(vocab, 60))
    for _ in range(60):
        rows.append((i, " ".join(passage + list(rng.choice(vocab, rng.integers(10, 60))))))
        i += 1
    rng.shuffle(rows)
    rows = [(int(a), str(b)) for a, b in rows]
    got = minhash.near_duplicates(small_frame(spark, rows, "doc_id long, text string"), size, percent)
    assert sorted(map(tuple, got.collect())) == brute(rows, size, percent)


def test_crowded_bucket_meets_outside_its_main_component(spark):
    """All pairs of different components share a group, and the members of the main one are not sent to each other's tiles."""
    labelled = small_frame(spark, [(i, 5, 0 if i % 20 else i + 1) for i in range(9000)], "doc_id long, key long, component_id long")
    rest = labelled.join(minhash._open_buckets(labelled), "key")
    groups = {}
    for r in minhash._dealt(rest).collect():
        groups.setdefault((r.i, r.j), []).append(r)
    assert sum(map(len, groups.values())) < 36_000  # all members to all 36 tiles: 324,000
    met = {(min(x.doc_id, y.doc_id), max(x.doc_id, y.doc_id)) for (i, j), own in groups.items()
           for x in own if x.left == i and x.doc_id % 400 == 0 for y in own if y.right == j and y.doc_id != x.doc_id}
    assert met == {(min(a, b), max(a, b)) for a in range(0, 9000, 400) for b in range(9000) if a != b}


def test_minhash_with_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 5)
    test_minhash_against_all_pairs(spark, 3, 85)


def test_minhash_edges(spark):
    got = sorted(map(tuple, minhash.near_duplicates(edge_docs(spark), 3, 85).collect()), key=repr)
    assert len(got) == len(TEXTS)
    assert got.count((6, 10, 5, False)) == 2 and (5, 10, 5, True) in got
    assert all((i, 0, i, True) in got for i in (1, 2, 3)) and (9, 1, 9, True) in got
    assert [r for r in got if r[0] is None][0][2:] == (None, True)
    assert minhash.near_duplicates(none_of(spark)).count() == 0


def test_sketch_agreement_estimates_similarity():
    rng = np.random.default_rng(0)
    agree = []
    for n in (3, 40, 5000):
        a = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        x, y = minhash.sketch(a[: n + n // 2], 512), minhash.sketch(a[n // 2:], 512)
        agree.append(abs((x == y).mean() - len(set(a[: n + n // 2]) & set(a[n // 2:])) / (2 * n)))
    assert max(agree[1:]) < 0.1 and agree[0] < 0.2


def cosine_rows(rows):
    good = {k: v for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v) and rows[k][0] is not None}
    unit = {k: np.array(v, float) / np.linalg.norm(np.array(v, float)) for k, v in good.items()}
    links = [(a, b) for a in unit for b in unit if a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    low = reach(len(rows), links)
    out = []
    for k, (i, _) in enumerate(rows):
        c = min((rows[j][0] for j in range(len(rows)) if low[j] == low[k] and rows[j][0] is not None), default=None)
        out.append((i, sum(a == k for a, _ in links), c, c == i))
    return sorted(out, key=repr)


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(40):
        base = rng.normal(size=16)
        for s in rng.uniform(0, 0.8, rng.integers(1, 8)):
            rows.append((len(rows), [float(x) for x in (base + s * rng.normal(size=16)).astype(np.float32)]))
    rows += [(len(rows) + i, rows[0][1]) for i in range(5)]
    n = len(rows)
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 16), (n + 3, [1.0, None] * 8), (n + 4, [float("nan")] * 16),
             (n + 5, [float("inf")] * 16), (n + 6, [1.0, 2.0]), (n + 7, [2.0, 4.0]), (n + 8, [1e-30] * 16), (n + 9, [3e30] * 16)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    frame = small_frame(spark, [(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, n long, id long")
    got = embeddings.near_duplicates(frame, tile=50)
    assert sorted(map(tuple, got.collect()), key=repr) == cosine_rows(rows)


def test_embedding_edges(spark):
    frame = small_frame(spark, [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1])], "vec_id long, embedding array<float>")
    got = sorted(map(tuple, embeddings.near_duplicates(frame).collect()), key=repr)
    assert got == sorted([(None, 0, None, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)], key=repr)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(4)
    unit = embeddings.unit_rows(rng.normal(size=(200, 64)))
    codes, scale, error, length = embeddings.quantise(unit)
    about = (codes @ codes.T) * scale[:, None] * scale[None, :]
    bound = error[:, None] + length[:, None] * error[None, :]
    assert (np.abs(unit @ unit.T - about) <= bound + 1e-9).all() and bound.max() < 0.05
