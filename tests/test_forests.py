import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.operators import forests, learners
from tablewright.operators.forests import Tree, fit_forest, grow
from tablewright.session import small_frame


def by_hand(x, y, w, depth=None, min_split=2, level=0):
    """One node after the other, every midpoint of every feature."""
    mean = (w[:, None] * y).sum(0) / w.sum()
    if (w[:, None] * (y - mean) ** 2).sum() <= 1e-24 * (w[:, None] * y ** 2).sum() or len(y) < max(2, min_split) or level == depth:
        return {"value": mean}
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for a, b in zip(values, values[1:]):
            t = a + (b - a) / 2
            left = x[:, f] <= t
            gain = sum(w[m].sum() * ((((w[m][:, None] * y[m]).sum(0) / w[m].sum()) - mean) ** 2).sum() for m in (left, ~left))
            if best is None or gain > best[0] * (1 + 1e-12):
                best = gain, f, t
    if best is None:
        return {"value": mean}
    left = x[:, best[1]] <= best[2]
    return {"value": mean, "on": best[1:], "sides": [by_hand(x[m], y[m], w[m], depth, min_split, level + 1) for m in (left, ~left)]}


def walked(node, row):
    while "on" in node:
        node = node["sides"][0 if row[node["on"][0]] <= node["on"][1] else 1]
    return node["value"]


@pytest.mark.parametrize("n,width,outputs,depth,min_split", [(1, 2, 1, None, 2), (40, 3, 1, None, 2), (60, 2, 3, None, 2), (80, 4, 2, 3, 5), (50, 1, 1, None, 8)])
def test_grow_is_the_greedy_tree(n, width, outputs, depth, min_split):
    draw = np.random.default_rng(n)
    for _ in range(5):
        x, y, w = draw.integers(0, 9, (n, width)).astype(float), draw.normal(size=(n, outputs)), draw.integers(1, 4, n).astype(float)
        tree, want = Tree.unpack(grow(x, y, w, depth, min_split).pack()), by_hand(x, y, w, depth, min_split)
        np.testing.assert_allclose(tree.value[tree.find(x)], [walked(want, r) for r in x])


def test_weights_are_poisson():
    w = forests.weights(np.arange(200_000), 3, 42, True)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02 and abs((w == 0).mean() - np.exp(-1)) < 0.005
    assert not np.array_equal(w, forests.weights(np.arange(200_000), 4, 42, True))


def test_nodes_are_met_once_a_block():
    """Batches are joined to blocks of bounded size, and one sort finds the rows of all nodes."""
    draw = np.random.default_rng(6)
    x = draw.normal(size=(50_000, 3))
    def batch(at, n):
        return pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + n)), pa.array(list(x[at: at + n])), pa.array(list(x[at: at + n, :1]))], ["uid", "x", "y"])
    blocks = list(forests._blocks(batch(at, 1000) for at in range(0, 50_000, 1000)))
    assert len(blocks) == 1 and np.array_equal(blocks[0][1], x)
    wide = np.zeros((40, 20_000))
    rows = pa.RecordBatch.from_arrays([pa.array(np.arange(40)), pa.array(list(wide)), pa.array(list(wide[:, :1]))], ["uid", "x", "y"])
    assert max(len(b[0]) for b in forests._blocks([rows])) == forests.BLOCK_BYTES // (8 * 20_002)
    for high in (3, 500, 100_000):
        node = draw.integers(0, high, 5000)
        got = dict(forests._by_node(node))
        assert sorted(got) == np.unique(node).tolist() and all(np.array_equal(at, np.flatnonzero(node == n)) for n, at in got.items())
    assert list(forests._by_node(node[:0])) == []


def noisy(spark, n=3000, seed=1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 3)).round(2)
    rows = [(i, *map(float, r), float(3 * r[0] - r[1] ** 2), float(i % 5)) for i, r in enumerate(x)]
    return small_frame(spark, rows, "id long, a double, b double, c double, y double, z double").repartition(4)


def predicted(frame, model, **kw):
    return {r.id: r.p for r in model.predict(frame, "p", **kw).collect()}


def test_single_tree_to_purity(spark):
    rows = noisy(spark)
    model = fit_forest(rows, ["a", "b", "c"], "z", trees=1, bootstrap=False)
    got = predicted(rows, model)
    same = rows.groupBy("a", "b", "c").agg(F.avg("z").alias("m")).join(rows, ["a", "b", "c"])
    assert all(abs(got[r.id] - r.m) < 1e-9 for r in same.collect())


def test_large_nodes_split_by_histograms(spark, monkeypatch):
    """With little room in a task the top levels come from histograms; the leaves are as pure."""
    rows = noisy(spark)
    monkeypatch.setattr(forests, "HIST_BYTES", 20_000)
    model = fit_forest(rows, ["a", "b", "c"], ["z", "y"], trees=1, bootstrap=False, task_rows=150)
    assert len(model.top[0].feature) > 30 and model.subtrees.count() > 15
    got = predicted(rows, model, vector=True)
    exact = {r.id: (r.z, r.y) for r in rows.collect()}
    alone = rows.groupBy("a", "b", "c").agg(F.count("*").alias("n")).where("n = 1").join(rows, ["a", "b", "c"]).select("id").collect()
    assert len(alone) > 2000 and all(np.allclose(got[r.id], exact[r.id]) for r in alone)


def test_constant_features_and_heavy_values(spark):
    rows = small_frame(spark, [(i, 1.0, float(i % 2 if i < 50 else 7), float(i % 2)) for i in range(1000)], "id long, a double, b double, z double")
    model = fit_forest(rows, ["a", "b"], "z", trees=2, bootstrap=False, task_rows=20)
    got = predicted(rows, model)
    assert got[0] == pytest.approx(0) and got[1] == pytest.approx(1) and got[99] == pytest.approx(0.5)


def test_sent_and_met_models_agree(spark, monkeypatch):
    rows = noisy(spark)
    model = fit_forest(rows, ["a", "b", "c"], "y", trees=7, task_rows=1000)
    sent = predicted(rows, model)
    monkeypatch.setattr(forests, "SENT_BYTES", 0)
    monkeypatch.setattr(forests, "BUSY_ROWS", 40)
    met = predicted(rows, model)
    assert sent.keys() == met.keys() and all(abs(sent[i] - met[i]) < 1e-9 for i in sent)
    truth = {r.id: r.y for r in rows.collect()}
    errors = np.array([sent[i] - truth[i] for i in sent])
    assert np.var(errors) < 0.05 * np.var(list(truth.values()))


def test_forest_generalises(spark):
    train, test = noisy(spark, seed=1), noisy(spark, 500, seed=2)
    model = learners.random_forest(train, ["a", "b", "c"], "y", trees=20)
    scores = learners.score(test, model, ["a", "b", "c"], "p").agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("e"), F.var_pop("y").alias("v")).first()
    assert scores.e < 0.1 * scores.v


def test_missing_and_clashing_columns(spark):
    rows = noisy(spark).withColumns({"uid": F.lit("u"), "x": F.lit("x"), "tree": F.lit("t"), "node": F.lit("n"), "value": F.lit("v"), "row": F.lit("r")})
    rows = rows.withColumn("a", F.when(F.col("id") % 10 != 0, F.col("a"))).withColumn("y", F.when(F.col("id") % 3 != 0, F.col("y")))
    out = learners.forest_impute(rows, ["a", "b", "c"], "y", trees=3)
    assert out.columns == rows.columns and out.count() == rows.count()
    left = out.where("y is null").select((F.col("id") % 30).alias("m")).distinct().collect()
    assert [r.m for r in left] == [0]
    assert out.where("tree <> 't' or uid <> 'u' or value <> 'v'").isEmpty()
    with pytest.raises(ValueError):
        fit_forest(rows.limit(0), ["a"], "y")


def test_met_model_keeps_columns(spark, monkeypatch):
    rows = noisy(spark, 300).withColumns({"uid": F.lit("u"), "x": F.lit("x"), "tree": F.lit("t"), "mean": F.lit("m")})
    model = fit_forest(rows, ["a", "b"], "y", trees=2)
    monkeypatch.setattr(forests, "SENT_BYTES", 0)
    out = model.predict(rows, "p")
    assert out.columns == [*rows.columns, "p"] and out.where("p is null or uid <> 'u' or mean <> 'm'").isEmpty() and out.count() == 300


def test_one_row(spark):
    rows = small_frame(spark, [(1, 2.0, 5.0)], "id long, a double, y double")
    assert predicted(rows, fit_forest(rows, ["a"], "y", trees=5)) == {1: 5.0}


def test_small_nodes_grow_in_groups(monkeypatch):
    """Groups of small nodes give the tree that all nodes at a time give; a tree tells its parts as it finds leaves."""
    draw = np.random.default_rng(8)
    x, y, w = draw.normal(size=(3000, 3)), draw.normal(size=(3000, 2)), draw.integers(1, 4, 3000).astype(float)
    whole = grow(x, y, w)
    monkeypatch.setattr(forests, "NEAR_ROWS", 100)
    parts = grow(x, y, w)
    assert len(parts.feature) == len(whole.feature) and (parts.left[parts.feature >= 0] > np.flatnonzero(parts.feature >= 0)).all()
    np.testing.assert_allclose(parts.value[parts.find(x)], whole.value[whole.find(x)])
    top, rows = grow(x, y, w, depth=4), np.arange(0, 3000, 2)
    leaves = top.find(x)
    met = dict(top.parts(np.asfortranarray(x), rows))
    assert sorted(met) == np.unique(leaves[rows]).tolist() and all(np.array_equal(at, rows[leaves[rows] == leaf]) for leaf, at in met.items())


def test_training_rows_are_dealt_evenly(spark, monkeypatch):
    """Rows of one file are learned from by all tasks."""
    stored = {}
    def kept(df, name="stage", own=forests.cut_lineage):
        stored[name] = own(df, name)
        return stored[name]
    monkeypatch.setattr(forests, "cut_lineage", kept)
    fit_forest(noisy(spark).coalesce(1), ["a", "b", "c"], "y", trees=2)
    held = stored["training"].groupBy(F.spark_partition_id()).count().collect()
    assert len(held) >= spark.sparkContext.defaultParallelism // 2 and max(r["count"] for r in held) < 1500


def test_few_points_are_learned_from_their_sums(spark, monkeypatch):
    """Rows of few distinct points are added up per point and tree; the trees are those of the rows."""
    rows = noisy(spark, 6000).select("id", F.hash("id").alias("a"), "y", "z").withColumns({"a": F.pmod("a", F.lit(7)).cast("double"), "b": (F.col("id") % 5).cast("double")})
    want = predicted(rows, fit_forest(rows, ["a", "b"], ["y", "z"], trees=6, min_split=3), vector=True)  # not from sums
    def never(*_, **__):
        raise AssertionError("rows are looked through level by level")
    monkeypatch.setattr(forests, "_split_large", never)
    got = predicted(rows, fit_forest(rows, ["a", "b"], ["y", "z"], trees=6), vector=True)
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in got)


def test_trees_and_boosting_learn_from_merged_rows(spark):
    """A table of few points keeps weights, means and squares, and has as many rows however many it is made from."""
    rows = small_frame(spark, [(float(i % 4), float(i % 3), i % 12 < 4) for i in range(1200)], "h double, y double, v boolean")
    points = learners.merged(rows, ["h"], "y", ["v"])
    assert points.count() <= 16
    for of in (rows.withColumn(learners.WEIGHT, F.lit(1.0)), points):
        w = F.col(learners.WEIGHT)
        sums = of.groupBy("h", "v").agg(F.sum(w).alias("n"), F.sum(w * F.col("y")).alias("s"), F.sum(w * F.col("y") ** 2).alias("q")).orderBy("h", "v").collect()
        if of is points:
            assert np.allclose(np.array(sums, float), held)
        held = np.array(sums, float)
    model = learners.decision_tree(rows, ["h"], "y")
    got = {r.h: r.p for r in learners.score(rows.select("h").distinct(), model, ["h"], "p").collect()}
    assert got == pytest.approx({r.h: r.m for r in rows.groupBy("h").agg(F.avg("y").alias("m")).collect()})


def test_orders_and_draws_are_those_of_plain_sorts():
    draw = np.random.default_rng(3)
    for c in (draw.normal(size=5000), draw.integers(-40, 40, 5000).astype(float), np.array([0.0, -0.0, 1.5, -np.inf, np.inf, -0.0, 1e-310, -1e300]), np.ones(3)):
        assert np.array_equal(forests._ascending(c), np.argsort(c, kind="stable"))
    h = np.arange(300_000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((7 * 0x85EBCA6B + 42 * 0xC2B2AE35 + 1) & 0xFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)
    assert np.array_equal(forests.weights(np.arange(300_000), 7, 42, True), np.searchsorted(forests.UPTO, u, side="right"))


def test_rows_of_a_place_lie_side_by_side(spark, monkeypatch):
    """Blocks that fall in one node are added up as a whole, and the forest is the one of rows in any order."""
    rows = noisy(spark, 6000)
    want = predicted(rows, fit_forest(rows, ["a", "b", "c"], "y", trees=5, task_rows=500))
    monkeypatch.setattr(forests, "CELL_ROWS", 60)
    monkeypatch.setattr(forests, "AREA_BYTES", 2400)  # 60 rows
    stored = []
    def kept(df, name="stage", own=forests.cut_lineage):
        stored.append((name, own(df, name)))
        return stored[-1][1]
    monkeypatch.setattr(forests, "cut_lineage", kept)
    model = fit_forest(rows, ["a", "b", "c"], "y", trees=5, task_rows=500)
    got = predicted(rows, model)
    assert got.keys() == want.keys() and np.mean([abs(got[i] - want[i]) < 1e-9 for i in got]) > 0.95  # equally good splits aside
    held = [df for name, df in stored if name == "training"]
    assert len(held) == 2 and held[1].count() == 6000
    def whole(df):
        blocks = forests._blocks(iter(df.toArrow().to_batches(max_chunksize=60)), 2400)
        return np.mean([t.feature[t.whole(x.min(axis=0), x.max(axis=0))] < 0 for _, x, _ in blocks for t in model.top])
    assert whole(held[0]) < 0.01 and whole(held[1]) > 0.15


def test_a_forest_used_once_is_not_stored(spark, monkeypatch):
    """Subtrees predict where they are grown, as the stored forest does; rows asked about may outnumber the known ones."""
    rows = noisy(spark, 4000)
    train, asked = rows.where("id % 5 = 0"), rows.where("id % 5 <> 0")
    asked = asked.unionByName(asked.limit(3).withColumns({"a": F.lit(1e6), "id": F.col("id") + 10_000}))
    want = predicted(asked, fit_forest(train, ["a", "b", "c"], "y", trees=9, task_rows=200))
    stored = []
    def kept(df, name="stage", own=forests.cut_lineage):
        stored.append(name)
        return own(df, name)
    monkeypatch.setattr(forests, "cut_lineage", kept)
    out = forests.fit_predict(train, ["a", "b", "c"], "y", asked, "p", trees=9, task_rows=200)
    got = {r.id: r.p for r in out.collect()}
    assert out.columns == [*rows.columns, "p"] and "subtrees" not in stored
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_rows_travel_once_to_a_home(spark, monkeypatch):
    """Nodes of one place in several trees are grown in one task, which gets a row once; every leaf has one home."""
    monkeypatch.setattr(forests, "CELL_ROWS", 60)
    rows = noisy(spark, 6000).select(F.array("a", "b", "c").alias("x"), F.array("y").alias("y"))
    training, top, left, homes = forests._prepared(rows, 40, None, 2, 42, True, 600)
    leaves = [(t, m) for t, tree in enumerate(top.frozen()) for m in np.flatnonzero(tree.feature < 0).tolist()]
    assert sorted(node for own in homes for node in own) == leaves and max(map(len, homes)) <= forests.BOND
    found = forests._dealt(training, top, left, homes, 42, True).toArrow().to_pylist()
    held = {h: [np.frombuffer(p["held"], np.uint16) for p in found if p["home"] == h] for h in range(len(homes))}
    sent = sum(len(b) for pieces in held.values() for b in pieces)
    drawn = {node: sum(int((b >> i & 1).sum()) for b in held[h]) for h, own in enumerate(homes) for i, node in enumerate(own)}
    uid = training.toPandas()["uid"].to_numpy()
    assert sum(drawn.values()) == sum(int((forests.weights(uid, t, 42, True) > 0).sum()) for t in range(40))
    assert sent < 0.5 * sum(drawn.values())
