import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablewright.functions.numbers import clipped, decade, finite, money, percent_fraction, ratio, real_power, to_long
from tablewright.functions.text import null_tokens, shortened
from tablewright.operators import missing, neighbours, ordered, scaling


def test_scalar_rules(spark):
    df = spark.createDataFrame([("$1,234.50", "2.88%", "-44,089", "N.A.", -1.0, 1905)],
                               "m string, p string, n string, x string, neg double, y int")
    r = df.select(money(F.col("m")), percent_fraction(F.col("p")), to_long(F.col("n")), null_tokens(F.col("x")),
                  real_power(F.col("neg"), 2.5), decade(F.col("y")), ratio(F.lit(1.0), F.lit(0.0)),
                  clipped(F.lit(None).cast("double"), 0.0), finite(F.lit(math.inf)), shortened(F.lit("a" * 21))).first()
    assert r[0] == 1234.5 and r[1] == pytest.approx(0.0288) and r[2] == -44089
    assert list(r[3:9]) == [None, None, 1900, None, None, None] and r[9] == "a" * 20 + "..."


def test_group_median_with_missing_key(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, "a", 3.0), (4, None, 50.0), (5, None, None), (6, "b", None)],
                               "id int, g string, v double")
    keep = dict(rows(missing.fill_group_median(df, "v", ["g"]).select("id", "v"), "id"))
    # filled column is 1, 2, 3, 50 -> global median 2.5
    assert keep == {1: 1.0, 2: 2.0, 3: 3.0, 4: 50.0, 5: 2.5, 6: 2.5}
    legacy = dict(rows(missing.fill_group_median(df, "v", ["g"], legacy_null_key=True).select("id", "v"), "id"))
    assert legacy == {1: 1.0, 2: 2.0, 3: 3.0, 4: 2.0, 5: 2.0, 6: 2.0}


def test_legacy_fill_equals_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": range(300), "g": rng.choice(["a", "b", "c", None], 300), "v": rng.normal(size=300)})
    pdf.loc[rng.random(300) < 0.3, "v"] = np.nan
    want = pdf.groupby("g")["v"].transform(lambda x: x.fillna(x.median()))
    want = want.fillna(want.median())
    df = spark.createDataFrame([(int(i), g, None if math.isnan(v) else float(v)) for i, g, v in pdf.itertuples(index=False)],
                               "id int, g string, v double")
    got = [v for _, v in rows(missing.fill_group_median(df, "v", ["g"], legacy_null_key=True).select("id", "v"), "id")]
    assert got == pytest.approx(want.tolist())


@pytest.mark.parametrize("chunks", [1, 5, 40])
def test_fill_along_hot_series(spark, chunks):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": range(900), "k": rng.choice(["hot"] * 8 + ["x", "y"], 900), "t": rng.integers(0, 400, 900),
                        "v": np.where(rng.random(900) < 0.7, np.nan, rng.normal(size=900))})
    pdf.loc[(pdf.k == "hot") & (pdf.t < 80), "v"] = np.nan
    s = pdf.sort_values(["t", "id"])
    want = s.assign(v=s.groupby("k")["v"].transform(lambda x: x.ffill().bfill())).sort_values("id")["v"]
    df = spark.createDataFrame([(int(a), b, int(c), None if math.isnan(d) else float(d)) for a, b, c, d in pdf.itertuples(index=False)],
                               "id int, k string, t int, v double").repartition(4)
    got = [r[0] for r in missing.forward_back_fill(df, ["k"], ["t", "id"], ["v"], chunks=chunks).orderBy("id").select("v").collect()]
    assert got == pytest.approx(want.tolist())
    lag = ordered.lag_along(df, ["k"], ["t", "id"], "id", "p", chunks=chunks)
    want_lag = s.groupby("k")["id"].shift().reindex(range(900))
    got_lag = [r[0] for r in lag.orderBy("id").select("p").collect()]
    assert [-1 if x is None else x for x in got_lag] == want_lag.fillna(-1).astype(int).tolist()


def test_quartile_labels_with_ties(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([0, 0, 0, 0, 0, 1, 2, 9])], "i int, v double")
    got = [r[0] for r in scaling.quartile_label(df, ["v"]).orderBy("i").select("v_category").collect()]
    assert got == ["Low"] * 5 + ["High", "Very High", "Very High"]
    four = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "v double")
    pandas = pd.cut(pd.Series([1, 2, 3, 4.0]), [1, 1.75, 2.5, 3.25, 4 + 1e-8], labels=list(scaling.QUARTILE_LABELS), include_lowest=True)
    assert [r[0] for r in scaling.quartile_label(four, ["v"]).orderBy("v").select("v_category").collect()] == pandas.tolist()


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert rows(scaling.minmax(df, ["v"]), F.col("v").desc_nulls_last()) == [(0.0,), (0.0,), (None,)]
    assert rows(scaling.zscore(df, ["v"]), F.col("v").desc_nulls_last()) == [(0.0,), (0.0,), (None,)]


def test_winsorise_equals_numpy(spark):
    rng = np.random.default_rng(5)
    v = np.append(rng.normal(size=200), [30.0, -30.0])
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "i int, v double")
    got = [r[1] for r in scaling.winsorise(df, ["v"], 2.0).orderBy("i").collect()]
    assert got == pytest.approx(np.clip(v, v.mean() - 2 * v.std(), v.mean() + 2 * v.std()).tolist())


def brute_knn(donors, queries, k):
    out = {}
    for q in queries:
        best = sorted((sum((a - b) ** 2 for a, b in zip(q, d[1])), d[0], d[2]) for d in donors)[:k]
        out[q] = sum(b[2] for b in best) / len(best)
    return out


@pytest.mark.parametrize("leaf,tree", [(8, 4096), (10_000, 4096), (4, 4), (8, 2)])
def test_knn_equals_brute_force(spark, monkeypatch, leaf, tree):
    """Many ties, a third of all donors and of all queries on one point, queries far outside; one level of tree, or two."""
    monkeypatch.setattr(neighbours, "LEAF_ROWS", leaf)
    monkeypatch.setattr(neighbours, "TREE_LEAVES", tree)
    monkeypatch.setattr(neighbours, "QUERIES_PER_TASK", 7)
    rng = np.random.default_rng(2)
    pts = [tuple(map(float, p)) for p in rng.integers(0, 12, (400, 2))] + [(3.0, 3.0)] * 200 + [(100.0, -50.0)] * 3
    known = rng.random(len(pts)) < 0.6
    data = [(i, *p, float(rng.normal()) if ok else None) for i, (p, ok) in enumerate(zip(pts, known))]
    df = spark.createDataFrame(data, "id bigint, x double, y double, v double").repartition(6)
    got = {r["id"]: r["v"] for r in neighbours.knn_impute(df, "id", ["x", "y"], "v", 5).collect()}
    assert len(got) == len(data)
    donors = [(i, (x, y), v) for i, x, y, v in data if v is not None]
    want = brute_knn(donors, {(x, y) for _, x, y, v in data if v is None}, 5)
    for i, x, y, v in data:
        assert got[i] == pytest.approx(v if v is not None else want[(x, y)])


def test_reached_leaves_travel_together(monkeypatch):
    """Queries that reach many leaves make few frames, not one for each leaf."""
    pairs = [(np.arange(leaf % 5), leaf) for leaf in range(500)]
    want = [(row, leaf) for rows, leaf in pairs for row in rows.tolist()]
    assert len(list(neighbours._together(iter(pairs)))) == 1
    monkeypatch.setattr(neighbours, "PAIRS_PER_FRAME", 100)
    frames = list(neighbours._together(iter(pairs)))
    assert 5 <= len(frames) <= 10
    assert [pair for rows, leaf in frames for pair in zip(rows.tolist(), leaf.tolist())] == want


def test_leaves_with_few_queries_travel_in_bundles(spark, monkeypatch):
    """A group of a shuffle holds many leaves; a leaf of many queries has groups of its own. The neighbours are the same."""
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 4)
    monkeypatch.setattr(neighbours, "QUERIES_PER_TASK", 160)
    groups = []
    def kept(stats, own=neighbours.measured):
        groups.append(own(stats))
        return groups[-1]
    monkeypatch.setattr(neighbours, "measured", kept)
    rng = np.random.default_rng(4)
    pts = [tuple(map(float, p)) for p in rng.normal(size=(1600, 2)).round(3)] + [(0.5, float(i) / 1000) for i in range(200)]
    data = [(i, *p, float(rng.normal()) if i < 1200 else None) for i, p in enumerate(pts)]
    df = spark.createDataFrame(data, "id bigint, x double, y double, v double").repartition(6)
    got = {r["id"]: r["v"] for r in neighbours.knn_impute(df, "id", ["x", "y"], "v", 5).collect()}
    want = brute_knn([(i, (x, y), v) for i, x, y, v in data[:1200]], {p for p in pts[1200:]}, 5)
    assert all(got[i] == pytest.approx(want[x, y]) for i, x, y, _ in data[1200:])
    held = [g.toPandas() for g in groups if "_bundle" in g.columns]
    assert len(held) == 2
    for g in held:
        alone = g["_bundle"] < 0
        assert g["_bundle"][alone].is_unique and (g["_parts"][~alone] == 1).all()
    assert held[0]["_bundle"].nunique() < 0.5 * len(held[0]) and (held[1]["_bundle"] < 0).any()


def test_rules(spark):
    df = spark.createDataFrame([(1905, None), (1905, 5.0), (1950, None)], "y int, v double")
    assert rows(missing.fill_by_rule(df, "v", F.col("y").between(1900, 1909), 9.0), "y", "v") == [(1905, 5.0), (1905, 9.0), (1950, None)]


@pytest.mark.parametrize("kind", ["t date", "t string"])
def test_ranges_split_a_busy_order_value(spark, kind):
    """Nine of ten rows fall on one order value; no range holds more than a few times its share, whatever the type."""
    df = spark.range(20_000).selectExpr("id", "if(id % 10 = 0, date_add(date'2024-01-01', int(id)), date'2024-06-01') as d")
    df = df.withColumn("t", F.col("d") if "date" in kind else F.col("d").cast("string")).drop("d")
    sizes = [r["count"] for r in ordered.in_ranges(df, [], ["t"], 16).groupBy("_chunk").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 3 * 20_000 / 16


def test_leaves_stay_balanced_when_values_saturate():
    rng = np.random.default_rng(4)
    x = np.column_stack([np.minimum(rng.integers(0, 40, 20_000), 15), rng.random(20_000)]).astype(float)
    dims, cuts = neighbours._split_points(x[:4000], 6)
    sizes = np.bincount(neighbours._leaves(x, dims, cuts, 6), minlength=64)
    assert sizes.max() < 3 * sizes.mean()


def test_leaves_stay_small_at_ten_times_the_donors(spark):
    """With ten times the donors the branches get deeper trees, not larger leaves."""
    rng = np.random.default_rng(5)
    largest = []
    for n, lower in ((4_000, 2), (40_000, 6)):
        x = rng.normal(size=(n, 2))
        dims, cuts = neighbours._split_points(x[:500], 2)
        rows = [(int(b), *map(float, p)) for b, p in zip(neighbours._leaves(x, dims, cuts, 2), x)]
        placed = spark.createDataFrame(rows, "_leaf int, a double, b double")
        trees = neighbours._lower_trees(placed, ["a", "b"], lower, 32 * 2 ** (2 + lower) / n).cache()
        inner = neighbours._in_branches(placed, trees, ["a", "b"], lower)
        assert inner.count() == n
        largest.append(inner.groupBy("_leaf").count().agg(F.max("count")).first()[0])
    assert largest[1] < 1.5 * largest[0]


def test_density_names_constant_groups(spark):
    from tablewright.operators import distributions as dist
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("b", 5.0)], "g string, v double")
    got = dist.kde(df, "v", ["g"], points=5).collect()
    assert [(r["point"], r["x"], r["density"]) for r in got if r["g"] == "b"] == [(None, 5.0, None)]
    assert sum(r["g"] == "a" and r["density"] > 0 for r in got) == 5
