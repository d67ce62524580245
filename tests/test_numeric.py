import html.parser
import json
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.operators import network, profiling, regression as rg
from tablewright.session import small_frame
from tablewright.sources import feature_pages, html as pages


# --- correlation of wide frames

def test_wide_frame_with_gaps_equals_pairwise_corr(spark):
    draw = np.random.default_rng(1)
    n, k = 400, 500
    x = draw.normal(size=(n, k)) @ (np.eye(k) + 0.05 * draw.normal(size=(k, k))) + 1e6 * np.arange(k)
    x[draw.random((n, k)) < 0.2] = np.nan
    x[:, 7], x[:, 8] = 3.0, np.nan
    x[1:, 9] = np.nan
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(k)])
    df = spark.createDataFrame(frame).repartition(5)
    got = profiling.correlation_matrix(df).toPandas().pivot(index="a", columns="b", values="r").loc[frame.columns, frame.columns]
    want = frame.corr()
    want.iloc[[7, 8, 9]] = np.nan
    want.iloc[:, [7, 8, 9]] = np.nan
    np.testing.assert_allclose(got.to_numpy(float), want.to_numpy(), atol=1e-7)


def test_blocks_equal_expressions(spark, monkeypatch):
    df = small_frame(spark, [(float(i % 7), float(i * i % 11) if i % 3 else None, 5.0, float("nan") if i % 4 == 0 else float(i)) for i in range(200)],
                     "a double, b double, c double, `d.e` double").repartition(3)
    exact = {(r.a, r.b): r.r for r in profiling.correlation_matrix(df).collect()}
    monkeypatch.setattr(profiling, "WIDE", 1)
    blocks = {(r.a, r.b): r.r for r in profiling.correlation_matrix(df).collect()}
    assert exact.keys() == blocks.keys()
    for key, r in exact.items():
        assert blocks[key] == (None if r is None else pytest.approx(r, abs=1e-12)), key
    assert profiling.correlation_matrix(df.limit(0)).where("r is not null").isEmpty()


# --- least squares

def test_qr_where_covariances_fail(spark):
    draw = np.random.default_rng(2)
    n = 3000
    a = draw.normal(size=n) + 100
    x = np.column_stack([a, a + 1e-7 * draw.normal(size=n), draw.normal(size=n)])
    y = 2 + 3 * x[:, 0] - 5 * x[:, 1] + x[:, 2]
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=["a", "b", "c", "y"])).repartition(7)
    m = rg.ols_qr(df, ["a", "b", "c"], "y").first()
    assert m.coef == pytest.approx([3, -5, 1], abs=1e-3) and m.intercept == pytest.approx(2, abs=1e-2) and m.n == n
    design = np.column_stack([np.ones(n), x])
    assert m.cond == pytest.approx(np.linalg.cond(design), rel=1e-2) and m.cond > 1e9
    assert m.r2 == pytest.approx(1, abs=1e-9)


def test_qr_by_group_equals_moments(spark):
    draw = np.random.default_rng(3)
    rows = [("ab"[i % 2] if i % 5 else None, float(u), float(v), float(2 * u - v + w)) for i, (u, v, w) in enumerate(draw.normal(size=(600, 3)))]
    rows += [("a", None, 1.0, 1.0), ("b", float("inf"), 1.0, 1.0)]
    df = small_frame(spark, rows, "g string, u double, v double, y double").repartition(4)
    for intercept in (True, False):
        want = {r.g: r for r in rg.ols(df, ["u", "v"], "y", ["g"], intercept).collect()}
        got = {r.g: r for r in rg.ols_qr(df, ["u", "v"], "y", ["g"], intercept).collect()}
        assert got.keys() == want.keys()
        for g, r in got.items():
            assert (r.n, r.intercept, r.rss) == (want[g].n, pytest.approx(want[g].intercept, abs=1e-9), pytest.approx(want[g].rss))
            assert r.coef == pytest.approx(want[g].coef) and r.r2 == pytest.approx(want[g].r2)


def test_qr_of_redundant_columns_takes_the_least_coefficients(spark):
    df = small_frame(spark, [(float(i), float(i), 4.0 * i) for i in range(20)], "a double, b double, y double")
    m = rg.ols_qr(df, ["a", "b"], "y").first()
    assert m.coef == pytest.approx([2, 2]) and m.intercept == pytest.approx(0, abs=1e-9)
    assert rg.ols_qr(df.limit(0), ["a"], "y").count() == 0


# --- network

def test_gradient_is_the_difference_quotient():
    draw = np.random.default_rng(4)
    layers = [(draw.normal(size=(a, b)), draw.normal(size=b)) for a, b in ((3, 5), (5, 4), (4, 1))]
    x, y = draw.normal(size=(30, 3)), draw.normal(size=30)
    for masks in (None, [(draw.random((30, w.shape[1])) > 0.3) / 0.7 for w, _ in layers[:-1]]):
        _, g = network.gradient(layers, x, y, masks)
        flat = np.concatenate([np.concatenate((w.ravel(), b)) for w, b in layers])
        for i in range(len(flat)):
            ends = []
            for sign in (1, -1):
                moved = flat.copy()
                moved[i] += sign * 1e-6
                ends.append(np.square(network.forward(network._split(moved, layers), x, masks)[-1][:, 0] - y).sum())
            assert g[i] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-3)


def test_network_stops_and_keeps_the_best(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(2000, 2))
    df = spark.createDataFrame(pd.DataFrame({"id": range(2000), "a": x[:, 0], "b": x[:, 1], "y": np.abs(x[:, 0]) * 3 + x[:, 1] + 50})).withColumn(
        "held", F.col("id") % 5 == 0).repartition(4)
    model = network.fit(df, ["a", "b"], "y", "held", (32, 16), epochs=25, steps=2, rate=0.02, dropout=0.0, patience=3)
    assert min(model.losses) < 0.1 * model.losses[0] and len(model.losses) <= 25
    out = model.predict(df.withColumn("a", F.when(F.col("id") > 0, F.col("a"))), "p")
    assert out.count() == 1999
    r = out.agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("e"), F.var_pop("y").alias("v")).first()
    assert r.e < 0.1 * r.v
    still = network.fit(df.withColumn("y", F.lit(7.0)), ["a"], "y", "held", (4,), epochs=30, steps=1, rate=0.0, dropout=0.0, patience=2)
    assert len(still.losses) == 3  # the first, and two that are no better
    with pytest.raises(ValueError):
        network.fit(df.limit(0), ["a"], "y", "held")


def test_network_steps_are_single_jobs(spark):
    """A step runs its tasks side by side, however many files hold the rows: the number of jobs does not grow with them."""
    df = spark.range(4000).select(F.rand(3).alias("a"), (F.col("id") % 7).cast("double").alias("y"), (F.col("id") % 5 == 0).alias("held"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        jobs = []
        for epochs in (1, 3):
            spark.sparkContext.setJobGroup(f"network-{epochs}", "a fit")
            model = network.fit(df.repartition(8), ["a"], "y", "held", (4,), epochs=epochs, steps=2, patience=9)
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"network-{epochs}")))
            assert len(model.losses) == epochs
        assert jobs[1] - jobs[0] == 2 * 3  # two steps and the validation rows, in each of two more epochs
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# --- HTML tables

class ByParser(html.parser.HTMLParser):
    """Rows of the first table with the id, nested ones as text of their cell."""

    def __init__(self, table_id):
        super().__init__()
        self.id, self.depth, self.inside, self.rows, self.cell = table_id, 0, None, [], None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            if self.inside is None and dict(attrs).get("id") == self.id:
                self.inside = self.depth
        if self.inside == self.depth:
            if tag == "tr":
                self.rows.append([])
            if tag in ("td", "th"):
                self.cell = [tag, ""]
                self.rows[-1].append(self.cell)

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr") and self.inside == self.depth:
            self.cell = None
        if tag == "table":
            if self.inside == self.depth:
                self.inside, self.cell = -1, None
            self.depth -= 1

    def handle_data(self, data):
        if self.cell is not None and self.inside != -1:
            self.cell[1] += data


PAGES = [
    '<table id=t><tr><th>a<th>b</tr><tr><td>1</td><td>x &amp; y</td></tr></table>',
    "<p>no</p><TABLE class='k' ID='t'><TR><TD>1<TD>2<TR><TD>3<TD>&lt;4&gt;</TABLE>",
    '<table id="t"><tr><td>out<table><tr><td>in</td><td>ner</td></tr></table></td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>',
    '<table id="o"><tr><td><table id="t"><tr><td>5</td><td>6</td></tr></table></td></tr></table>',
    '<!-- <table id="t"><tr><td>no</td></tr></table> --><table id="t" title="a > b"><tr><td>7</td><td><b>8</b> </td></tr></table>',
    '<script>var s = "<table id=t>";</script><table id="t"><tr><td>9</td><td></td></tr></table><table id="t"><tr><td>no</td><td>no</td></tr></table>',
    '<table id="t"><tr><td>caf&eacute;</td><td>&#36;3&nbsp;</td></tr>', '<table id="tt"><tr><td>no</td></tr></table>', "", None, "<table><tr><td>1",
]


@pytest.mark.parametrize("page", PAGES)
def test_tables_as_the_parser_reads_them(page):
    by = ByParser("t")
    by.feed(page or "")
    by.close()
    want = [[(tag, text.strip() or None) for tag, text in row] for row in by.rows]
    got = pages.scan_table(page, "t")
    assert [[c[:2] for c in row] for row in got or []] == want
    assert (got is None) == (by.inside is None)


def test_spans_are_repeated(spark):
    page = '<table id="t"><tr><td rowspan=2>a</td><td colspan="2">b</td></tr><tr><td>c</td><td>d</td></tr><tr><td colspan=99999>e</td></tr></table>'
    rows = pages.spread(pages.scan_table(page, "t"))
    assert [[c[1] for c in r] for r in rows[:2]] == [["a", "b", "b"], ["a", "c", "d"]] and len(rows[2]) == pages.MOST_SPAN
    df = small_frame(spark, [(1, page), (2, None), (3, "<table id=t><tr><td>1<td>2<td>3</table>")], "id int, html string")
    got = [tuple(r) for r in pages.table_rows(df, "html", "t", ["x", "y", "z"], ["id"], spans=True).orderBy("id", "row").collect()]
    assert got == [(1, 0, "a", "b", "b"), (1, 1, "a", "c", "d"), (3, 0, "1", "2", "3")]
    assert [tuple(r) for r in pages.rejected_rows(df, "html", "t", ["x", "y", "z"], ["id"]).orderBy("id", "row").collect()] == [(1, 0, 2), (1, 1, 2), (1, 2, 1)]


# --- paged features

def landed(folder, pages_of, limit):
    for i, features in enumerate(pages_of):
        (folder / f"offset={i * limit}").mkdir()
        (folder / f"offset={i * limit}" / "part-0.txt").write_text(json.dumps({"features": [{"attributes": a} for a in features]}) + "\n")


def test_pages_end_at_the_first_empty_one(spark, tmp_path):
    feature_pages.register(spark)
    landed(tmp_path, [[{"yr": 2000 + k, "st": "TX", "loss": k}, {"yr": "1999", "st": None}] for k in range(9)] + [[], [], []], 2)
    (tmp_path / "_SUCCESS").write_text("")
    df = spark.read.format("feature_pages").schema("yr int, st string, loss double").option("path", str(tmp_path)).option("limit", 2).option("pagesPerTask", 2).load()
    assert df.count() == 18 and df.rdd.getNumPartitions() == 5
    assert sorted(tuple(r) for r in df.where("yr >= 2007").collect()) == [(2007, "TX", 7.0), (2008, "TX", 8.0)]
    assert df.where("st is null").count() == 9 and df.where("yr in (1999, 2003)").count() == 10 and df.where("length(st) = 2 and yr < 2001").count() == 1


def test_year_condition_reaches_the_reader(spark, tmp_path):
    feature_pages.register(spark)
    landed(tmp_path, [[{"yr": 2000}, {"yr": 2010}]], 2)
    df = spark.read.format("feature_pages").schema("yr int").option("path", str(tmp_path)).option("limit", 2).load().where("yr = 2010")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan) and "BatchScan feature_pages" in plan
    assert [r.yr for r in df.collect()] == [2010]


def test_json_values_become_plain_types():
    from pyspark.sql import types as T
    kinds = [T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType()]
    assert [[feature_pages.cast(v, k) for k in kinds] for v in (1, "2", 2.5, True, None, [1], "x", float("inf"))] == [
        [1, 1.0, "1", None], [2, 2.0, "2", None], [None, 2.5, "2.5", None], [None, None, "true", True], [None] * 4, [None] * 4,
        [None, None, "x", None], [None, float("inf"), "Infinity", None]]


def test_too_many_levels_are_told(spark):
    from tablewright.operators import joining, reshape
    df = spark.range(30).selectExpr("cast(id as string) as a", "id % 3 as b")
    assert len(reshape.levels_of(df, "a", 30)) == 30 and reshape.levels_of(df, "b") == [0, 1, 2]
    with pytest.raises(ValueError, match="more than 29 levels"):
        reshape.levels_of(df, "a", 29)
    assert joining.category_grid(df, ["a", "b"], "y", 1, 2, most=3).count() == 180
    with pytest.raises(Exception, match="more than 2 levels"):
        joining.category_grid(df, ["a", "b"], "y", 1, 2, most=2).count()
