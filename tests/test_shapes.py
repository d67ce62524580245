import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from tablewright.functions import dates
from tablewright.operators import distributions as dist, filters, joining, panel as pn, profiling as prof, ranking, reshape, schema


def test_headers(spark):
    df = spark.createDataFrame([(1, 2)], "`Population (historical)Â ` int, ` Year` int")
    assert schema.normalise_headers(df).columns == ["Population_historical", "Year"]


def test_dates(spark):
    df = spark.createDataFrame([("2005Q3", "IV", "Jan 2001", dt.date(2024, 10, 1)), ("2005Q9", "V", "bad", dt.date(2024, 12, 31))],
                               "q string, r string, m string, d date")
    got = rows(df.select(dates.quarter_text_start(F.col("q")), dates.roman_quarter(F.col("r")), dates.month_text(F.col("m")),
                         dates.quarter_end(F.col("d")), dates.next_quarter(F.col("d")),
                         F.element_at(dates.future_quarter_ends(F.col("d"), 40), -1),
                         dates.quarter_from_index(dates.quarter_index(F.col("d")))))
    assert got[0] == (dt.date(2005, 7, 1), 4, dt.date(2001, 1, 1), dt.date(2024, 12, 31), dt.date(2025, 1, 1),
                      dt.date(2034, 12, 31), dt.date(2024, 10, 1))
    assert got[1][:3] == (None, None, None)


def test_growth_rules(spark):
    df = spark.createDataFrame([("a", 2, 4.0), ("a", 1, 2.0), ("a", 3, None), ("a", 4, 0.0), ("a", 5, 3.0), ("b", 1, 7.0)],
                               "s string, t int, v double")
    g = {(r["s"], r["t"]): r["growth"] for r in pn.growth(df, ["s"], "t", "v", first=0.0).collect()}
    assert g == {("a", 1): 0.0, ("a", 2): 1.0, ("a", 3): 0.0, ("a", 4): -1.0, ("a", 5): None, ("b", 1): 0.0}


def test_year_over_year_survives_gaps(spark):
    q = [dt.date(2020, 1, 1), dt.date(2020, 4, 1), dt.date(2021, 1, 1), dt.date(2021, 7, 1)]
    df = spark.createDataFrame([("a", d, float(i + 1)) for i, d in enumerate(q)], "s string, d date, v double")
    assert [r["yoy"] for r in pn.year_over_year(df, ["s"], "d", "v").orderBy("d").collect()] == [None, None, 200.0, None]


def test_shares(spark):
    df = spark.createDataFrame([(1, "a", 30.0), (1, "b", 70.0), (2, "a", None), (2, "b", None)], "t int, s string, v double")
    got = {(r["t"], r["s"]): r["share"] for r in pn.share_of_total(df, "t", "v").collect()}
    assert got == {(1, "a"): 30.0, (1, "b"): 70.0, (2, "a"): None, (2, "b"): None}
    assert {r["total"] for r in pn.period_total(df.where("t = 2"), "t", "v").collect()} == {0.0}


def test_pivot_rejects_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], "i int, c string, v double")
    with pytest.raises(PySparkException, match="duplicate entry"):
        reshape.pivot(df, ["i"], "c", "v", ["a"]).collect()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.tuples(st.integers(0, 5), st.sampled_from("abc")), st.integers(-9, 9), min_size=1))
def test_pivot_and_back(spark, cells):
    df = spark.createDataFrame([(i, c, float(v)) for (i, c), v in cells.items()], "i int, variable string, value double")
    back = reshape.unpivot(reshape.pivot(df, ["i"], "variable", "value", list("abc")), ["i"], list("abc")).where("value is not null")
    assert sorted(rows(back)) == sorted(rows(df))


def test_dummies_and_back(spark):
    df = spark.createDataFrame([(1, "x_1", "p"), (2, "y", "q"), (3, "x_1", "q")], "i int, a string, b string")
    wide = reshape.dummies(df, ["a", "b"])
    assert wide.columns == ["i", "a_x_1", "a_y", "b_p", "b_q"]
    assert sorted(rows(reshape.undummies(reshape.undummies(wide, "a", "a"), "b", "b").select("i", "a", "b"))) == sorted(rows(df))
    with pytest.raises(PySparkException, match="not one-hot"):
        reshape.undummies(wide.withColumn("a_y", F.lit(1)), "a", "a").collect()


def test_joins(spark):
    fact = spark.createDataFrame([(1, "k"), (2, None), (3, "z")], "i int, k string")
    dim = spark.createDataFrame([("k", 10)], "k string, n int")
    assert rows(joining.lookup(fact, dim, "k").select("i", "n"), "i") == [(1, 10), (2, None), (3, None)]
    with pytest.raises(PySparkException, match="duplicate lookup key"):
        joining.lookup(fact, dim.union(dim), "k").collect()
    names = {"South": "North", "North": "South"}
    assert fact.select(joining.map_values(F.lit("South"), names)).first()[0] == "North"
    frames = [spark.createDataFrame([(t,) for t in r], "t int") for r in (range(0, 6), range(3, 9))]
    assert [[x[0] for x in rows(f, "t")] for f in joining.common_range(frames, "t")] == [[3, 4, 5], [3, 4, 5]]


def test_many_to_many_totals_equal_the_join(spark):
    a = spark.createDataFrame([(1, 2), (1, 3), (2, 4)], "y int, p int")
    b = spark.createDataFrame([(1, 10), (1, 20), (1, 30), (2, 7), (3, 1)], "y int, q int")
    want = a.join(b, "y").groupBy("y").agg(F.count("*"), F.sum("p"), F.sum("q"))
    assert rows(joining.many_to_many_totals(a, b, "y", "p", "q"), "y") == rows(want, "y")


def test_backfill(spark):
    have = spark.createDataFrame([("A", 1, 2020)], "Country string, pop int, Year int")
    listed = spark.createDataFrame([("A", "A"), ("B", "Bee"), ("C", "C")], "Country string, Entity string")
    pops = spark.createDataFrame([("B", 5)], "k string, pop int")
    out = joining.backfill_missing(have, listed, "Country", [(pops, "k", "Country")], {"Year": F.lit(2023)})
    assert rows(out, "Country") == [("A", 1, 2020), ("B", 5, 2023), ("C", None, 2023)]


def test_three_way_keeps_the_size(spark):
    flat = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (9, "d")], "y int, n string")
    one = spark.createDataFrame([(1, 5), (2, 6)], "y int, v int")
    assert rows(joining.three_way_join(flat, one, one, "y"), "n") == [(1, "a", 5, 5), (1, "b", 5, 5), (2, "c", 6, 6)]


def test_histogram_counts_everything(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 0.5, 1, 9.99, 10, 10)] + [(None,)], "v double")
    got = rows(dist.histogram(df, "v", 10), "bin")
    assert [r[3] for r in got] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 3] and got[-1][2] == 10.0
    flat = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert sum(r[3] for r in rows(dist.histogram(flat, "v", 4))) == 2


def test_duplicates_and_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None)], "i int, s string")
    assert prof.duplicate_count(df).first()["duplicates"] == 3
    odd = spark.createDataFrame([(float("inf"),), (-1.0,), (float("nan"),)], "v double")
    assert prof.value_checks(odd, ["v"]).first().asDict() == {
        "column": "v", "any_infinite": True, "any_negative": True, "negative": 1, "positive": 0, "min": -1.0, "max": -1.0}


def test_describe_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    assert sorted(rows(prof.describe(df, ["a", "b"]))) == [
        ("a", 2, 2.0, pytest.approx(2 ** 0.5), 1.0, 1.5, 2.0, 2.5, 3.0), ("b", 0, *[None] * 7)]


def test_stability_and_rank(spark):
    g = spark.createDataFrame([(f"s{i}", float(v)) for i in range(4) for v in (i, i + i * i)], "k string, g double")
    got = {r["k"]: r["stability"] for r in ranking.stability_classes(g, "k", "g", 2).collect()}
    assert got == {"s0": "Other", "s1": "Other", "s2": "Volatile", "s3": "Volatile"}
    top = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None)], "k string, v double")
    assert rows(ranking.ranked(top, 2, "v", "k").select("rank", "k"), "rank") == [(1, "a"), (2, "b")]


def test_series_length_ignores_non_finite(spark):
    df = spark.createDataFrame([("a", float("nan"))] * 9 + [("a", 1.0)] + [("b", 1.0)] * 10, "s string, v double")
    assert {r["s"] for r in filters.long_series_only(df, ["s"], "v", 10).collect()} == {"b"}


def test_result_does_not_depend_on_partitions(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("g"), (F.col("id") * 37 % 101).cast("double").alias("v"))
    a, b = (sorted(map(tuple, dist.box_stats(d, "v", ["g"]).collect())) for d in (df.coalesce(1), df.repartition(13)))
    assert a == b
