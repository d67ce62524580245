import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tablewright.operators import quantiles
from tablewright.operators.quantiles import exact_quantiles

PROBS = [0, 0.1, 0.25, 0.5, 0.9, 1]


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r["q"] for r in df.collect()}


@pytest.mark.parametrize("ranges", ["1", "8", "200"])
def test_hot_groups_stay_exact(spark, ranges):
    """One group holds a third of the rows, one is missing, one has a single value."""
    rng = np.random.default_rng(3)
    data = [("big", float(v)) for v in rng.exponential(5, 1000).round(2)]
    data += [(None, float(v)) for v in rng.normal(0, 1, 900)] + [("flat", 7.0)] * 800 + [(f"s{i}", float(i)) for i in range(30)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        got = as_dict(exact_quantiles(df, ["v"], PROBS, ["g"], extra={"top": F.max}), "g")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for g in {d[0] for d in data}:
        want = np.quantile([v for k, v in data if k == g], PROBS)
        assert got[(g,)] == pytest.approx(want.tolist(), abs=1e-9)


def test_nan_and_infinite_values_are_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,), (float("inf"),)], "v double")
    assert exact_quantiles(df, ["v"], [0.5]).first().asDict() == {"column": "v", "n": 2, "q": [2.0]}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-20, 20), min_size=12, max_size=60))
def test_any_values(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    want = np.quantile(values, PROBS).tolist()
    assert exact_quantiles(df, ["v"], PROBS).first()["q"] == pytest.approx(want)


def test_brackets_are_narrowed_until_they_fit(spark, monkeypatch):
    """Coarse sketches and little room: several rounds of brackets, the same quantiles."""
    monkeypatch.setattr(quantiles, "SKETCH", 64)
    monkeypatch.setattr(quantiles, "GRID", 100)
    monkeypatch.setattr(quantiles, "LIMIT", 300)
    rng = np.random.default_rng(9)
    data = [("a", float(v)) for v in rng.normal(size=6000)] + [("b", float(v)) for v in rng.integers(0, 5, 2500)] + [("c", float(i)) for i in range(20)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    got = as_dict(exact_quantiles(df, ["v"], PROBS, ["g"]), "g")
    for g in "abc":
        assert got[(g,)] == pytest.approx(np.quantile([v for k, v in data if k == g], PROBS).tolist(), abs=1e-12)


def test_a_missed_rank_is_noticed(spark, monkeypatch):
    """Brackets that are far too narrow are drawn again."""
    monkeypatch.setattr(quantiles, "SKETCH", 8)
    real, calls = quantiles._brackets, []
    values = np.random.default_rng(1).normal(size=5000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)

    def far_off_at_first(ranks, parts, width):
        calls.append(width)
        far = [c for i in range(len(ranks)) for c in (F.lit(1e6).alias(f"_lo{i}"), F.lit(1e7).alias(f"_hi{i}"))]
        return far if len(calls) == 1 else real(ranks, parts, width)

    monkeypatch.setattr(quantiles, "_brackets", far_off_at_first)
    assert exact_quantiles(df, ["v"], PROBS).first()["q"] == pytest.approx(np.quantile(values, PROBS).tolist(), abs=1e-12)
    assert len(calls) == 2
