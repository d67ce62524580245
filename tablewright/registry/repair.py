"""Imputation, outliers, scaling and binning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import filters, missing, neighbours, scaling
from tablewright.registry.common import GAPS, gaps, query, r, rounded
from tablewright.sources.tables import load


@query("global_median_fill", f"""WITH {GAPS} SELECT event_id, round(coalesce(v, (SELECT median(v) FROM gaps)), 6) AS v,
  round(coalesce(w, (SELECT median(w) FROM gaps)), 6) AS w FROM gaps""")
def global_median_fill(spark, sf):
    return missing.fill_global_median(gaps(spark, sf), ["v", "w"]).select("event_id", r("v", 6).alias("v"), r("w", 6).alias("w"))


GROUP_FILL = """, m AS (SELECT kind, median(v) AS gm FROM gaps WHERE kind IS NOT NULL GROUP BY kind),
f AS (SELECT event_id, gaps.kind, {own} AS fv FROM gaps LEFT JOIN m ON gaps.kind = m.kind)
SELECT event_id, kind, round(coalesce(fv, (SELECT median(fv) FROM f)), 6) AS v FROM f"""


@query("group_median_fill", f"WITH {GAPS}" + GROUP_FILL.format(own="coalesce(v, gm)"))
def group_median_fill(spark, sf):
    return missing.fill_group_median(gaps(spark, sf), "v", ["kind"]).select("event_id", "kind", r("v", 6).alias("v"))


@query("group_median_fill_legacy", f"WITH {GAPS}" + GROUP_FILL.format(
    own="CASE WHEN gaps.kind IS NOT NULL THEN coalesce(v, gm) END"))
def group_median_fill_legacy(spark, sf):
    out = missing.fill_group_median(gaps(spark, sf), "v", ["kind"], legacy_null_key=True)
    return out.select("event_id", "kind", r("v", 6).alias("v"))


@query("coalesce_cascade", f"""WITH {GAPS}, c AS (SELECT event_id, kind, coalesce(w, v) AS x FROM gaps),
m AS (SELECT kind, median(x) AS gm FROM c WHERE kind IS NOT NULL GROUP BY kind),
f AS (SELECT event_id, coalesce(x, gm) AS x FROM c LEFT JOIN m USING (kind))
SELECT event_id, round(coalesce(x, (SELECT median(x) FROM f)), 6) AS w FROM f""")
def coalesce_cascade(spark, sf):
    return missing.fill_cascade(gaps(spark, sf), "w", ["v"], ["kind"]).select("event_id", r("w", 6).alias("w"))


@query("rule_fill", f"""WITH {GAPS} SELECT event_id, CASE WHEN v IS NULL AND h BETWEEN 0 AND 8 THEN 76.5 ELSE v END AS v,
  coalesce(kind, 'unknown') AS kind, CASE WHEN h < 12 THEN 'morning' WHEN kind IN ('click', 'view') THEN 'active' ELSE 'other' END AS part
FROM gaps""")
def rule_fill(spark, sf):
    g = missing.fill_by_rule(gaps(spark, sf), "v", F.col("h").between(0, 8), 76.5)
    g = missing.masked(g.withColumn("part", F.lit("other")), "part", F.coalesce(F.col("kind").isin("click", "view"), F.lit(False)), "active")
    g = missing.masked(g, "part", F.col("h") < 12, "morning")
    return missing.fill_constant(g, {"kind": "unknown"}).select("event_id", "v", "kind", "part")


@query("ffill_bfill", f"""WITH {GAPS} SELECT event_id, coalesce(
  last_value(v IGNORE NULLS) OVER (PARTITION BY kind ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (PARTITION BY kind ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v
FROM gaps""")
def ffill_bfill(spark, sf):
    return missing.forward_back_fill(gaps(spark, sf), ["kind"], ["ts", "event_id"], ["v"], chunks=16).select("event_id", "v")


@query("ffill", f"""WITH {GAPS} SELECT event_id,
  last_value(w IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS w
FROM gaps""")
def ffill(spark, sf):
    return missing.forward_fill(gaps(spark, sf), ["user_id"], ["ts", "event_id"], ["w"]).select("event_id", "w")


@query("drop_incomplete", f"WITH {GAPS} SELECT event_id, kind, v, w FROM gaps WHERE kind IS NOT NULL AND v IS NOT NULL AND w IS NOT NULL")
def drop_incomplete(spark, sf):
    return filters.complete_rows(gaps(spark, sf).select("event_id", "kind", "v", "w"))


@query("drop_empty", f"WITH {GAPS} SELECT kind, v, w FROM gaps WHERE kind IS NOT NULL OR v IS NOT NULL OR w IS NOT NULL")
def drop_empty(spark, sf):
    return filters.drop_empty_rows(gaps(spark, sf).select("kind", "v", "w"))


@query("finite_only", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0")
def finite_only(spark, sf):
    x = load(spark, sf, "lineitem")
    q = F.when(F.col("l_discount") > 0, F.col("l_tax")).otherwise(F.lit(float("inf")))
    return filters.finite_only(x.withColumn("q", q), "q").select("l_orderkey", "l_linenumber")


@query("min_series_length", """SELECT user_id, COUNT(*) AS n FROM (SELECT user_id FROM events WHERE value < 50) GROUP BY user_id HAVING COUNT(*) >= 40""")
def min_series_length(spark, sf):
    e = load(spark, sf, "events").withColumn("x", F.when(F.col("value") < 50, F.col("value")))
    return filters.long_series_only(e, ["user_id"], "x", 40).groupBy("user_id").agg(F.count("*").alias("n"))


def _fences(table: str, keys: str, col: str) -> str:
    return (f"SELECT {keys} '{col}' AS \"column\", round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, "
            f"round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper FROM (SELECT {keys} "
            f"quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {table} GROUP BY ALL)")


@query("iqr_fences", " UNION ALL ".join(_fences("lineitem", "", c) for c in ("l_quantity", "l_extendedprice", "l_tax")))
def iqr_fences(spark, sf):
    f = scaling.iqr_fences(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
    return rounded(f, 6, "q1", "q3", "iqr", "lower", "upper")


@query("iqr_fences_by_group", _fences("events", "event_type,", "value"))
def iqr_fences_by_group(spark, sf):
    return rounded(scaling.iqr_fences(load(spark, sf, "events"), ["value"], ["event_type"]), 6, "q1", "q3", "iqr", "lower", "upper")


@query("sigma_report", f"WITH {GAPS} " + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", round(any_value(m), 6) AS mean, round(any_value(s), 6) AS std, round(any_value(m - 3 * s), 6) AS lower,
  round(any_value(m + 3 * s), 6) AS upper, COUNT(*) FILTER ({c} < m - 3 * s OR {c} > m + 3 * s) AS outliers,
  round(100.0 * COUNT(*) FILTER ({c} < m - 3 * s OR {c} > m + 3 * s) / COUNT({c}), 6) AS outlier_pct,
  min({c}) AS min, max({c}) AS max FROM gaps, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM gaps)""" for c in ("v", "w")))
def sigma_report(spark, sf):
    out = scaling.sigma_report(gaps(spark, sf), ["v", "w"])
    return rounded(out, 6, "mean", "std", "lower", "upper", "outlier_pct")


@query("outside_sigma", """SELECT event_id, value, CASE WHEN value < m - 3 * s THEN 'below' ELSE 'above' END AS side FROM events,
(SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) WHERE value < m - 3 * s OR value > m + 3 * s""")
def outside_sigma(spark, sf):
    return filters.outside_sigma(load(spark, sf, "events").select("event_id", "value"), "value")


@query("winsorise", """SELECT c_custkey, round(greatest(least(greatest(b, m - 1.5 * s), m + 1.5 * s), 0), 6) AS c_acctbal
FROM (SELECT c_custkey, c_acctbal AS b FROM customer), (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)""")
def winsorise(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return rounded(scaling.winsorise(c, ["c_acctbal"], 1.5, floor_zero=["c_acctbal"]), 6, "c_acctbal")


@query("winsorise_gaps", f"""WITH {GAPS}, s AS (SELECT avg(v) AS mv, stddev_pop(v) AS sv, avg(w) AS mw, stddev_pop(w) AS sw FROM gaps)
SELECT event_id, CASE WHEN v IS NOT NULL THEN round(least(greatest(v, mv - 3 * sv), mv + 3 * sv), 6) END AS v,
  CASE WHEN w IS NOT NULL THEN round(least(greatest(w, mw - 3 * sw), mw + 3 * sw), 6) END AS w FROM gaps, s""")
def winsorise_gaps(spark, sf):
    return rounded(scaling.winsorise(gaps(spark, sf), ["v", "w"]).select("event_id", "v", "w"), 6, "v", "w")


@query("floor_at_zero", "SELECT c_custkey, greatest(c_acctbal, 0.0) AS c_acctbal FROM customer")
def floor_at_zero(spark, sf):
    return scaling.floor_at(load(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query("minmax", """WITH l AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_extendedprice) AS c, max(l_extendedprice) AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, round((l_quantity - a) / (b - a), 6) AS l_quantity, round((l_extendedprice - c) / (d - c), 6) AS l_extendedprice
FROM lineitem, l""")
def minmax(spark, sf):
    x = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return rounded(scaling.minmax(x, ["l_quantity", "l_extendedprice"]), 6, "l_quantity", "l_extendedprice")


@query("minmax_fit_on_part", """WITH l AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders WHERE year(o_orderdate) < 1999)
SELECT o_orderkey, round((o_totalprice - a) / (b - a), 6) AS o_totalprice FROM orders, l""")
def minmax_fit_on_part(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return rounded(scaling.minmax(o, ["o_totalprice"], fit_on=F.year("o_orderdate") < 1999), 6, "o_totalprice").drop("o_orderdate")


@query("zscore", """SELECT p_partkey, round((p_retailprice - m) / s, 6) AS p_retailprice FROM part,
(SELECT avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS s FROM part)""")
def zscore(spark, sf):
    return rounded(scaling.zscore(load(spark, sf, "part").select("p_partkey", "p_retailprice"), ["p_retailprice"]), 6, "p_retailprice")


@query("quartile_label", """WITH q AS (SELECT quantile_cont(l_quantity, [0.25, 0.5, 0.75]) AS a, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_quantity <= a[1] THEN 'Low' WHEN l_quantity <= a[2] THEN 'Medium' WHEN l_quantity <= a[3] THEN 'High' ELSE 'Very High' END AS l_quantity_category,
  CASE WHEN l_extendedprice <= b[1] THEN 'Low' WHEN l_extendedprice <= b[2] THEN 'Medium' WHEN l_extendedprice <= b[3] THEN 'High' ELSE 'Very High' END AS l_extendedprice_category
FROM lineitem, q""")
def quartile_label(spark, sf):
    x = scaling.quartile_label(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return x.select("l_orderkey", "l_linenumber", "l_quantity_category", "l_extendedprice_category")


KNN_SQL = f"""WITH {GAPS}, p AS (SELECT a.event_id, b.v, row_number() OVER (PARTITION BY a.event_id ORDER BY
  (a.user_id - b.user_id) * (a.user_id - b.user_id) + (a.h - b.h) * (a.h - b.h) + (a.k - b.k) * (a.k - b.k), b.event_id) AS rn
  FROM gaps a JOIN gaps b ON a.v IS NULL AND b.v IS NOT NULL)
SELECT event_id, round(avg(v), 6) AS v FROM p WHERE rn <= 5 GROUP BY 1
UNION ALL SELECT event_id, round(v, 6) FROM gaps WHERE v IS NOT NULL"""


@query("knn_impute", KNN_SQL)
def knn_impute(spark, sf):
    out = neighbours.knn_impute(gaps(spark, sf), "event_id", ["user_id", "h", "k"], "v", 5)
    return out.select("event_id", r("v", 6).alias("v"))

