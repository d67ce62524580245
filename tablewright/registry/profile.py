"""Profiles, distributions and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import distributions as dist, filters, profiling as prof, schema
from tablewright.registry.common import GAPS, PANEL, gaps, panel, query, rounded
from tablewright.sources.tables import load

DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _union(template: str, cols) -> str:
    return " UNION ALL ".join(template.replace("{c}", c) for c in cols)


@query("null_audit", f"""WITH {GAPS} {_union('''
SELECT '{c}' AS "column", COUNT(*) AS "rows", COUNT({c}) AS present, COUNT(*) - COUNT({c}) AS missing,
       round(COUNT({c}) / CAST(COUNT(*) AS DOUBLE), 6) AS completeness FROM gaps''', ["event_id", "ts", "user_id", "k", "kind", "v", "w", "h", "value"])}""")
def null_audit(spark, sf):
    return rounded(prof.null_audit(gaps(spark, sf)), 6, "completeness")


@query("null_columns", f"""WITH {GAPS} SELECT "column", missing FROM ({_union('''
SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing FROM gaps''', ["event_id", "ts", "user_id", "k", "kind", "v", "w", "h", "value"])}) WHERE missing > 0""")
def null_columns(spark, sf):
    return prof.columns_with_nulls(gaps(spark, sf)).select("column", "missing")


DESCRIBE = """SELECT '{c}' AS "column", COUNT({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
  round(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM """
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_exact", _union(DESCRIBE + "lineitem", MEASURES))
def describe_exact(spark, sf):
    x = load(spark, sf, "lineitem")
    cols = schema.columns_of(x, "float")
    return rounded(prof.describe(x, cols), 4, "mean", "std", "q25", "q50", "q75")


@query("describe_by_group", f"""WITH {GAPS} SELECT kind, 'v' AS "column", COUNT(v) AS "count", round(avg(v), 4) AS mean,
  round(stddev_samp(v), 4) AS std, min(v) AS min, round(quantile_cont(v, 0.25), 4) AS q25, round(quantile_cont(v, 0.5), 4) AS q50,
  round(quantile_cont(v, 0.75), 4) AS q75, max(v) AS max FROM gaps GROUP BY kind""")
def describe_by_group(spark, sf):
    return rounded(prof.describe(gaps(spark, sf), ["v"], ["kind"]), 4, "mean", "std", "q25", "q50", "q75")


@query("basic_stats", """SELECT min(o_totalprice) AS min, max(o_totalprice) AS max, round(avg(o_totalprice), 4) AS mean,
  round(median(o_totalprice), 4) AS median, round(stddev_samp(o_totalprice), 4) AS std FROM orders""")
def basic_stats(spark, sf):
    return rounded(prof.basic_stats(load(spark, sf, "orders"), "o_totalprice"), 4, "mean", "median", "std")


@query("distinct_counts", _union("""SELECT '{c}' AS "column", COUNT(DISTINCT {c}) AS "distinct" FROM lineitem""",
                                 ["l_returnflag", "l_linestatus"]))
def distinct_counts(spark, sf):
    return prof.distinct_counts(load(spark, sf, "lineitem"))


# some rows twice, so that whole-row duplicates occur
TWICE = "(SELECT * FROM {t} UNION ALL SELECT * FROM {t} WHERE {when})"


def twice(df, when):
    return df.unionByName(df.where(when))


@query("dup_count", f"""SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicates, CAST(SUM(n) AS BIGINT) AS "rows" FROM (
  SELECT COUNT(*) AS n FROM {TWICE.format(t="lineitem", when="l_orderkey % 7 = 0")} GROUP BY ALL)""".replace("SELECT COUNT(*) AS n", "SELECT COLUMNS(*), COUNT(*) AS n"))
def dup_count(spark, sf):
    return prof.duplicate_count(twice(load(spark, sf, "lineitem"), "l_orderkey % 7 = 0"))


@query("drop_duplicates", f"SELECT DISTINCT * FROM {TWICE.format(t='customer', when='c_custkey % 7 = 0')}")
def drop_duplicates(spark, sf):
    return prof.without_duplicates(twice(load(spark, sf, "customer"), "c_custkey % 7 = 0"))


@query("sign_inf_checks", _union("""SELECT '{c}' AS "column", bool_or(isinf(CAST({c} AS DOUBLE))) AS any_infinite, bool_or({c} < 0) AS any_negative,
  COUNT(*) FILTER ({c} < 0) AS negative, COUNT(*) FILTER ({c} > 0) AS positive, CAST(min({c}) AS DOUBLE) AS min,
  CAST(max({c}) AS DOUBLE) AS max FROM customer""", ["c_acctbal", "c_custkey"]))
def sign_inf_checks(spark, sf):
    return prof.value_checks(load(spark, sf, "customer"), ["c_acctbal", "c_custkey"])


@query("structure_report", f"""WITH {PANEL} SELECT COUNT(*) AS "rows", COUNT(DISTINCT period) AS periods, COUNT(DISTINCT series) AS entities,
  min(period) AS first, max(period) AS last FROM panel""")
def structure_report(spark, sf):
    return prof.structure_report(panel(spark, sf), "series", "period")


@query("weekday_counts", f"""SELECT CAST(d.p AS INTEGER) AS position, d.n AS day_of_week, COUNT(event_id) AS "count"
FROM (SELECT unnest({DAYS}) AS n, unnest([0, 1, 2, 3, 4, 5, 6]) AS p) d LEFT JOIN events ON dayname(ts) = d.n GROUP BY 1, 2""")
def weekday_counts(spark, sf):
    e = load(spark, sf, "events").select(F.date_format("ts", "EEEE").alias("day_of_week"))
    return prof.category_counts(e, "day_of_week", DAYS)


@query("distinct_values", "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def distinct_values(spark, sf):
    return filters.distinct_values(load(spark, sf, "orders").select(F.year("o_orderdate").alias("year")), "year")


@query("corr_pair", f"""WITH {GAPS} SELECT kind, round(corr(v, w), 6) AS r, COUNT(*) AS n FROM gaps
WHERE v IS NOT NULL AND w IS NOT NULL GROUP BY kind""")
def corr_pair(spark, sf):
    return rounded(prof.correlation(gaps(spark, sf), "v", "w", ["kind"]), 6, "r")


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in CORR_COLS for b in CORR_COLS))
def corr_matrix(spark, sf):
    return rounded(prof.correlation_matrix(load(spark, sf, "lineitem"), CORR_COLS), 6, "r")


@query("corr_matrix_gaps", f"WITH {GAPS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM gaps" for a in ("v", "w", "k") for b in ("v", "w", "k")))
def corr_matrix_gaps(spark, sf):
    return rounded(prof.correlation_matrix(gaps(spark, sf), ["v", "w", "k"]), 6, "r")


def _hist_sql(table: str, col: str, bins: int) -> str:
    return f"""WITH l AS (SELECT min({col}) AS a, max({col}) AS b FROM {table}),
c AS (SELECT CAST(least(floor(({col} - a) * {bins} / (b - a)), {bins - 1}) AS INTEGER) AS bin, COUNT(*) AS n FROM {table}, l GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(a + i * (b - a) / {bins}, 6) AS "left", round(a + (i + 1) * (b - a) / {bins}, 6) AS "right",
       coalesce(n, 0) AS "count" FROM l, range({bins}) t(i) LEFT JOIN c ON c.bin = i"""


@query("histogram", _hist_sql("events", "value", 20))
def histogram(spark, sf):
    return rounded(dist.histogram(load(spark, sf, "events"), "value", 20), 6, "left", "right")


@query("histogram_hours", _hist_sql("(SELECT CAST(hour(ts) AS DOUBLE) AS h FROM events)", "h", 24))
def histogram_hours(spark, sf):
    return rounded(dist.histogram(load(spark, sf, "events").select(F.hour("ts").alias("h")), "h", 24), 6, "left", "right")


@query("auto_bins", """SELECT n, CAST(ceil((b - a) / least((b - a) / (log2(n) + 1), 2 * (q3 - q1) / cbrt(n))) AS INTEGER) AS bins
FROM (SELECT COUNT(*) AS n, min(o_totalprice) AS a, max(o_totalprice) AS b, quantile_cont(o_totalprice, 0.25) AS q1,
      quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)""")
def auto_bins(spark, sf):
    return dist.automatic_bins(load(spark, sf, "orders"), "o_totalprice")


@query("box_stats", f"""WITH {GAPS}, q AS (SELECT kind, COUNT(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
  quantile_cont(v, 0.75) AS q3 FROM gaps WHERE v IS NOT NULL GROUP BY kind)
SELECT q.kind, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
  min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  COUNT(*) FILTER (NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM gaps JOIN q ON gaps.kind IS NOT DISTINCT FROM q.kind WHERE v IS NOT NULL GROUP BY ALL""")
def box_stats(spark, sf):
    return rounded(dist.box_stats(gaps(spark, sf), "v", ["kind"]), 4, "q1", "median", "q3")


KDE_SQL = """WITH src AS ({src}), s AS (SELECT event_type, COUNT(*) AS n, stddev_samp(value) * pow(COUNT(*), -0.2) AS h, min(value) AS a, max(value) AS b
  FROM src GROUP BY event_type),
k AS (SELECT event_type, i, n, h, a - {cut} * h + i * (b - a + 2 * {cut} * h) / 49 AS x FROM s, range(50) t(i)),
d AS (SELECT event_type, i, sum(exp(-0.5 * pow((x - value) / h, 2))) AS d FROM k JOIN src USING (event_type) GROUP BY 1, 2)
SELECT {keys} CAST(i AS INTEGER) AS point, round(x, 4) AS x, round(d / (n * h * sqrt(2 * pi())), 8) AS density FROM k JOIN d USING (event_type, i)"""


@query("kde_grid", KDE_SQL.format(keys="", cut=3, src="SELECT 'all' AS event_type, value FROM events"))
def kde_grid(spark, sf):
    return rounded(rounded(dist.kde(load(spark, sf, "events"), "value", points=50), 4, "x"), 8, "density")


@query("kde_by_group", KDE_SQL.format(keys="event_type,", cut=2, src="SELECT event_type, value FROM events"))
def kde_by_group(spark, sf):
    k = dist.kde(load(spark, sf, "events"), "value", ["event_type"], points=50, cut=2.0)
    return rounded(rounded(k, 4, "x"), 8, "density")


@query("bar_ci", """SELECT event_type, n, round(m, 4) AS mean, round(s, 4) AS std, round(m - 1.96 * s / sqrt(n), 4) AS ci_low,
  round(m + 1.96 * s / sqrt(n), 4) AS ci_high FROM (SELECT event_type, COUNT(value) AS n, avg(value) AS m, stddev_samp(value) AS s
  FROM events GROUP BY 1)""")
def bar_ci(spark, sf):
    return rounded(dist.mean_bar(load(spark, sf, "events"), "event_type", "value"), 4, "mean", "std", "ci_low", "ci_high")


@query("scatter_bins", """WITH l AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_extendedprice) AS c, max(l_extendedprice) AS d FROM lineitem)
SELECT l_returnflag, CAST(least(floor((l_quantity - a) * 20 / (b - a)), 19) AS INTEGER) AS x_bin,
  CAST(least(floor((l_extendedprice - c) * 20 / (d - c)), 19) AS INTEGER) AS y_bin, COUNT(*) AS "count" FROM lineitem, l GROUP BY ALL""")
def scatter_bins(spark, sf):
    return dist.bins_2d(load(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 20, ["l_returnflag"])


@query("bubble_map", """WITH l AS (SELECT min(c_acctbal) AS a, max(c_acctbal) AS b FROM customer)
SELECT c_custkey, c_nationkey, round(c_acctbal / 1000, 6) AS size, CASE WHEN c_acctbal >= 0 THEN round(pow(c_acctbal / 1000, 2.5) * 5, 6) END AS bubble,
  c_acctbal, round((c_acctbal - a) / (b - a), 6) AS shade FROM customer, l""")
def bubble_map(spark, sf):
    c = load(spark, sf, "customer").withColumn("size", F.col("c_acctbal") / 1000)
    m = dist.bubble_map(c, "c_custkey", "c_nationkey", "size", "c_acctbal").withColumnRenamed("c_acctbal_shade", "shade")
    return rounded(m, 6, "size", "bubble", "shade")
