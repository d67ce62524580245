"""Time-series panels, reshape, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import distributions as dist, panel as pn, ranking, reshape
from tablewright.registry.common import CELLS, NATION_YEAR, PANEL, cells, nation_year, panel, query, rounded
from tablewright.sources.tables import literal_table, load

W = "OVER (PARTITION BY series ORDER BY period)"
QI = "CAST(year(period) * 4 + quarter(period) - 1 AS INTEGER)"


RANKING_SQL = f"""WITH {PANEL},
t AS (SELECT p.series, row_number() OVER (PARTITION BY p.series ORDER BY p.period DESC) AS rn, p.period, p.value,
  p.value / lag(p.value) OVER (PARTITION BY p.series ORDER BY p.period) - 1 AS g, p.value / b.value - 1 AS y,
  100 * p.value / SUM(p.value) OVER (PARTITION BY p.period) AS share
  FROM panel p LEFT JOIN panel b ON b.series = p.series AND b.period = p.period - INTERVAL 1 YEAR),
a AS (SELECT series, avg(value) FILTER (rn <= 8) AS recent_avg, avg(value) FILTER (rn > 8 AND rn <= 16) AS earlier_avg,
  avg(g) FILTER (rn <= 8) AS growth, avg(y) FILTER (rn <= 8) * 100 AS yoy, avg(share) FILTER (rn <= 8) AS share FROM t GROUP BY 1)
SELECT series, round(recent_avg, 2) AS recent_avg, round(growth, 6) AS mean_growth, round(yoy, 4) AS mean_yoy, round(share, 4) AS mean_share,
  round(100 * (recent_avg - earlier_avg) / earlier_avg, 4) AS growth_rate,
  CAST(row_number() OVER (ORDER BY 100 * (recent_avg - earlier_avg) / earlier_avg DESC, series) AS INTEGER) AS rank FROM a ORDER BY rank LIMIT 15"""


@query("growth_ranking", RANKING_SQL)
def growth_ranking(spark, sf):
    p = panel(spark, sf, stored=True)
    p = pn.growth(p, ["series"], "period", "value", "g")
    p = pn.year_over_year(p, ["series"], "period", "value", "y")
    p = pn.share_of_total(p, "period", "value")
    recent = pn.last_rows(p, ["series"], "period", 16, "age").withColumn("late", F.col("age") <= 8)
    a = recent.groupBy("series").agg(
        F.avg(F.when(F.col("late"), F.col("value"))).alias("recent_avg"),
        F.avg(F.when(~F.col("late"), F.col("value"))).alias("earlier_avg"),
        *[F.avg(F.when(F.col("late"), F.col(c))).alias(n) for c, n in (("g", "mean_growth"), ("y", "mean_yoy"), ("share", "mean_share"))])
    a = a.withColumn("growth_rate", 100 * F.try_divide(F.col("recent_avg") - F.col("earlier_avg"), F.col("earlier_avg")))
    best = ranking.ranked(a.drop("earlier_avg"), 15, "growth_rate", "series")
    return rounded(rounded(rounded(best, 2, "recent_avg"), 6, "mean_growth"), 4, "mean_yoy", "mean_share", "growth_rate")


@query("growth", f"""WITH {NATION_YEAR} SELECT entity, year, orders,
  round(coalesce(CAST(orders AS DOUBLE) / lag(orders) OVER (PARTITION BY entity ORDER BY year) - 1, 0), 6) AS growth FROM nation_year WHERE year >= 1996""")
def growth(spark, sf):
    ny = nation_year(spark, sf).where("year >= 1996").select("entity", "year", "orders")
    return rounded(pn.growth(ny, ["entity"], "year", "orders", first=0.0), 6, "growth")


@query("growth_padded", f"""WITH {PANEL}, g AS (SELECT series, period, CASE WHEN value >= 1000000 THEN value END AS v FROM panel),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY series ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p FROM g)
SELECT series, period, round(100 * (p / lag(p) {W} - 1), 6) AS growth FROM f""")
def growth_padded(spark, sf):
    p = panel(spark, sf).withColumn("value", F.when(F.col("value") >= 1000000, F.col("value")))
    return rounded(pn.growth(p, ["series"], "period", "value", scale=100.0), 6, "growth").drop("value")


@query("growth_dropna", f"""WITH {PANEL} SELECT * FROM (SELECT series, period, round(value / lag(value) {W} - 1, 6) AS growth FROM panel) WHERE growth IS NOT NULL""")
def growth_dropna(spark, sf):
    return rounded(pn.growth_present(panel(spark, sf), ["series"], "period", "value"), 6, "growth").drop("value")


@query("yoy", f"""WITH {PANEL} SELECT a.series, a.period, round(100 * (a.value / b.value - 1), 6) AS yoy FROM panel a
LEFT JOIN panel b ON a.series = b.series AND b.period = a.period - INTERVAL 1 YEAR""")
def yoy(spark, sf):
    return rounded(pn.year_over_year(panel(spark, sf), ["series"], "period", "value"), 6, "yoy").drop("value")


@query("lag_matrix", f"""WITH {PANEL}, t AS (SELECT series, period, round(value, 4) AS value, round(lag(value, 1) {W}, 4) AS lag1, round(lag(value, 2) {W}, 4) AS lag2,
round(lag(value, 3) {W}, 4) AS lag3, round(lag(value, 4) {W}, 4) AS lag4 FROM panel) SELECT * FROM t WHERE lag4 IS NOT NULL""")
def lag_matrix(spark, sf):
    return rounded(pn.lag_matrix(panel(spark, sf), ["series"], "period", "value"), 4, "value", "lag1", "lag2", "lag3", "lag4")


@query("last_n_mean", f"""WITH {PANEL}, t AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY period DESC) AS rn FROM panel)
SELECT series, round(avg(value), 2) AS recent_avg FROM t WHERE rn <= 8 GROUP BY 1""")
def last_n_mean(spark, sf):
    return rounded(pn.last_mean(panel(spark, sf), ["series"], "period", "value"), 2, "recent_avg")


@query("last_rows", """SELECT event_id, user_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn <= 4""")
def last_rows(spark, sf):
    return pn.last_rows(load(spark, sf, "events").select("event_id", "user_id"), ["user_id"], "event_id", 4)


@query("share_of_total", f"WITH {PANEL} SELECT series, period, round(100 * value / SUM(value) OVER (PARTITION BY period), 6) AS share FROM panel")
def share_of_total(spark, sf):
    return rounded(pn.share_of_total(panel(spark, sf, stored=True), "period", "value"), 6, "share").drop("value")


@query("share_of_members", f"""WITH {PANEL} SELECT series, period, round(100 * value / SUM(value) FILTER (series NOT IN ('Brand#1', 'Brand#2'))
OVER (PARTITION BY period), 6) AS share FROM panel""")
def share_of_members(spark, sf):
    members = ~F.col("series").isin("Brand#1", "Brand#2")
    return rounded(pn.share_of_total(panel(spark, sf, stored=True), "period", "value", members), 6, "share").drop("value")


@query("seasonal_stats", f"""WITH {PANEL} SELECT series, CAST(quarter(period) AS INTEGER) AS season, round(avg(value), 2) AS mean,
round(stddev_samp(value), 2) AS std FROM panel GROUP BY 1, 2""")
def seasonal_stats(spark, sf):
    return rounded(pn.seasonal_stats(panel(spark, sf), F.quarter("period"), "value", ["series"]), 2, "mean", "std")


@query("seasonal_growth", f"""WITH {PANEL}, t AS (SELECT period, SUM(value) AS value, 1 AS series FROM panel GROUP BY 1),
g AS (SELECT period, 100 * (value / lag(value) {W} - 1) AS growth FROM t)
SELECT CAST(quarter(period) AS INTEGER) AS season, round(avg(growth), 6) AS mean, round(stddev_samp(growth), 6) AS std FROM g GROUP BY 1""")
def seasonal_growth(spark, sf):
    total = panel(spark, sf).groupBy("period").agg(F.sum("value").alias("value")).withColumn("series", F.lit("all"))
    g = pn.growth(total, ["series"], "period", "value", scale=100.0)
    return rounded(pn.seasonal_stats(g, F.quarter("period"), "growth"), 6, "mean", "std")


@query("time_index", f"WITH {PANEL} SELECT series, period, CAST({QI} - (SELECT min({QI}) FROM panel) AS INTEGER) AS t FROM panel")
def time_index(spark, sf):
    return pn.time_index(panel(spark, sf, stored=True), "period").drop("value")


@query("first_last", f"""WITH {PANEL} SELECT series, min(period) AS first_period, round(arg_min(value, period), 4) AS first_value,
max(period) AS last_period, round(arg_max(value, period), 4) AS last_value FROM panel GROUP BY 1""")
def first_last(spark, sf):
    return rounded(pn.first_last(panel(spark, sf), ["series"], "period", "value"), 4, "first_value", "last_value")


@query("frequency", f"""WITH {PANEL}, g AS (SELECT series, date_diff('month', lag(period) OVER (PARTITION BY series ORDER BY period), period) AS gap FROM panel),
c AS (SELECT series, gap, COUNT(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2)
SELECT series, CAST(gap AS DOUBLE) AS months FROM c QUALIFY row_number() OVER (PARTITION BY series ORDER BY n DESC, gap) = 1""")
def frequency(spark, sf):
    return pn.frequency(panel(spark, sf), ["series"], "period")


@query("pivot_quarter", f"""WITH {PANEL} SELECT series, CAST(year(period) AS INTEGER) AS year, """ + ", ".join(
    f'round(max(value) FILTER (quarter(period) = {q}), 4) AS "{q}"' for q in range(1, 5)) + " FROM panel GROUP BY 1, 2")
def pivot_quarter(spark, sf):
    p = panel(spark, sf).withColumn("year", F.year("period")).withColumn("quarter", F.quarter("period"))
    return rounded(reshape.pivot(p, ["series", "year"], "quarter", "value", [1, 2, 3, 4]), 4, "1", "2", "3", "4")


BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query("pivot_two_level", f"WITH {PANEL} SELECT period, " + ", ".join(
    f"""round(max(value) FILTER (series = '{b}'), 4) AS "{b[6:]}|{b}" """ for b in BRANDS) + " FROM panel GROUP BY 1")
def pivot_two_level(spark, sf):
    p = panel(spark, sf).withColumn("code", F.split("series", "#")[1])
    wide = reshape.pivot_pairs(p, ["period"], "code", "series", "value", [(b[6:], b) for b in BRANDS])
    return wide.select("period", *[F.round(F.col(f"`{c}`"), 4).alias(c) for c in wide.columns[1:]])


@query("unpivot", """SELECT l_orderkey, l_linenumber, 'l_discount' AS variable, l_discount AS "value" FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""")
def unpivot(spark, sf):
    return reshape.unpivot(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"])


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("dummies", "SELECT c_custkey, " + ", ".join(
    f"CAST(c_mktsegment = '{s}' AS INTEGER) AS \"c_mktsegment_{s}\"" for s in SEGMENTS) + " FROM customer")
def dummies(spark, sf):
    return reshape.dummies(load(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query("undummies", "SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def undummies(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    d = reshape.dummies(o, ["o_orderstatus", "o_orderpriority"])
    return reshape.undummies(reshape.undummies(d, "o_orderstatus", "status"), "o_orderpriority", "priority")


@query("explode_series", f"""WITH {PANEL}, t AS (SELECT series, max(period) AS m FROM panel GROUP BY 1),
a AS (SELECT series, CAST(quarter(period) - 1 AS INTEGER) AS step, avg(value) AS v FROM panel GROUP BY 1, 2)
SELECT series, step, round(v, 2) AS forecast, CAST(last_day(m + to_months(CAST((step + 1) * 3 + 2 AS INTEGER))) AS DATE) AS period,
  CAST(2025 + step AS INTEGER) AS year_label FROM a JOIN t USING (series)""")
def explode_series(spark, sf):
    p = panel(spark, sf)
    arrays = p.groupBy("series").agg(F.max("period").alias("last"), F.array(*[
        F.avg(F.when(F.quarter("period") == q, F.col("value"))) for q in (1, 2, 3, 4)]).alias("path"))
    rows = reshape.forecast_rows(arrays, "path", "last", legacy_year=2025).drop("last")
    return rounded(rows, 2, "forecast")


@query("line_series", f"WITH {CELLS} SELECT region, segment, year, round(price, 6) AS price, orders FROM cells")
def line_series(spark, sf):
    return rounded(dist.line_series(cells(spark, sf), ["region", "segment"], "year", ["price", "orders"]), 6, "price")


@query("choropleth", f"WITH {NATION_YEAR} SELECT entity, year, round(total, 2) AS total, orders FROM nation_year WHERE year = 1999")
def choropleth(spark, sf):
    return rounded(dist.choropleth(nation_year(spark, sf), "entity", "year", "total", ["orders"], 1999), 2, "total")


TOPK = f"""WITH {PANEL}, t AS (SELECT series, avg(value) AS mean, arg_max(value, period) / arg_min(value, period) - 1 AS growth FROM panel GROUP BY 1)
SELECT series, round(mean, 2) AS mean, round(growth, 6) AS growth, CAST(row_number() OVER (ORDER BY {{by}} DESC, series) AS INTEGER) AS rank
FROM t ORDER BY rank LIMIT 10"""


def _per_series(spark, sf, stored=False):
    p = panel(spark, sf, stored=stored)
    return p.groupBy("series").agg(F.avg("value").alias("mean"), (F.try_divide(
        F.max_by("value", "period"), F.min_by("value", "period")) - 1).alias("growth"))


@query("topk_value", TOPK.format(by="mean"))
def topk_value(spark, sf):
    return rounded(rounded(ranking.ranked(_per_series(spark, sf), 10, "mean", "series"), 2, "mean"), 6, "growth")


@query("topk_growth", TOPK.format(by="growth"))
def topk_growth(spark, sf):
    return rounded(rounded(ranking.ranked(_per_series(spark, sf), 10, "growth", "series"), 2, "mean"), 6, "growth")


@query("rank_summary", f"""WITH {PANEL}, t AS (SELECT series, 100 * (arg_max(value, period) / arg_min(value, period) - 1) AS g FROM panel GROUP BY 1)
SELECT COUNT(g) AS series, round(avg(g), 6) AS mean, round(median(g), 6) AS median, COUNT(*) FILTER (g > 0) AS positive, COUNT(*) FILTER (g < 0) AS negative FROM t""")
def rank_summary(spark, sf):
    t = _per_series(spark, sf, stored=True).select("series", (100 * F.col("growth")).alias("growth_rate"))
    return rounded(ranking.rank_summary(t), 6, "mean", "median")


# fixed values: sector of some series
SECTORS = [("Brand#1", "Farms"), ("Brand#2", "Farms"), ("Brand#7", "Retail"), ("Brand#9", "Retail"), ("Brand#20", "Finance")]
SECTOR_SQL = f"""{PANEL}, sec AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in SECTORS)}) s(series, sector)),
rolled AS (SELECT period, coalesce(sector, 'Other') AS sector, SUM(value) AS value FROM panel LEFT JOIN sec USING (series) GROUP BY 1, 2)"""


def _rolled(spark, sf):
    return ranking.roll_up(panel(spark, sf), "period", "series", "value", literal_table(spark, SECTORS, "series string, sector string"))


@query("sector_rollup", f"WITH {SECTOR_SQL} SELECT period, sector, round(value, 2) AS \"value\" FROM rolled")
def sector_rollup(spark, sf):
    return rounded(_rolled(spark, sf), 2, "value")


@query("sector_growth", f"""WITH {SECTOR_SQL} SELECT * FROM (SELECT period, sector, round(value, 2) AS "value",
round(value / lag(value) OVER (PARTITION BY sector ORDER BY period) - 1, 6) AS growth_rate FROM rolled) WHERE growth_rate IS NOT NULL""")
def sector_growth(spark, sf):
    return rounded(rounded(ranking.sector_growth(_rolled(spark, sf), "period", "value"), 2, "value"), 6, "growth_rate")


@query("stability", f"""WITH {PANEL}, g AS (SELECT series, value / lag(value) {W} - 1 AS g FROM panel),
s AS (SELECT series, avg(g) AS m, stddev_samp(g) AS v FROM g GROUP BY 1),
k AS (SELECT *, row_number() OVER (ORDER BY m DESC, series) AS rm, row_number() OVER (ORDER BY v DESC, series) AS rv FROM s)
SELECT series, round(m, 6) AS mean_growth, round(v, 6) AS volatility,
  CASE WHEN rv <= 10 THEN 'Volatile' WHEN rm <= 10 THEN 'Stable' ELSE 'Other' END AS stability FROM k""")
def stability(spark, sf):
    g = pn.growth_present(panel(spark, sf), ["series"], "period", "value")
    return rounded(ranking.stability_classes(g, "series", "growth"), 6, "mean_growth", "volatility")


@query("quarter_boxes", f"""WITH {PANEL}, q AS (SELECT CAST(quarter(period) AS INTEGER) AS quarter, COUNT(*) AS n, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM panel GROUP BY 1)
SELECT q.quarter, n, round(q1, 2) AS q1, round(median, 2) AS median, round(q3, 2) AS q3,
  round(min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 2) AS whisker_low,
  round(max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 2) AS whisker_high,
  COUNT(*) FILTER (NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM panel JOIN q ON q.quarter = quarter(period) GROUP BY ALL""")
def quarter_boxes(spark, sf):
    b = dist.box_stats(panel(spark, sf, stored=True).withColumn("quarter", F.quarter("period")), "value", ["quarter"])
    return rounded(b, 2, "q1", "median", "q3", "whisker_low", "whisker_high")


