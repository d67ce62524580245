"""The composed analyses on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import reshape
from tablewright.plans import catalogue, economy, energy, outlook
from tablewright.registry.common import NATION_YEAR, PANEL, gaps, nation_year, panel, query, revenue, rounded
from tablewright.registry.panels import SECTORS
from tablewright.sources.tables import literal_table, load


def _catalogue(spark, sf):
    """Events in the shape of a measurement catalogue with missing cells."""
    g = gaps(spark, sf)
    def miss(c, low, high):
        return F.when(~F.col("k").between(low, high), c)
    return g.select(
        F.col("event_id").alias("id"), F.col("ts").alias("time"), F.col("kind").alias("magType"),
        (F.col("user_id") * 0.6 - 45).alias("latitude"), (F.col("h") * 7.5 - 90).alias("longitude"),
        (F.col("value") - 5).alias("depth"), F.when(F.col("k") != 99, F.col("value") / 40).alias("mag"),
        miss(F.col("k") * 1.0, 0, 10).alias("nst"), miss(F.col("user_id") * 2.0, 11, 20).alias("gap"),
        miss(F.col("h") / 10, 21, 30).alias("dmin"), miss(F.col("value") / 100, 31, 33).alias("rms"),
        miss(F.col("value") / 7, 34, 45).alias("horizontalError"), miss(F.col("value") / 9, 46, 50).alias("depthError"),
        miss(F.col("value") / 200, 51, 70).alias("magError"), miss(F.col("k") * 0.5, 0, 25).alias("magNst"))


@query("catalogue_cleanup")
def catalogue_cleanup(spark, sf):
    clean = catalogue.impute_catalogue(_catalogue(spark, sf))
    return catalogue.cap_catalogue(clean)


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
ENERGY_GROUPS = {"first": ["ECONOMY", "LARGE", "MEDIUM"], "second": ["PROMO", "SMALL", "STANDARD"]}


def _energy(spark, sf):
    """Monthly revenue by part type with the month as text."""
    lines = load(spark, sf, "lineitem").join(load(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    month = lines.groupBy(F.trunc("l_shipdate", "month").alias("m"), "p_type").agg(F.sum(revenue()).cast("double").alias("v"))
    wide = reshape.pivot(month, ["m"], "p_type", "v", TYPES)
    total = sum((F.coalesce(F.col(t), F.lit(0.0)) for t in TYPES[1:]), F.coalesce(F.col(TYPES[0]), F.lit(0.0)))
    return energy.prepare(wide.select(F.date_format("m", "MMM yyyy").alias("Month"), *TYPES, total.alias("all_fuels")))


ENERGY = f"""m AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Month", p_type, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS v
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
w AS (SELECT "Month", {", ".join(f"max(v) FILTER (p_type = '{t}') AS {t}" for t in TYPES)} FROM m GROUP BY 1),
e AS (SELECT * FROM w WHERE {" AND ".join(f"{t} IS NOT NULL" for t in TYPES)})"""


@query("energy_classes", f"""WITH {ENERGY}, q AS (SELECT {", ".join(f"quantile_cont({t}, [0.25, 0.5, 0.75]) AS q{t}" for t in ENERGY_GROUPS["first"])} FROM e)
SELECT "Month", {", ".join(f"CASE WHEN {t} <= q{t}[1] THEN 'Low' WHEN {t} <= q{t}[2] THEN 'Medium' WHEN {t} <= q{t}[3] THEN 'High' ELSE 'Very High' END AS {t}_category" for t in ENERGY_GROUPS["first"])}
FROM e, q""")
def energy_classes(spark, sf):
    return energy.classes(_energy(spark, sf), ENERGY_GROUPS)["first"].drop(*ENERGY_GROUPS["first"])


@query("energy_scaled", f"""WITH {ENERGY} SELECT "Month", {", ".join(f"round(({t} - (SELECT min({t}) FROM e)) / ((SELECT max({t}) FROM e) - (SELECT min({t}) FROM e)), 6) AS {t}" for t in TYPES)} FROM e""")
def energy_scaled(spark, sf):
    return rounded(energy.scaled(_energy(spark, sf)).drop("all_fuels"), 6, *TYPES)


@query("energy_correlations", f"WITH {ENERGY} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM e" for a in TYPES for b in TYPES))
def energy_correlations(spark, sf):
    return rounded(energy.correlations(_energy(spark, sf).drop("all_fuels")), 6, "r")


@query("energy_regression")
def energy_regression(spark, sf):
    return energy.regression(_energy(spark, sf), TYPES)[0]


@query("energy_scores")
def energy_scores(spark, sf):
    return energy.regression(_energy(spark, sf), TYPES, fit_scaler_on_train=False)[2]


def _economy(spark, sf):
    ny = nation_year(spark, sf, stored=True)
    population = ny.select(F.col("entity").alias("Entity"), F.col("year").alias("Year"),
                           F.col("orders").cast("double").alias("Population (historical)"))
    output = ny.select(F.col("entity").alias("Entity"), F.col("year").alias("Year"),
                       F.col("total").cast("string").alias(economy.OUTPUT))
    return population, output


@query("economy_prepare", f"""WITH {NATION_YEAR}, g AS (SELECT entity, year, CAST(orders AS DOUBLE) AS pop,
  coalesce(CAST(orders AS DOUBLE) / lag(orders) OVER (PARTITION BY entity ORDER BY year) - 1, 0) AS growth, total FROM nation_year WHERE year >= 1996),
j AS (SELECT * FROM g WHERE year = (SELECT max(year) FROM nation_year)),
l AS (SELECT min(pop) AS a, max(pop) AS b, min(growth) AS c, max(growth) AS d, min(total) AS e, max(total) AS f FROM j)
SELECT entity AS "Entity", year AS "Year", round((pop - a) / (b - a), 6) AS "Population_historical", round((growth - c) / (d - c), 6) AS "Pop_Growth",
  round((total - e) / (f - e), 6) AS output FROM j, l""")
def economy_prepare(spark, sf):
    ready = economy.prepare(*_economy(spark, sf), since=1996).withColumnRenamed(economy.OUTPUT, "output")
    return rounded(ready, 6, "Population_historical", "Pop_Growth", "output")


@query("economy_regression")
def economy_regression(spark, sf):
    return economy.regression_report(economy.prepare(*_economy(spark, sf), since=1996))[0]


def _statistics(spark, sf):
    """The brand panel with its total, in the shape of a state panel: regions are aggregates of brands."""
    p = panel(spark, sf, stored=True)
    number = F.split("series", "#")[1].cast("int")
    names = F.array(*map(F.lit, outlook.REGIONS[:-1]))
    regions = p.groupBy(F.element_at(names, number % 8 + 1).alias("series_id"), "period").agg(F.sum("value").alias("value"))
    country = p.groupBy("period").agg(F.sum("value").alias("value")).select(F.lit(outlook.COUNTRY).alias("series_id"), "period", "value")
    states = p.select(F.col("series").alias("series_id"), "period", "value")
    return states.unionByName(regions).unionByName(country)


NUMBER = "CAST(split_part(series, '#', 2) AS INTEGER)"


@query("region_features", f"""WITH {PANEL} SELECT period, round(SUM(value), 4) AS target_gdp, """ + ", ".join(
    f"""round(SUM(value) FILTER ({NUMBER} % 8 = {i}), 4) AS "{n}" """ for i, n in enumerate(outlook.REGIONS[:-1])) + " FROM panel GROUP BY 1")
def region_features(spark, sf):
    return rounded(outlook.region_features(_statistics(spark, sf)), 4, "target_gdp", *outlook.REGIONS[:-1])


@query("seasonality", f"""WITH {PANEL}, s AS (SELECT series, period, value, 100 * (value / lag(value) OVER w - 1) AS g, 
  100 * (value / (SELECT b.value FROM panel b WHERE b.series = panel.series AND b.period = panel.period - INTERVAL 1 YEAR) - 1) AS y
FROM panel WINDOW w AS (PARTITION BY series ORDER BY period))
SELECT series AS series_id, CAST(quarter(period) AS INTEGER) AS quarter, round(avg(value), 2) AS value_mean, round(stddev_samp(value), 2) AS value_std,
  round(avg(g), 4) AS growth_mean, round(stddev_samp(g), 4) AS growth_std, round(avg(y), 4) AS yoy_mean, round(stddev_samp(y), 4) AS yoy_std FROM s GROUP BY 1, 2""")
def seasonality(spark, sf):
    s = outlook.seasonality(outlook.split_states(_statistics(spark, sf))["states"])
    return rounded(rounded(s, 2, "value_mean", "value_std"), 4, "growth_mean", "growth_std", "yoy_mean", "yoy_std")


def _outlook(spark, sf):
    return outlook.industry_outlook(panel(spark, sf), literal_table(spark, SECTORS, "series string, sector string"), key="series")


@query("outlook_by_growth")
def outlook_by_growth(spark, sf):
    return _outlook(spark, sf)["by_growth"]


@query("outlook_sector_growth")
def outlook_sector_growth(spark, sf):
    return _outlook(spark, sf)["sector_growth"]


@query("outlook_stability")
def outlook_stability(spark, sf):
    return _outlook(spark, sf)["stability"]

