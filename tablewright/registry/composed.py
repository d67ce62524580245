"""Compared values for composed programs: panels on which every step of a program has a closed form.

Lines are continued exactly by the order search (their second differences are zero), a line with a season by the seasonal
model, and a season alone by the panel forest; so rankings, roll-ups and classes of the forecasts follow in SQL. The panels
have the series and quarters of the lines table.
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tablewright.operators import arima, forecasting as fc, learners as ml, ranking, regression as rg
from tablewright.plans import catalogue, outlook
from tablewright.registry.analyses import _catalogue
from tablewright.registry.common import GAPS, PANEL, panel, query, rounded
from tablewright.registry.panels import SECTORS
from tablewright.session import cut_lineage
from tablewright.sources.tables import literal_table

NUMBER = "CAST(split_part(series, '#', 2) AS INTEGER)"
SLOPE = f"(3 * (({NUMBER} * 7) % 11 - 5) + 1)"
LINES = f"""{PANEL}, base AS (SELECT series, 3000 + 37 * {NUMBER} AS a, {SLOPE} AS b, COUNT(*) AS n, max(period) AS last FROM panel GROUP BY 1),
ahead AS (SELECT base.*, CAST(s AS INTEGER) AS step, CAST(a + b * (n + s) AS DOUBLE) AS forecast,
  CAST(last_day(CAST(date_trunc('quarter', last) + to_months(CAST(3 * s + 5 AS INTEGER)) AS DATE)) AS DATE) AS period FROM base, range(0, 40) t(s))"""


def _number():
    return F.split("series", "#")[1].cast("int")


def _lines(spark, sf):
    """A line of its own for every series, by the position of the quarter in the series."""
    t = F.row_number().over(Window.partitionBy("series").orderBy("period")) - 1
    slope = 3 * ((_number() * 7) % 11 - 5) + 1
    return panel(spark, sf, stored=True).withColumn("value", (3000 + 37 * _number() + slope * t).cast("double"))


def _outlook(spark, sf):
    return outlook.industry_outlook(_lines(spark, sf), literal_table(spark, SECTORS, "series string, sector string"), key="series")


@query("outlook_lines_by_growth", f"""WITH {LINES}, g AS (SELECT series, a + b * (n - 4.5) AS recent, a + b * (n + 19.5) AS future FROM base)
SELECT series, round(CAST(recent AS DOUBLE), 6) AS recent_avg, round(CAST(future AS DOUBLE), 6) AS forecast_avg, round(100 * (future - recent) / recent, 6) AS growth_rate,
  CAST(row_number() OVER (ORDER BY (future - recent) / recent DESC, series) AS INTEGER) AS rank FROM g ORDER BY rank LIMIT 15""")
def outlook_lines_by_growth(spark, sf):
    out = _outlook(spark, sf)["by_growth"].select("series", "recent_avg", "forecast_avg", "growth_rate", "rank")
    return rounded(out, 6, "recent_avg", "forecast_avg", "growth_rate")


@query("outlook_lines_sector_growth", f"""WITH {LINES}, sec AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in SECTORS)}) s(series, sector)),
rolled AS (SELECT period, coalesce(sector, 'Other') AS sector, sum(forecast) AS forecast FROM ahead LEFT JOIN sec USING (series) GROUP BY 1, 2)
SELECT * FROM (SELECT period, sector, round(forecast, 4) AS forecast, round(forecast / lag(forecast) OVER (PARTITION BY sector ORDER BY period) - 1, 8) AS growth_rate
FROM rolled) WHERE growth_rate IS NOT NULL""")
def outlook_lines_sector_growth(spark, sf):
    return rounded(rounded(_outlook(spark, sf)["sector_growth"], 4, "forecast"), 8, "growth_rate")


@query("outlook_lines_stability", f"""WITH {LINES}, g AS (SELECT series, forecast / lag(forecast) OVER (PARTITION BY series ORDER BY step) - 1 AS g FROM ahead),
s AS (SELECT series, avg(g) AS m, stddev_samp(g) AS v FROM g GROUP BY 1),
k AS (SELECT *, row_number() OVER (ORDER BY m DESC, series) AS rm, row_number() OVER (ORDER BY v DESC, series) AS rv FROM s)
SELECT series, round(m, 7) AS mean_growth, round(v, 7) AS volatility,
  CASE WHEN rv <= 10 THEN 'Volatile' WHEN rm <= 10 THEN 'Stable' ELSE 'Other' END AS stability FROM k""")
def outlook_lines_stability(spark, sf):
    return rounded(_outlook(spark, sf)["stability"], 7, "mean_growth", "volatility")


@query("arima_lines_ranking", f"""WITH {LINES} SELECT series, 0 AS p, 2 AS d, 0 AS q, round(CAST(a + b * (n - 4.5) AS DOUBLE), 6) AS recent_avg, round(CAST(a + b * (n + 19.5) AS DOUBLE), 6) AS forecast_avg,
  CAST(row_number() OVER (ORDER BY a + b * (n + 19.5) DESC, series) AS INTEGER) AS rank FROM base ORDER BY rank LIMIT 15""")
def arima_lines_ranking(spark, sf):
    out = arima.arima_search(_lines(spark, sf), ["series"], "period", "value")
    best = ranking.ranked(out.select("series", "order.*", "recent_avg", "forecast_avg"), 15, "forecast_avg", "series")
    return rounded(best, 6, "recent_avg", "forecast_avg")


@query("seasonal_holdout_exact", f"""WITH {PANEL} SELECT series, COUNT(*) - CAST(floor(0.8 * COUNT(*)) AS BIGINT) AS n, CAST(0 AS DOUBLE) AS mae, CAST(1 AS DOUBLE) AS r2
FROM panel GROUP BY series""")
def seasonal_holdout_exact(spark, sf):
    """Held-out quarters of a line with a season are met exactly by the model of the earlier ones."""
    t = F.row_number().over(Window.partitionBy("series").orderBy("period")) - 1
    p = panel(spark, sf, stored=True).withColumn("value", (500 + _number() + 5 * t + 10 * (t % 4)).cast("double"))
    scores = rg.regression_scores(arima.seasonal_holdout(p, ["series"], "period", "value"), "value", "prediction", ["series"])
    return rounded(scores.select("series", "n", "mae", "r2"), 6, "mae", "r2")


# a season alone, the same for all series but for its size, on every quarter of the table
PATTERN = "CASE quarter(period) WHEN 1 THEN 80 WHEN 2 THEN 110 WHEN 3 THEN 90 ELSE 120 END"
SEASON = f"{PANEL}, grid AS (SELECT series, period, CAST({NUMBER} * {PATTERN} AS DOUBLE) AS value FROM (SELECT DISTINCT series FROM panel), (SELECT DISTINCT period FROM panel))"


def _season(spark, sf):
    p = panel(spark, sf, stored=True)
    periods = p.agg(F.sort_array(F.collect_set("period"))).scalar()  # quarters that occur: some tens
    grid = p.select("series").distinct().withColumn("period", F.explode(periods))
    of_quarter = F.element_at(F.array(*map(F.lit, (80, 110, 90, 120))), F.quarter("period"))
    return cut_lineage(grid.withColumn("value", (_number() * of_quarter).cast("double")), "season")


@query("forest_season_holdout", f"""WITH {SEASON}, k AS (SELECT COUNT(DISTINCT period) AS n, COUNT(DISTINCT series) AS s FROM grid)
SELECT (n - CAST(floor(0.8 * n) AS BIGINT)) * s AS n, CAST(0 AS DOUBLE) AS mae, CAST(1 AS DOUBLE) AS r2 FROM k""")
def forest_season_holdout(spark, sf):
    """The panel forest meets the held-out quarters of a plain season exactly."""
    p = cut_lineage(rg.chronological_split(_season(spark, sf), ["series"], "period"))
    marked = cut_lineage(fc.forest_training(p, ["series"], "period", "value", fit_on=F.col("is_train")))
    model = fc.fit_panel_forest(marked.where("is_train"))
    held = ml.score(marked.where("not is_train"), model, fc.forest_features(4), "p")
    return rounded(rg.regression_scores(held, "_v", "p").select("n", "mae", "r2"), 6, "mae", "r2")


@query("forest_season_ranking", f"""WITH {SEASON}, last AS (SELECT series, max(period) AS p FROM grid GROUP BY 1),
f AS (SELECT series, {NUMBER} * {PATTERN} AS v FROM (SELECT series, CAST(p + to_months(CAST(3 * s AS INTEGER)) AS DATE) AS period FROM last, range(1, 41) t(s))),
m AS (SELECT series, avg(v) AS forecast_avg FROM f GROUP BY 1)
SELECT series, round(forecast_avg, 6) AS forecast_avg, CAST(row_number() OVER (ORDER BY forecast_avg DESC, series) AS INTEGER) AS rank FROM m ORDER BY rank LIMIT 15""")
def forest_season_ranking(spark, sf):
    """Recursive forecasts of a plain season repeat it for 40 steps."""
    training = cut_lineage(fc.forest_training(_season(spark, sf), ["series"], "period", "value"))
    paths = fc.recursive_forecast(training, fc.fit_panel_forest(training), ["series"], "period")
    future = paths.groupBy("series").agg(F.avg("forecast").alias("forecast_avg"))
    return rounded(ranking.ranked(future, 15, "forecast_avg", "series"), 6, "forecast_avg")


# the cleaned catalogue --------------------------------------------------------------------------------------------------

MISSING = {"nst": (0, 10), "gap": (11, 20), "dmin": (21, 30), "rms": (31, 33), "horizontalError": (34, 45), "depthError": (46, 50),
           "magError": (51, 70), "magNst": (0, 25)}


@query("catalogue_cells", f"WITH {GAPS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", COUNT(*) FILTER (k <> 99) AS "rows", COUNT(*) FILTER (k <> 99 AND k NOT BETWEEN {lo} AND {hi}) AS unchanged,
  CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS outside FROM gaps""" for c, (lo, hi) in MISSING.items()))
def catalogue_cells(spark, sf):
    """Imputation leaves no measurement missing, changes none that was there, and fills within the range of the known ones."""
    raw = cut_lineage(_catalogue(spark, sf), "raw")
    clean = catalogue.impute_catalogue(raw)
    both = clean.select("id", *[F.col(c).alias(f"_{c}") for c in MISSING]).join(raw, "id")
    limits = raw.where("mag is not null").agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in MISSING for f, n in ((F.min, "lo"), (F.max, "hi"))])).scalar()
    both = both.withColumn("_l", limits)
    each = []
    for c in MISSING:
        low, high = (F.least(F.col(f"_l.lo_{c}"), F.col("_l.lo_nst")) if c == "magNst" and x == "lo" else
                     F.greatest(F.col(f"_l.hi_{c}"), F.col("_l.hi_nst")) if c == "magNst" else F.col(f"_l.{x}_{c}") for x in ("lo", "hi"))
        new = F.col(f"_{c}")
        each.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), F.count_if(new == F.col(c)).alias("unchanged"),
                             F.count_if(new.isNull()).alias("missing"), F.count_if((new < low - 1e-9) | (new > high + 1e-9)).alias("outside")))
    return both.agg(F.array(*each).alias("a")).select(F.inline("a"))


@query("catalogue_capped", f"WITH {GAPS} " + """SELECT CAST(COUNT(*) FILTER (k <> 99) AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS beyond, CAST(0 AS BIGINT) AS below_ground,
  CAST(COUNT(*) FILTER (k <> 99) AS BIGINT) AS same_place FROM gaps""")
def catalogue_capped(spark, sf):
    """Capping leaves nothing beyond three deviations of the uncapped values, no negative depth, and the coordinates as they were."""
    raw = cut_lineage(_catalogue(spark, sf).where("mag is not null").drop("nst", "gap", "dmin", "horizontalError", "magNst"), "raw")
    done = catalogue.cap_catalogue(raw)
    measures = ["depth", "mag", "rms", "depthError", "magError"]
    told = raw.agg(F.struct(*[f(c).alias(f"{n}_{c}") for c in measures for f, n in ((F.avg, "m"), (F.stddev_pop, "s"))])).scalar()
    both = done.join(raw.select("id", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon")), "id").withColumn("_t", told)
    beyond = F.lit(False)
    for c in measures:
        beyond = beyond | (F.abs(F.col(c) - F.col(f"_t.m_{c}")) > 3 * F.col(f"_t.s_{c}") + 1e-9) & (F.lit(c != "depth") | (F.col(c) > 0))
    return both.agg(F.count("*").alias("rows"), F.count_if(beyond).alias("beyond"), F.count_if(F.col("depth") < 0).alias("below_ground"),
                    F.count_if((F.col("latitude") == F.col("_lat")) & (F.col("longitude") == F.col("_lon"))).alias("same_place"))
