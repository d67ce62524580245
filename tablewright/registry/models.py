"""Regression, learners and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.operators import arima, forecasting as fc, joining, learners as ml, network, panel as pn, ranking, regression as rg, reshape
from tablewright.registry.common import GAPS, PANEL, cells, gaps, panel, query, r, rounded
from tablewright.session import cut_lineage
from tablewright.sources.tables import load

QI = "(year(period) * 4 + quarter(period) - 1)"
HASH = "TRY_CAST('0x' || substr(md5('{seed}|' || {key}), 1, 8) AS BIGINT)"


@query("ols_by_group", f"""WITH {PANEL} SELECT series, round(regr_slope(value, {QI}), 4) AS slope, round(regr_intercept(value, {QI}), 2) AS intercept,
round(regr_r2(value, {QI}), 6) AS r2, regr_count(value, {QI}) AS n FROM panel GROUP BY 1""")
def ols_by_group(spark, sf):
    p = panel(spark, sf).withColumn("t", F.year("period") * 4 + F.quarter("period") - 1)
    return rounded(rounded(rounded(rg.simple_ols(p, "t", "value", ["series"]), 4, "slope"), 2, "intercept"), 6, "r2")


def _signal(spark, sf):
    """Label with a known linear part: value + 0.5 user_id - 0.2 k."""
    return gaps(spark, sf).select("event_id", "ts", "kind", "k", "user_id", "h",
                                  (F.col("value") + 0.5 * F.col("user_id") - 0.2 * F.col("k")).alias("y"))


SIGNAL = f"{GAPS}, d AS (SELECT event_id, ts, kind, k, user_id, h, value + 0.5 * user_id - 0.2 * k AS y FROM gaps)"


@query("ols_two_features", f"""WITH {SIGNAL}, s AS (SELECT COUNT(*) AS n, avg(user_id) AS m1, avg(k) AS m2, avg(y) AS my, var_pop(user_id) AS s11,
  var_pop(k) AS s22, covar_pop(user_id, k) AS s12, covar_pop(user_id, y) AS s1y, covar_pop(k, y) AS s2y, var_pop(y) AS syy FROM d),
b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s)
SELECT n, round(my - b1 * m1 - b2 * m2, 6) AS intercept, round(b1, 6) AS user_id, round(b2, 6) AS k,
  round((b1 * s1y + b2 * s2y) / syy, 6) AS r2 FROM b""")
def ols_two_features(spark, sf):
    m = rg.ols(_signal(spark, sf), ["user_id", "k"], "y")
    return m.select("n", r("intercept", 6).alias("intercept"), F.round(F.col("coef")[0], 6).alias("user_id"),
                    F.round(F.col("coef")[1], 6).alias("k"), r("r2", 6).alias("r2"))


@query("ols_no_intercept", f"""WITH {SIGNAL} SELECT kind, COUNT(*) AS n, round(sum(CAST(user_id AS DOUBLE) * y) / sum(CAST(user_id AS DOUBLE) * user_id), 6) AS coef FROM d GROUP BY 1""")
def ols_no_intercept(spark, sf):
    m = rg.ols(_signal(spark, sf), ["user_id"], "y", ["kind"], intercept=False)
    return m.select("kind", "n", F.round(F.col("coef")[0], 6).alias("coef"))


@query("ols_coefficients", f"""WITH {SIGNAL}, f AS (SELECT COUNT(*) AS n, regr_slope(y, user_id) AS b, regr_intercept(y, user_id) AS a, avg(user_id) AS m,
  var_pop(user_id) AS s, sqrt(var_pop(y) * (1 - regr_r2(y, user_id)) * COUNT(*) / (COUNT(*) - 2)) AS e FROM d)
SELECT 'const' AS term, round(a, 6) AS coef, round(e * sqrt((1 + m * m / s) / n), 6) AS se, round(a / (e * sqrt((1 + m * m / s) / n)), 4) AS t FROM f
UNION ALL SELECT 'user_id', round(b, 6), round(e / sqrt(n * s), 6), round(b / (e / sqrt(n * s)), 4) FROM f""")
def ols_coefficients(spark, sf):
    c = rg.ols_coefficients(_signal(spark, sf), ["user_id"], "y").select("term", "coef", "se", "t")
    return rounded(rounded(c, 6, "coef", "se"), 4, "t")


@query("ols_summary", f"""WITH {SIGNAL}, f AS (SELECT regr_slope(y, user_id) AS b, regr_intercept(y, user_id) AS a, regr_r2(y, user_id) AS r2 FROM d),
e AS (SELECT y - a - b * user_id AS e, r2, lag(y - a - b * user_id) OVER (ORDER BY ts, event_id) AS p FROM d, f),
m AS (SELECT COUNT(*) AS n, any_value(r2) AS r2, sum(e * e) AS ss, sum((e - p) * (e - p)) AS sd, avg(e * e * e) / pow(avg(e * e), 1.5) AS skew,
  avg(e * e * e * e) / pow(avg(e * e), 2) AS kurt FROM e)
SELECT n, n - 2 AS df_resid, CAST(1 AS INTEGER) AS df_model, round(r2, 6) AS r2, round(1 - (1 - r2) * (n - 1) / (n - 2), 6) AS adj_r2,
  round(r2 / ((1 - r2) / (n - 2)), 4) AS f, round(-n / 2.0 * (ln(2 * pi() * ss / n) + 1), 4) AS loglik,
  round(4 + n * (ln(2 * pi() * ss / n) + 1), 4) AS aic, round(ln(n) * 2 + n * (ln(2 * pi() * ss / n) + 1), 4) AS bic,
  round(sd / ss, 6) AS durbin_watson, round(skew, 6) AS skew, round(kurt, 6) AS kurtosis,
  round(n / 6.0 * (skew * skew + (kurt - 3) * (kurt - 3) / 4), 4) AS jarque_bera FROM m""")
def ols_summary(spark, sf):
    s = rg.ols_summary(_signal(spark, sf), ["user_id"], "y", ["ts", "event_id"]).drop("f_p", "omnibus", "omnibus_p", "jb_p", "cond")
    return rounded(rounded(s, 6, "r2", "adj_r2", "durbin_watson", "skew", "kurtosis"), 4, "f", "loglik", "aic", "bic", "jarque_bera")


@query("ols_summary_by_group")
def ols_summary_by_group(spark, sf):
    return rg.ols_summary(_signal(spark, sf), ["user_id", "k", "h"], "y", ["ts", "event_id"], ["kind"])


@query("ols_summary_per_kind", f"""WITH {SIGNAL}, f AS (SELECT kind, regr_slope(y, user_id) AS b, regr_intercept(y, user_id) AS a, regr_r2(y, user_id) AS r2 FROM d GROUP BY 1),
e AS (SELECT d.kind, y - a - b * user_id AS e, r2, lag(y - a - b * user_id) OVER (PARTITION BY d.kind ORDER BY ts, event_id) AS p FROM d JOIN f ON d.kind IS NOT DISTINCT FROM f.kind),
m AS (SELECT kind, COUNT(*) AS n, any_value(r2) AS r2, sum(e * e) AS ss, sum((e - p) * (e - p)) AS sd, avg(e * e * e) / pow(avg(e * e), 1.5) AS skew FROM e GROUP BY 1)
SELECT kind, n, round(r2, 6) AS r2, round(r2 / ((1 - r2) / (n - 2)), 4) AS f, round(4 + n * (ln(2 * pi() * ss / n) + 1), 4) AS aic,
  round(sd / ss, 6) AS durbin_watson, round(skew, 6) AS skew FROM m""")
def ols_summary_per_kind(spark, sf):
    s = rg.ols_summary(_signal(spark, sf), ["user_id"], "y", ["ts", "event_id"], ["kind"])
    return rounded(rounded(s.select("kind", "n", "r2", "f", "aic", "durbin_watson", "skew"), 6, "r2", "durbin_watson", "skew"), 4, "f", "aic")


@query("hash_split", f"""SELECT o_orderkey, {HASH.format(seed=42, key='o_orderkey')} % 100 >= 20 AS is_train FROM orders""")
def hash_split(spark, sf):
    return rg.hash_split(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("cross_validate", f"""WITH {SIGNAL}, x AS (SELECT CAST(user_id AS DOUBLE) AS x, y, {HASH.format(seed=42, key='event_id')} % 5 AS fold FROM d),
fit AS (SELECT g.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, sum(x * y) / sum(x * x) AS b0
  FROM (SELECT DISTINCT fold FROM x) g JOIN x ON x.fold <> g.fold GROUP BY 1),
s AS (SELECT fold, 1 - avg((y - a - b * x) * (y - a - b * x)) / var_pop(y) AS r1, 1 - avg((y - b0 * x) * (y - b0 * x)) / var_pop(y) AS r0 FROM x JOIN fit USING (fold) GROUP BY 1),
o AS (SELECT true AS fit_intercept, avg(r1) AS m, stddev_pop(r1) AS d FROM s UNION ALL SELECT false, avg(r0), stddev_pop(r0) FROM s)
SELECT CAST(row_number() OVER (ORDER BY m DESC) AS INTEGER) AS place, fit_intercept, round(m, 6) AS mean_r2, round(d, 6) AS std_r2 FROM o""")
def cross_validate(spark, sf):
    return rounded(rg.cross_validate(_signal(spark, sf), ["user_id"], "y", "event_id"), 6, "mean_r2", "std_r2")


@query("chrono_split_metrics", f"""WITH {PANEL}, t AS (SELECT *, {QI} AS q, row_number() OVER (PARTITION BY series ORDER BY period) - 1 AS i,
  COUNT(*) OVER (PARTITION BY series) AS n FROM panel),
f AS (SELECT series, regr_slope(value, q) AS b, regr_intercept(value, q) AS a FROM t WHERE i < floor(n * 0.8) GROUP BY 1),
e AS (SELECT series, value, value - a - b * q AS e FROM t JOIN f USING (series) WHERE i >= floor(n * 0.8))
SELECT series, COUNT(*) AS n, round(avg(abs(e)), 2) AS mae, round(avg(e * e), 0) AS mse, round(sqrt(avg(e * e)), 2) AS rmse,
  round(1 - avg(e * e) / var_pop(value), 6) AS r2 FROM e GROUP BY 1""")
def chrono_split_metrics(spark, sf):
    p = rg.chronological_split(panel(spark, sf), ["series"], "period")
    held = fc.trend_holdout(p, ["series"], "period", "value", "is_train")
    s = rg.regression_scores(held, "value", "prediction", ["series"])
    return rounded(rounded(rounded(s, 2, "mae", "rmse"), 0, "mse"), 6, "r2")


@query("trend_forecast", f"""WITH {PANEL}, f AS (SELECT series, regr_slope(value, {QI}) AS b, regr_intercept(value, {QI}) AS a, max({QI}) AS q, max(period) AS p FROM panel GROUP BY 1)
SELECT series, CAST(s AS INTEGER) AS step, CAST(last_day(p + to_months(CAST(3 * s + 2 AS INTEGER))) AS DATE) AS period_end, round(a + b * (q + s), 2) AS forecast
FROM f, range(1, 41) t(s)""")
def trend_forecast(spark, sf):
    return rounded(fc.trend_forecast(panel(spark, sf, stored=True), ["series"], "period", "value"), 2, "forecast")


@query("future_calendar", f"""WITH {PANEL} SELECT CAST(s AS INTEGER) AS step, CAST(last_day((SELECT max(period) FROM panel) + to_months(CAST(3 * s + 2 AS INTEGER))) AS DATE) AS period_end
FROM range(1, 41) t(s)""")
def future_calendar(spark, sf):
    return fc.future_calendar(panel(spark, sf), "period")


@query("regression_scores", f"""WITH {SIGNAL}, e AS (SELECT kind, y, y - 0.5 * user_id AS e FROM d)
SELECT kind, COUNT(*) AS n, round(avg(abs(e)), 6) AS mae, round(avg(e * e), 4) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1 - avg(e * e) / var_pop(y), 6) AS r2 FROM e GROUP BY 1""")
def regression_scores(spark, sf):
    d = _signal(spark, sf).withColumn("p", 0.5 * F.col("user_id"))
    return rounded(rounded(rg.regression_scores(d, "y", "p", ["kind"]), 6, "mae", "rmse", "r2"), 4, "mse")


LEVELS = ["region", "segment"]


def _life(spark, sf):
    """Model table: dummies of two categories, year and decade, hash split."""
    c = cut_lineage(cells(spark, sf).withColumn("decade", (F.floor(F.col("year") / 10) * 10).cast("int")), "cells")
    levels = {n: reshape.levels_of(c, n) for n in LEVELS}
    wide = reshape.dummies(c, LEVELS, levels)
    features = ["year", "decade", *[x for x in wide.columns if x.startswith(("region_", "segment_"))]]
    return rg.hash_split(wide, features, 25), features, c, levels


def _three(train, features):
    return {"tree": ml.decision_tree(train, features, "price"), "forest": ml.random_forest(train, features, "price")}


@query("tree_models")
def tree_models(spark, sf):
    d, features, _, _ = _life(spark, sf)
    train = d.where("is_train")
    linear = rg.ols(train, features, "price")
    scored = ml.score_all(rg.predict(d, linear, features, into="linear"), _three(train, features), features)
    long = scored.unpivot(["price", "is_train"], ["linear", "tree", "forest"], "model", "prediction")
    return rg.regression_scores(long.where("not is_train"), "price", "prediction", ["model"])


@query("future_scores")
def future_scores(spark, sf):
    d, features, c, levels = _life(spark, sf)
    train = d.where("is_train")
    grid = joining.category_grid(c, LEVELS, "year", 2018, 2037).withColumn("decade", (F.floor(F.col("year") / 10) * 10).cast("int"))
    wide = reshape.dummies(grid, LEVELS, levels)
    scored = ml.score_all(rg.predict(wide, rg.ols(train, features, "price"), features, into="linear"), _three(train, features), features)
    back = reshape.undummies(reshape.undummies(scored, "region", "region"), "segment", "segment")
    return ml.long_predictions(back, ["region", "segment", "year"], ["linear", "tree", "forest"])


@query("boosted_early_stop")
def boosted_early_stop(spark, sf):
    """Training, validation and test rows are three shares; the score is that of the test rows."""
    d = rg.hash_split(_signal(spark, sf), "event_id")
    d = rg.hash_split(d, "event_id", 10, seed=7, into="fitted").withColumn("validation", ~F.col("fitted"))
    features = ["user_id", "k", "h"]
    model = ml.boosted_early_stop(d.where("is_train"), features, "y", "validation")
    return rg.regression_scores(ml.score(d.where("not is_train"), model, features, "p"), "y", "p").withColumn("trees", F.lit(model.getNumTrees))


@query("forest_impute")
def forest_impute(spark, sf):
    return ml.forest_impute(gaps(spark, sf), ["user_id", "h", "k", "value"], "w").select("event_id", "w")


@query("arima_order_search")
def arima_order_search(spark, sf):
    out = arima.arima_search(panel(spark, sf, stored=True), ["series"], "period", "value")
    return out.select("series", "order", "aic", "recent_avg", "forecast_avg", "growth_rate", "forecast")


@query("arima_ranking")
def arima_ranking(spark, sf):
    out = arima.arima_search(panel(spark, sf, stored=True), ["series"], "period", "value")
    return ranking.ranked(out.select("series", "order", "recent_avg", "forecast_avg", "growth_rate"), 15, "forecast_avg", "series")


@query("seasonal_arima")
def seasonal_arima(spark, sf):
    out = arima.seasonal_arima(panel(spark, sf, stored=True), ["series"], "period", "value")
    return out.select("series", "ar", "ma", "sigma2", "forecast")


@query("seasonal_holdout")
def seasonal_holdout(spark, sf):
    held = arima.seasonal_holdout(panel(spark, sf, stored=True), ["series"], "period", "value")
    return rg.regression_scores(held, "value", "prediction", ["series"])


@query("forest_holdout")
def forest_holdout(spark, sf):
    p = cut_lineage(rg.chronological_split(panel(spark, sf, stored=True), ["series"], "period"))
    marked = cut_lineage(fc.forest_training(p, ["series"], "period", "value", fit_on=F.col("is_train")))
    model = fc.fit_panel_forest(marked.where("is_train"))
    held = ml.score(marked.where("not is_train"), model, fc.forest_features(4), "p")
    return rg.regression_scores(held, "_v", "p")


@query("forest_ranking")
def forest_ranking(spark, sf):
    p = panel(spark, sf, stored=True)
    training = cut_lineage(fc.forest_training(p, ["series"], "period", "value"))
    paths = fc.recursive_forecast(training, fc.fit_panel_forest(training), ["series"], "period")
    future = paths.groupBy("series").agg(F.avg("forecast").alias("forecast_avg"))
    return ranking.ranked(ranking.growth_table(pn.last_mean(p, ["series"], "period", "value"), future, "series"), 15, "growth_rate", "series")


@query("trend_ranking", f"""WITH {PANEL}, f AS (SELECT series, regr_intercept(value, {QI}) + regr_slope(value, {QI}) * (max({QI}) + 20.5) AS forecast_avg FROM panel GROUP BY 1),
l AS (SELECT series, avg(value) AS recent_avg FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY period DESC) AS rn FROM panel) WHERE rn <= 8 GROUP BY 1),
g AS (SELECT *, 100 * (forecast_avg - recent_avg) / recent_avg AS growth_rate FROM f JOIN l USING (series))
SELECT series, round(recent_avg, 2) AS recent_avg, round(forecast_avg, 2) AS forecast_avg, round(growth_rate, 6) AS growth_rate,
  CAST(row_number() OVER (ORDER BY growth_rate DESC, series) AS INTEGER) AS rank FROM g ORDER BY rank LIMIT 15""")
def trend_ranking(spark, sf):
    p = panel(spark, sf, stored=True)
    future = fc.trend_forecast(p, ["series"], "period", "value").groupBy("series").agg(F.avg("forecast").alias("forecast_avg"))
    table = ranking.growth_table(pn.last_mean(p, ["series"], "period", "value"), future, "series")
    return rounded(rounded(ranking.ranked(table, 15, "growth_rate", "series"), 2, "recent_avg", "forecast_avg"), 6, "growth_rate")


@query("first_predictions", f"""WITH {SIGNAL}, f AS (SELECT regr_slope(y, user_id) AS b, regr_intercept(y, user_id) AS a FROM d)
SELECT event_id, round(y, 6) AS y, round(a + b * user_id, 6) AS prediction FROM d, f ORDER BY event_id LIMIT 10""")
def first_predictions(spark, sf):
    d = _signal(spark, sf)
    out = rg.predict(d, rg.ols(d, ["user_id"], "y"), ["user_id"]).select("event_id", "y", "prediction")
    return rounded(out.orderBy("event_id").limit(10), 6, "y", "prediction")


@query("recursive_forest")
def recursive_forest(spark, sf):
    training = cut_lineage(fc.forest_training(panel(spark, sf, stored=True), ["series"], "period", "value"))
    model = fc.fit_panel_forest(training)
    return fc.recursive_forecast(training, model, ["series"], "period")


@query("joint_forest")
def joint_forest(spark, sf):
    rows = cut_lineage(fc.joint_training(panel(spark, sf, stored=True), "series", "period", "value"))
    return fc.joint_forecast(rows, fc.fit_joint_forest(rows), "period")


@query("network_early_stop")
def network_early_stop(spark, sf):
    """Scores of a dense network, stopped by a validation share, on test rows."""
    d = rg.hash_split(_signal(spark, sf), "event_id")
    d = rg.hash_split(d, "event_id", 10, seed=7, into="fitted").withColumn("validation", ~F.col("fitted"))
    features = ["user_id", "k", "h"]
    model = network.fit(d.where("is_train"), features, "y", "validation", epochs=15, steps=2)
    return rg.regression_scores(model.predict(d.where("not is_train"), "p"), "y", "p").withColumn("epochs", F.lit(len(model.losses)))


@query("network_without_layers", f"WITH {SIGNAL} SELECT CAST(unnest([min(user_id), max(user_id)]) AS BIGINT) AS user_id, true AS near FROM d")
def network_without_layers(spark, sf):
    """Without hidden layers the loss falls to that of least squares: predictions lie within three hundredths of the label's deviation of the line."""
    d = _signal(spark, sf).withColumn("held", F.lit(True))
    both = d.unionByName(d.withColumn("held", F.lit(False)))
    model = network.fit(both, ["user_id"], "y", "held", hidden=(), epochs=60, steps=1, rate=0.1, dropout=0.0, patience=60)
    line = d.agg(F.struct(F.regr_slope("y", "user_id").alias("b"), F.regr_intercept("y", "user_id").alias("a"), F.stddev_pop("y").alias("s"))).scalar()
    ends = d.agg(F.array(F.min("user_id"), F.max("user_id")).alias("ends")).select(F.explode("ends").alias("user_id")).withColumn("l", line)
    fits = F.abs(F.col("p") - F.col("l.a") - F.col("l.b") * F.col("user_id")) < 0.03 * F.col("l.s")
    return model.predict(ends, "p").select(F.col("user_id").cast("long").alias("user_id"), fits.alias("near"))


@query("ols_near_collinear", f"""WITH {SIGNAL}, s AS (SELECT var_pop(user_id) AS s11, var_pop(k) AS s22, covar_pop(user_id, k) AS s12, covar_pop(user_id, y) AS s1y,
  covar_pop(k, y) AS s2y FROM d) SELECT round((s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12), 3) AS gain FROM s""")
def ols_near_collinear(spark, sf):
    """Two features that differ by a billionth of a third: triangular factors still find how much the difference counts for."""
    d = _signal(spark, sf).withColumn("twin", F.col("k") + 1e-9 * F.col("user_id"))
    return rg.ols_qr(d, ["k", "twin"], "y").select(F.round(F.col("coef")[1] * 1e-9, 3).alias("gain"))
