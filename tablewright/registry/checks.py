"""Queries whose right answer is known in closed form, one for each model family and each repaired edge."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from tablewright.operators import arima, forecasting as fc, joining, learners as ml, neighbours, ordered, profiling as prof, regression as rg, reshape
from tablewright.operators.quantiles import exact_quantiles
from tablewright.plans import economy
from tablewright.registry.analyses import TYPES, _economy, _energy
from tablewright.registry.common import CELLS, GAPS, PANEL, cells, gaps, panel, query, r, rounded
from tablewright.registry.models import LEVELS, SIGNAL, _life, _signal, _three
from tablewright.session import cut_lineage
from tablewright.sources import html
from tablewright.sources.tables import load

# ordered rows, neighbours, quantiles, describe ------------------------------------------------------------------------


@query("lag_text_order", """SELECT c_custkey, lag(c_custkey) OVER (ORDER BY c_name) AS before,
lag(c_custkey) OVER (PARTITION BY c_mktsegment ORDER BY c_name) AS before_in_segment FROM customer""")
def lag_text_order(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    c = ordered.lag_along(c, [], ["c_name"], "c_custkey", "before", chunks=16)
    return ordered.lag_along(c, ["c_mktsegment"], ["c_name"], "c_custkey", "before_in_segment", chunks=16).drop("c_name", "c_mktsegment")


@query("knn_impute_saturated", f"""WITH {GAPS}, g AS (SELECT event_id, v, k, least(h, 8) AS h FROM gaps),
p AS (SELECT a.event_id, b.v, row_number() OVER (PARTITION BY a.event_id ORDER BY (a.h - b.h) * (a.h - b.h) + (a.k - b.k) * (a.k - b.k), b.event_id) AS rn
  FROM g a JOIN g b ON a.v IS NULL AND b.v IS NOT NULL)
SELECT event_id, round(avg(v), 6) AS v FROM p WHERE rn <= 5 GROUP BY 1 UNION ALL SELECT event_id, round(v, 6) FROM g WHERE v IS NOT NULL""")
def knn_impute_saturated(spark, sf):
    """More than half of the hours tie at the highest value of their column."""
    g = gaps(spark, sf).select("event_id", "v", "k", F.least("h", F.lit(8)).alias("h"))
    return neighbours.knn_impute(g, "event_id", ["h", "k"], "v", 5).select("event_id", r("v", 6).alias("v"))


@query("quantiles_hot", f"""WITH {GAPS} SELECT CASE WHEN event_id % 3 <> 0 THEN 'hot' ELSE kind END AS g, COUNT(value) AS n,
{", ".join(f"round(quantile_cont(value, {p}), 6) AS q{int(p * 100)}" for p in (0.01, 0.5, 0.95))} FROM gaps GROUP BY 1""")
def quantiles_hot(spark, sf):
    """One group holds two thirds of the rows, one has a missing key."""
    g = gaps(spark, sf).withColumn("g", F.when(F.col("event_id") % 3 != 0, "hot").otherwise(F.col("kind")))
    q = exact_quantiles(g, ["value"], [0.01, 0.5, 0.95], ["g"])
    return q.select("g", "n", *[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("q1", "q50", "q95"))])


@query("describe_empty_column", """SELECT o_orderstatus AS status, 'price' AS "column", COUNT(*) AS "count", round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS q50 FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, 'empty', 0, NULL, NULL FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, 'only_f', COUNT(*) FILTER (o_orderstatus = 'F'), round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 4), round(median(o_totalprice) FILTER (o_orderstatus = 'F'), 4) FROM orders GROUP BY 1""")
def describe_empty_column(spark, sf):
    price = F.col("o_totalprice")
    o = load(spark, sf, "orders").select(F.col("o_orderstatus").alias("status"), price.alias("price"), F.lit(None).cast("double").alias("empty"),
                                         F.when(F.col("o_orderstatus") == "F", price).alias("only_f"))
    return rounded(prof.describe(o, ["price", "empty", "only_f"], ["status"]).select("status", "column", "count", "mean", "q50"), 4, "mean", "q50")


@query("html_rejects", """SELECT c_nationkey AS page, (c_custkey % 5 = 0)::INT AS rejected, COUNT(*) AS n FROM customer GROUP BY 1, 2""")
def html_rejects(spark, sf):
    """One page per nation; every fifth customer's row has a cell too many."""
    extra = F.when(F.col("c_custkey") % 5 == 0, "<td>more</td>").otherwise("")
    tr = F.concat(F.lit("<tr><td>"), F.col("c_custkey").cast("string"), F.lit("</td><td>x</td>"), extra, F.lit("</tr>"))
    pages = load(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("page")).agg(
        F.concat(F.lit('<table id="t">'), F.array_join(F.collect_list(tr), ""), F.lit("</table>")).alias("html"))
    good = html.table_rows(pages, "html", "t", ["key", "mark"], ["page"]).select("page", F.lit(0).alias("rejected"))
    bad = html.rejected_rows(pages, "html", "t", ["key", "mark"], ["page"]).select("page", F.lit(1).alias("rejected"))
    return good.unionByName(bad).groupBy("page", "rejected").agg(F.count("*").alias("n"))


# linear models: residuals are orthogonal to the constant and to every feature -------------------------------------------


def normal_equations(df, features, label, by=()):
    """by..., term, residual: |sum of residual x term| relative to the term's absolute sum, zero for a least-squares fit."""
    fitted = rg.predict(df, rg.ols(df, features, label, by), features, by, "_p")
    e = F.col(label).cast("double") - F.col("_p")
    terms = {"const": F.lit(1.0), **{f: F.col(f).cast("double") for f in features}}
    per = [F.struct(F.lit(n).alias("term"), F.abs(F.round(F.sum(e * x) / F.sum(F.abs(x)) / F.max(F.abs(F.col(label))), 5)).alias("residual"))
           for n, x in terms.items()]
    return (fitted.groupBy(*by) if by else fitted.groupBy()).agg(F.array(*per).alias("_a")).select(*by, F.inline("_a"))


def _zeros(terms, groups: str = "") -> str:
    from_ = f", {groups} " if groups else " "
    names = "kind, " if groups else ""
    return f"SELECT {names}term, CAST(0 AS DOUBLE) AS residual FROM (SELECT unnest({['const', *terms]}) AS term){from_}"


@query("energy_normal_equations", _zeros(["month", "year", "day_of_week", *TYPES[:5]]))
def energy_normal_equations(spark, sf):
    d = ml.date_features(_energy(spark, sf), "Month")
    return normal_equations(d, ["month", "year", "day_of_week", *TYPES[:5]], "all_fuels")


@query("economy_normal_equations", _zeros(economy.FEATURES))
def economy_normal_equations(spark, sf):
    ready = economy.prepare(*_economy(spark, sf), since=1996).withColumnRenamed(economy.OUTPUT, "output")
    return normal_equations(ready, economy.FEATURES, "output")


@query("ols_group_normal_equations", f"WITH {SIGNAL}" + _zeros(["user_id", "k", "h"], "(SELECT DISTINCT kind FROM d)"))
def ols_group_normal_equations(spark, sf):
    return normal_equations(_signal(spark, sf), ["user_id", "k", "h"], "y", ["kind"])


@query("ols_summary_tests", f"""WITH {SIGNAL}, f AS (SELECT regr_slope(y, user_id) AS b, regr_intercept(y, user_id) AS a, avg(user_id) AS m, var_pop(user_id) AS s FROM d),
e AS (SELECT y - a - b * user_id AS e FROM d, f),
p AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, avg(e * e * e) / pow(avg(e * e), 1.5) AS skew, avg(e * e * e * e) / pow(avg(e * e), 2) AS kurt FROM e),
q AS (SELECT *, 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS b2,
  (kurt - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
  6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS sb FROM p),
t AS (SELECT *, sqrt(2 * (b2 - 1)) - 1 AS w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) AS g FROM q),
z AS (SELECT *, asinh(skew * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1,
  ((1 - 2 / (9 * g)) - cbrt((1 - 2 / g) / (1 + x * sqrt(2 / (g - 4))))) / sqrt(2 / (9 * g)) AS z2 FROM t),
c AS (SELECT 1 + m * m + s AS tr, s AS det FROM f)
SELECT round(z1 * z1 + z2 * z2, 4) AS omnibus, round(exp(-(z1 * z1 + z2 * z2) / 2), 8) AS omnibus_p,
  round(exp(-n / 12 * (skew * skew + (kurt - 3) * (kurt - 3) / 4)), 8) AS jb_p,
  round(sqrt((tr + sqrt(tr * tr - 4 * det)) / (tr - sqrt(tr * tr - 4 * det))), 4) AS cond FROM z, c""")
def ols_summary_tests(spark, sf):
    s = rg.ols_summary(_signal(spark, sf), ["user_id"], "y", ["ts", "event_id"]).select("omnibus", "omnibus_p", "jb_p", "cond")
    return rounded(rounded(s, 4, "omnibus", "cond"), 8, "omnibus_p", "jb_p")


# trees: a label that is a step function of a small whole number ---------------------------------------------------------

STEP = "CAST((h * 7) % 5 AS DOUBLE)"


@query("tree_steps", f"""WITH {GAPS} SELECT h, round(avg(value), 6) AS tree, {STEP} AS forest, {STEP} AS boosted FROM gaps GROUP BY h""")
def tree_steps(spark, sf):
    """A full tree predicts group means; forest and (to a tenth) boosting reproduce a label that depends on the hour alone."""
    g = gaps(spark, sf).withColumn("step", ((F.col("h") * 7) % 5).cast("double")).withColumn("valid", F.col("event_id") % 10 == 0)
    models = {"tree": ml.decision_tree(g, ["h"], "value"), "forest": ml.random_forest(g, ["h"], "step"),
              "boosted": ml.boosted_early_stop(g, ["h"], "step", "valid", max_depth=10)}
    scored = ml.score_all(g.select("h").distinct(), models, ["h"])
    return scored.select("h", *[(F.round(m, 1 if m == "boosted" else 6) + 0.0).alias(m) for m in models])  # no negative zero


@query("forest_impute_steps", f"""WITH {GAPS} SELECT event_id, {STEP} AS s FROM gaps""")
def forest_impute_steps(spark, sf):
    step = ((F.col("h") * 7) % 5).cast("double")
    g = gaps(spark, sf).select("event_id", "h", F.when(F.col("event_id") % 7 != 0, step).alias("s"))
    return ml.forest_impute(g, ["h"], "s").select("event_id", (F.round("s", 6) + 0.0).alias("s"))


@query("future_score_rows", f"""WITH {CELLS} SELECT r.region, s.segment, CAST(y AS INTEGER) AS year, m AS model, true AS scored
FROM (SELECT DISTINCT region FROM cells) r, (SELECT DISTINCT segment FROM cells) s, range(2018, 2038) t(y), (VALUES ('linear'), ('tree'), ('forest')) v(m)""")
def future_score_rows(spark, sf):
    """Every combination of the grid is scored by every model, in the range of the training label (linear: finite)."""
    d, features, c, levels = _life(spark, sf)
    train = d.where("is_train")
    grid = joining.category_grid(c, LEVELS, "year", 2018, 2037).withColumn("decade", (F.floor(F.col("year") / 10) * 10).cast("int"))
    wide = reshape.dummies(grid, LEVELS, levels)
    scored = ml.score_all(rg.predict(wide, rg.ols(train, features, "price"), features, into="linear"), _three(train, features), features)
    back = reshape.undummies(reshape.undummies(scored, "region", "region"), "segment", "segment")
    long = ml.long_predictions(back, ["region", "segment", "year"], ["linear", "tree", "forest"])
    limits = train.agg(F.struct(F.min("price").alias("lo"), F.max("price").alias("hi"))).scalar()
    p = F.col("prediction")
    fine = F.when(F.col("model") == "linear", F.abs(p) < float("inf")).otherwise(p.between(F.col("_l.lo") - 1e-6, F.col("_l.hi") + 1e-6))
    return long.withColumn("_l", limits).select("region", "segment", "year", "model", F.coalesce(fine, F.lit(False)).alias("scored"))


# forecasts --------------------------------------------------------------------------------------------------------------

NUMBER = "CAST(split_part(series, '#', 2) AS INTEGER)"


def _number():
    return F.split("series", "#")[1].cast("int")


@query("arima_zero_series", f"""WITH {PANEL} SELECT series, CAST(0 AS DOUBLE) AS arima, CAST(0 AS DOUBLE) AS seasonal, CAST(0 AS DOUBLE) AS forest
FROM (SELECT DISTINCT series FROM panel) WHERE {NUMBER} % 2 = 0""")
def arima_zero_series(spark, sf):
    """Series of zeros among others are forecast too, as zeros."""
    p = panel(spark, sf, stored=True).withColumn("value", F.when(_number() % 2 == 0, 0.0).otherwise(F.col("value")))
    def total(frame, name):
        return frame.where(_number() % 2 == 0).select("series", F.abs(F.round(F.aggregate(
            F.transform("forecast", F.abs), F.lit(0.0), lambda a, x: a + x), 9)).alias(name))
    searched = total(arima.arima_search(p, ["series"], "period", "value"), "arima")
    seasonal = total(arima.seasonal_arima(p, ["series"], "period", "value"), "seasonal")
    zeros = p.where(_number() % 2 == 0)
    training = fc.forest_training(zeros, ["series"], "period", "value")
    paths = fc.recursive_forecast(training, fc.fit_panel_forest(training), ["series"], "period")
    forest = paths.groupBy("series").agg(F.abs(F.round(F.sum(F.abs("forecast")), 9)).alias("forest"))
    return searched.join(seasonal, "series").join(forest, "series")


def _refined(levels: int, form: str) -> str:
    """CTEs g1, b1, g2, b2, ...: the best coefficient of a grid of hundredths, then of ever finer ones around it. ``form`` scores a grid."""
    out = ["g1 AS (SELECT *, i / 100.0 AS c FROM sums, range(-99, 100) t(i))"]
    for k in range(1, levels + 1):
        if k > 1:
            out.append(f"g{k} AS (SELECT sums.*, c + i / {100 ** k}.0 AS c FROM b{k - 1} JOIN sums USING (series, d), range(-100, 101) t(i) WHERE abs(c + i / {100 ** k}.0) < 1)")
        out.append(form.replace("{g}", f"g{k}").replace("{k}", str(k)))
        out.append(f"b{k} AS (SELECT series, d, c, dev, m FROM s{k} QUALIFY row_number() OVER (PARTITION BY series, d ORDER BY dev) = 1)")
    return ",\n".join(out)


# exact likelihood of a first-order autoregression, with the mean that is best for each coefficient
AR1_SCORE = """s{k} AS (SELECT *, n * (ln(2 * pi() * ss / n) + 1) - ln(1 - c * c) AS dev FROM (SELECT *, (1 - c * c) * pow(first - m, 2) + a - 2 * c * x + c * c * b
    - 2 * (1 - c) * m * (s1 - c * s0) + (n - 1) * pow((1 - c) * m, 2) AS ss
  FROM (SELECT *, CASE WHEN d = 0 THEN ((1 - c * c) * first + (1 - c) * (s1 - c * s0)) / ((1 - c * c) + (n - 1) * pow(1 - c, 2)) ELSE 0 END AS m FROM {g})))"""
AR1 = f"""WITH RECURSIVE {PANEL}, l AS (SELECT series, avg(abs(value)) AS level FROM panel GROUP BY 1),
y AS (SELECT series, period, value / level AS y FROM panel JOIN l USING (series)),
w AS (SELECT series, 0 AS d, period, y AS w FROM y
  UNION ALL SELECT * FROM (SELECT series, 1, period, y - lag(y) OVER (PARTITION BY series ORDER BY period) AS w FROM y) WHERE w IS NOT NULL),
lagged AS (SELECT *, lag(w) OVER (PARTITION BY series, d ORDER BY period) AS v FROM w),
sums AS (SELECT series, d, CAST(COUNT(*) AS DOUBLE) AS n, sum(w) FILTER (v IS NULL) AS first, sum(w) FILTER (v IS NOT NULL) AS s1, sum(v) AS s0,
  sum(w * w) FILTER (v IS NOT NULL) AS a, sum(v * v) AS b, sum(w * v) AS x FROM lagged GROUP BY 1, 2),
{_refined(4, AR1_SCORE)},
o AS (SELECT series, d, 1 AS p, c, m, dev + 2 * (CASE WHEN d = 0 THEN 3 ELSE 2 END) AS aic FROM b4
  UNION ALL SELECT series, d, 0, 0.0, CASE WHEN d = 0 THEN mu ELSE 0 END, n * (ln(2 * pi() * CASE WHEN d = 0 THEN vp ELSE sq END) + 1) + 2 * (CASE WHEN d = 0 THEN 2 ELSE 1 END)
    FROM (SELECT series, d, CAST(COUNT(*) AS DOUBLE) AS n, avg(w) AS mu, var_pop(w) AS vp, avg(w * w) AS sq FROM w GROUP BY 1, 2)),
best AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY series ORDER BY aic, p, d) = 1),
last AS (SELECT series, y, y1 FROM (SELECT *, lag(y) OVER (PARTITION BY series ORDER BY period) AS y1 FROM y)
  QUALIFY row_number() OVER (PARTITION BY series ORDER BY period DESC) = 1),
r AS (SELECT series, 0 AS step, y, y1 FROM last
  UNION ALL SELECT r.series, step + 1, CASE WHEN d = 0 THEN m + c * (y - m) ELSE y + c * (y - y1) END, y FROM r JOIN best USING (series) WHERE step < 40)
SELECT series, step, CAST(p AS INTEGER) AS p, CAST(d AS INTEGER) AS d, round(aic, 4) AS aic, round(c, 4) AS phi, round(y, 3) AS forecast FROM r JOIN best USING (series) WHERE step > 0"""


def _level(frame):
    return frame.groupBy("series").agg(F.avg(F.abs("value")).alias("level"))


@query("arima_ar1", AR1)
def arima_ar1(spark, sf):
    """The order search over p, d <= 1 without moving average: order, AIC, coefficient and forecasts of the exact likelihood."""
    p = panel(spark, sf, stored=True)
    out = arima.arima_search(p, ["series"], "period", "value", max_p=1, max_d=1, max_q=0).join(_level(p), "series")
    steps = out.select("series", "order", "aic", "level", F.coalesce(F.get("ar", F.lit(0)), F.lit(0.0)).alias("phi"), F.posexplode("forecast").alias("i", "f"))
    return steps.select("series", (F.col("i") + 1).cast("int").alias("step"), F.col("order.p").alias("p"), F.col("order.d").alias("d"),
                        r("aic").alias("aic"), (r("phi", 4) + 0.0).alias("phi"), r(F.col("f") / F.col("level"), 3).alias("forecast"))


# exact likelihood of a first-order moving average by the innovations of series and ones, from which the mean follows
MA1_SCORE = """k{k} AS (SELECT g.series, g.d, c, 1 AS t, 1 + c * c AS f, w AS v, CAST(1 AS DOUBLE) AS o, ln(1 + c * c) AS logs, w * w / (1 + c * c) AS yy,
    w / (1 + c * c) AS yo, 1 / (1 + c * c) AS oo FROM {g} g JOIN w ON w.series = g.series AND w.t = 1
  UNION ALL SELECT k.series, k.d, c, n.t, n.f, n.v, n.o, logs + ln(n.f), yy + n.v * n.v / n.f, yo + n.v * n.o / n.f, oo + n.o * n.o / n.f
    FROM (SELECT k.*, w.t AS nt, 1 + c * c - c * c / f AS nf, w - c * v / f AS nv, 1 - c * o / f AS no FROM k{k} k JOIN w ON w.series = k.series AND w.t = k.t + 1) k,
      LATERAL (SELECT nt AS t, nf AS f, nv AS v, no AS o) n),
s{k} AS (SELECT series, d, c, yo / oo AS m, n * (ln(2 * pi() * (yy - yo * yo / oo) / n) + 1) + logs AS dev FROM k{k} JOIN sums USING (series, d) WHERE t = n)"""
MA1 = f"""WITH RECURSIVE {PANEL}, mixed AS (SELECT series, period, value + 0.7 * lag(value) OVER (PARTITION BY series ORDER BY period) AS value FROM panel),
l AS (SELECT series, avg(abs(value)) AS level FROM mixed WHERE value IS NOT NULL GROUP BY 1),
w AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY period) AS t, value / level AS w FROM mixed JOIN l USING (series) WHERE value IS NOT NULL),
sums AS (SELECT series, 0 AS d, CAST(COUNT(*) AS DOUBLE) AS n FROM w GROUP BY 1),
{_refined(4, MA1_SCORE)},
o AS (SELECT series, 1 AS q, c, dev + 6 AS aic FROM b4 UNION ALL SELECT series, 0, 0.0, COUNT(*) * (ln(2 * pi() * var_pop(w)) + 1) + 4 FROM w GROUP BY 1)
SELECT series, CAST(q AS INTEGER) AS q, round(aic, 3) AS aic, round(c, 3) AS theta FROM o QUALIFY row_number() OVER (PARTITION BY series ORDER BY aic, q) = 1"""


@query("arima_ma1", MA1)
def arima_ma1(spark, sf):
    """Whether a first-order moving average beats none, by the AIC of the exact likelihood, on sums of neighbouring quarters."""
    before = F.lag("value").over(Window.partitionBy("series").orderBy("period"))
    mixed = panel(spark, sf, stored=True).withColumn("value", F.col("value") + 0.7 * before).where("value is not null")
    out = arima.arima_search(mixed, ["series"], "period", "value", max_p=0, max_d=0, max_q=1)
    return out.select("series", "order.q", r("aic", 3).alias("aic"), (r(F.coalesce(F.get("ma", F.lit(0)), F.lit(0.0)), 3) + 0.0).alias("theta"))


@query("seasonal_continuation", f"""WITH {PANEL.replace("p_brand", "p_type")}, m AS (SELECT min({{q}}) AS a, max({{q}}) AS b FROM panel)
SELECT series, CAST(s AS INTEGER) AS step, CAST(100 + 5 * (b + s - a) + 10 * ((b + s) % 4) + length(series) AS DOUBLE) AS forecast
FROM (SELECT DISTINCT series FROM panel), m, range(1, 13) t(s)""".replace("{q}", "year(period) * 4 + quarter(period) - 1"))
def seasonal_continuation(spark, sf):
    """A line plus a fixed season is continued exactly by the seasonal model."""
    p = panel(spark, sf, "p_type", stored=True).withColumn("q", F.year("period") * 4 + F.quarter("period") - 1)
    first = p.agg(F.min("q")).scalar()
    p = p.withColumn("value", (100 + 5 * (F.col("q") - first) + 10 * (F.col("q") % 4) + F.length("series")).cast("double")).drop("q")
    out = arima.seasonal_arima(p, ["series"], "period", "value", 12).select("series", F.posexplode("forecast").alias("i", "forecast"))
    return out.select("series", (F.col("i") + 1).cast("int").alias("step"), r("forecast", 6).alias("forecast"))


@query("recursive_forest_calendar", f"""WITH {PANEL}, last AS (SELECT series, max(period) AS p, min(value) AS lo, max(value) AS hi FROM panel GROUP BY 1)
SELECT series, CAST(s AS INTEGER) AS step, CAST(last_day(p + to_months(CAST(3 * s + 2 AS INTEGER))) AS DATE) AS period_end, true AS within FROM last, range(1, 41) t(s)""")
def recursive_forest_calendar(spark, sf):
    """Steps, dates, and forecasts inside the panel's scaled range, which a forest cannot leave."""
    training = fc.forest_training(panel(spark, sf, stored=True), ["series"], "period", "value")
    limits = training.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"))).scalar()
    paths = fc.recursive_forecast(training, fc.fit_panel_forest(training), ["series"], "period")
    level = training.groupBy("series").agg(F.max("_level").alias("_level"))
    scaled = F.col("forecast") / F.col("_level")
    return paths.join(level, "series").withColumn("_l", limits).select(
        "series", "step", "period_end", scaled.between(F.col("_l.lo") - 1e-9, F.col("_l.hi") + 1e-9).alias("within"))


JOINT = f"""WITH {PANEL}, whole AS (SELECT period, list(value ORDER BY series) AS y, list(series ORDER BY series) AS names FROM panel GROUP BY 1
  HAVING COUNT(*) = (SELECT COUNT(DISTINCT series) FROM panel)),
joint AS (SELECT * FROM (SELECT period, names, y, year(period) AS yr, quarter(period) AS qu, lag(y) OVER w AS l1, lag(y, 2) OVER w AS l2, lag(y, 3) OVER w AS l3,
  lag(y, 4) OVER w AS l4 FROM whole WINDOW w AS (ORDER BY period)) WHERE l4 IS NOT NULL)"""


@query("joint_forest_pure", f"""{JOINT} SELECT period, unnest(names) AS series, round(unnest(y), 4) AS prediction FROM joint""")
def joint_forest_pure(spark, sf):
    """One tree on all rows, grown to purity, returns every series of every period."""
    rows = cut_lineage(fc.joint_training(panel(spark, sf, stored=True), "series", "period", "value"))
    model = fc.fit_joint_forest(rows, 1, None, 2, bootstrap=False)
    return fc.joint_scores(rows, model, "period").select("period", "series", F.round("prediction", 4).alias("prediction"))


@query("joint_forest_stump", f"""{JOINT}, x AS (SELECT period, unnest(list_concat([yr, qu], l1, l2, l3, l4)) AS x, unnest(range(1, 3 + 4 * len(y))) AS f FROM joint),
y AS (SELECT period, unnest(names) AS series, unnest(y) AS y FROM joint),
cuts AS (SELECT DISTINCT f, x AS cut FROM x),
sides AS (SELECT f, cut, period, x <= cut AS low FROM x JOIN cuts USING (f)),
both_sides AS (SELECT f, cut FROM sides GROUP BY 1, 2 HAVING bool_or(low) AND NOT bool_and(low)),
sums AS (SELECT f, cut, low, series, COUNT(*) AS n, sum(y - m) AS s FROM sides JOIN both_sides USING (f, cut) JOIN y USING (period)
  JOIN (SELECT series, avg(y) AS m FROM y GROUP BY 1) USING (series) GROUP BY ALL),
best AS (SELECT f, cut FROM sums GROUP BY 1, 2 ORDER BY sum(s * s / n) DESC LIMIT 1),
placed AS (SELECT period, low FROM sides JOIN best USING (f, cut))
SELECT period, series, round(avg(y) OVER (PARTITION BY low, series), 4) AS prediction FROM y JOIN placed USING (period)""")
def joint_forest_stump(spark, sf):
    """The first split is the one with the least squared error summed over all series."""
    rows = cut_lineage(fc.joint_training(panel(spark, sf, stored=True), "series", "period", "value"))
    model = fc.fit_joint_forest(rows, 1, 1, 2, bootstrap=False)
    return fc.joint_scores(rows, model, "period").select("period", "series", F.round("prediction", 4).alias("prediction"))


@query("joint_forest_calendar", f"""{JOINT}, last AS (SELECT max(period) AS p FROM joint)
SELECT series, CAST(s AS INTEGER) AS step, CAST(last_day(p + to_months(CAST(3 * s + 2 AS INTEGER))) AS DATE) AS period_end, true AS within
FROM (SELECT DISTINCT unnest(names) AS series FROM joint), last, range(1, 41) t(s)""")
def joint_forest_calendar(spark, sf):
    """Every series, step and date; forecasts stay in the range of the series' own training values."""
    rows = cut_lineage(fc.joint_training(panel(spark, sf, stored=True), "series", "period", "value"))
    paths = fc.joint_forecast(rows, fc.fit_joint_forest(rows), "period")
    each = rows.select(F.inline(F.arrays_zip("names", "y"))).groupBy(F.col("names").alias("series")).agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    return paths.join(each, "series").select("series", "step", "period_end", F.col("forecast").between(F.col("lo") * (1 - 1e-12), F.col("hi") * (1 + 1e-12)).alias("within"))


@query("calendar_features", """SELECT o_orderkey, [CAST(month(o_orderdate) AS DOUBLE), CAST(year(o_orderdate) AS DOUBLE), CAST(isodow(o_orderdate) - 1 AS DOUBLE),
  CAST(o_totalprice AS DOUBLE)] AS features FROM orders""")
def calendar_features(spark, sf):
    o = ml.date_features(load(spark, sf, "orders"), "o_orderdate")
    ready = ml.assemble(o, ["month", "year", "day_of_week", "o_totalprice"])
    return ready.select("o_orderkey", vector_to_array(ml.VECTOR).alias("features"))
