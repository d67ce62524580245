"""Enrichment, alignment, backfill and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.numbers import cents, decade
from tablewright.operators import filters, joining, ranking
from tablewright.registry.common import NATION_YEAR, nation_year, query, revenue, rounded
from tablewright.sources.tables import literal_table, load

# fixed values: name corrections, applied once (two entries point at each other)
CORRECTIONS = {"NATION_1": "NATION_2", "NATION_2": "NATION_1", "NATION_3": "Third Nation", "NATION_24": "Last Nation"}
CORRECTIONS_SQL = "CASE n_name " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in CORRECTIONS.items()) + " ELSE n_name END"


@query("left_enrich", """WITH d AS (SELECT n_name AS entity, CAST(floor(year(o_orderdate) / 10.0) * 10 AS INTEGER) AS decade, COUNT(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT entity, decade, orders, pop FROM d LEFT JOIN (SELECT CAST(floor(year(l_shipdate) / 10.0) * 10 AS INTEGER) AS decade, COUNT(*) AS pop
FROM lineitem GROUP BY 1) USING (decade)""")
def left_enrich(spark, sf):
    fact = nation_year(spark, sf).groupBy("entity", decade(F.col("year")).alias("decade")).agg(F.sum("orders").alias("orders"))
    lines = load(spark, sf, "lineitem")
    dim = lines.groupBy(decade(F.year("l_shipdate")).alias("decade")).agg(F.count("*").alias("pop"))
    return joining.lookup(fact, dim, "decade")


@query("latest_year_join", f"""WITH {NATION_YEAR} SELECT a.entity, a.year, a.orders, b.total FROM nation_year a
JOIN nation_year b ON a.entity = b.entity AND a.year = b.year
WHERE b.year = (SELECT max(year) FROM nation_year) AND b.total > 2000000""")
def latest_year_join(spark, sf):
    ny = nation_year(spark, sf, stored=True)
    gdp = ny.select("entity", "year", F.when(F.col("total") > 2000000, F.col("total")).alias("total"))
    return joining.inner_on_latest(ny.select("entity", "year", "orders"), gdp, ["entity"], "year", ["total"])


@query("three_way_year", """SELECT o.o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, a.items AS api_items, h.total AS html_total FROM orders o
JOIN (SELECT year(l_shipdate) AS y, COUNT(*) AS items FROM lineitem GROUP BY 1) a ON year(o.o_orderdate) = a.y
JOIN (SELECT year(o_orderdate) AS y, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1) h ON year(o.o_orderdate) = h.y""")
def three_way_year(spark, sf):
    orders = load(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    api = load(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.count("*").alias("items"))
    html = orders.groupBy("year").agg(F.sum(cents(F.col("o_totalprice"))).cast("double").alias("total"))
    return joining.three_way_join(orders.select("o_orderkey", "year"), api, html, "year")


@query("year_join_totals", """SELECT CAST(y AS INTEGER) AS year, COUNT(*) AS joined_rows, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_quantity,
  CAST(SUM(one) AS BIGINT) AS sum_one FROM (SELECT year(l_shipdate) AS y, l_quantity FROM lineitem)
JOIN (SELECT year(o_orderdate) AS y, 1 AS one FROM orders) USING (y) GROUP BY 1""")
def year_join_totals(spark, sf):
    lines = load(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), F.col("l_quantity").cast("bigint").alias("quantity"))
    orders = load(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.lit(1).cast("bigint").alias("one"))
    return joining.many_to_many_totals(lines, orders, "year", "quantity", "one")


STATUS = ["F", "O", "P"]
MISSING = {"F": 1, "O": 2, "P": 3}  # months, modulo five, in which a status has no figure


def _status(spark, sf):
    o = load(spark, sf, "orders").withColumn("month", F.trunc("o_orderdate", "month"))
    frames = []
    for s in STATUS:
        # every order is read; a status misses the months its rule takes from it
        held = (F.col("o_orderstatus") == s) & (F.month("o_orderdate") % 5 != MISSING[s])
        frames.append(o.where(held).groupBy("month").agg(F.count("*").alias(f"n_{s}")))
    return frames


STATUS_SQL = ", ".join(f"""s{s} AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS "n_{s}" FROM orders
WHERE o_orderstatus = '{s}' AND month(o_orderdate) % 5 <> {MISSING[s]} GROUP BY 1)""" for s in STATUS)


@query("outer_align", f"WITH {STATUS_SQL} SELECT * FROM sF FULL JOIN sO USING (month) FULL JOIN sP USING (month)")
def outer_align(spark, sf):
    return joining.align_outer(_status(spark, sf), "month")


@query("master_table", f"""WITH {STATUS_SQL}, m AS (SELECT * FROM sF FULL JOIN sO USING (month) FULL JOIN sP USING (month))
SELECT month, "n_F" AS target, "n_O", "n_P", (SELECT COUNT(*) FROM m) - (SELECT COUNT(*) FROM m WHERE "n_F" IS NOT NULL AND "n_O" IS NOT NULL AND "n_P" IS NOT NULL) AS removed
FROM m WHERE "n_F" IS NOT NULL AND "n_O" IS NOT NULL AND "n_P" IS NOT NULL""")
def master_table(spark, sf):
    m = joining.align_outer(_status(spark, sf), "month").withColumnRenamed("n_F", "target")
    ready = filters.complete_rows(m)
    removed = m.agg(F.count("*")).scalar() - ready.agg(F.count("*")).scalar()
    return ready.withColumn("removed", removed)


@query("range_align", f"""WITH {STATUS_SQL}, b AS (SELECT greatest((SELECT min(month) FROM sF), (SELECT min(month) FROM sP)) AS lo,
least((SELECT max(month) FROM sF), (SELECT max(month) FROM sP)) AS hi)
SELECT 'F' AS part, month, "n_F" AS n FROM sF, b WHERE month BETWEEN lo AND hi
UNION ALL SELECT 'P', month, "n_P" FROM sP, b WHERE month BETWEEN lo AND hi""")
def range_align(spark, sf):
    f, _, p = _status(spark, sf)
    a, b = joining.common_range([f, p], "month")
    return a.select(F.lit("F").alias("part"), "month", F.col("n_F").alias("n")).unionByName(
        b.select(F.lit("P").alias("part"), "month", F.col("n_P").alias("n")))


@query("name_map", f"SELECT n_nationkey, {CORRECTIONS_SQL} AS canonical FROM nation")
def name_map(spark, sf):
    return load(spark, sf, "nation").select("n_nationkey", joining.map_values(F.col("n_name"), CORRECTIONS).alias("canonical"))


@query("name_map_table", f"SELECT c_custkey, {CORRECTIONS_SQL} AS canonical FROM customer JOIN nation ON c_nationkey = n_nationkey")
def name_map_table(spark, sf):
    c = load(spark, sf, "customer").join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    table = literal_table(spark, list(CORRECTIONS.items()), "source string, target string")
    return joining.map_through(c.select("c_custkey", "n_name"), "n_name", table, "source", "target", "canonical").drop("n_name")


@query("backfill_anti", f"""WITH have AS (SELECT n_name AS country, CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer
  JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 3 <> 0 GROUP BY 1),
sup AS (SELECT n_name AS country, COUNT(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
listed AS (SELECT n_name AS country, {CORRECTIONS_SQL} AS entity FROM nation)
SELECT country, balance, CAST(NULL AS BIGINT) AS suppliers, CAST(NULL AS INTEGER) AS code, CAST(NULL AS INTEGER) AS year FROM have
UNION ALL SELECT country, NULL, suppliers, code, 2023 FROM listed LEFT JOIN sup USING (country)
LEFT JOIN (SELECT n_name AS entity, n_nationkey AS code FROM nation) USING (entity) WHERE country NOT IN (SELECT country FROM have)""")
def backfill_anti(spark, sf):
    nation = load(spark, sf, "nation")
    # every third nation is one the listed countries have to supply
    held = load(spark, sf, "customer").join(nation.where("n_nationkey % 3 <> 0"), F.col("c_nationkey") == F.col("n_nationkey"))
    have = held.groupBy(F.col("n_name").alias("country")).agg(F.sum(cents(F.col("c_acctbal"))).cast("double").alias("balance"))
    have = have.select("country", "balance", *[F.lit(None).cast(t).alias(c) for c, t in (("suppliers", "bigint"), ("code", "int"), ("year", "int"))])
    sup = load(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(
        F.col("n_name").alias("name")).agg(F.count("*").alias("suppliers"))
    listed = nation.select(F.col("n_name").alias("country"), joining.map_values(F.col("n_name"), CORRECTIONS).alias("entity"))
    codes = nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code"))
    return joining.backfill_missing(have, listed, "country", [(sup, "name", "country"), (codes, "name", "entity")],
                                    {"year": F.lit(2023)})


@query("topk_semi", """WITH t AS (SELECT l_partkey FROM lineitem GROUP BY 1
  ORDER BY SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) DESC, l_partkey LIMIT 10)
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM t)""")
def topk_semi(spark, sf):
    lines = load(spark, sf, "lineitem")
    best = ranking.top(lines.groupBy("l_partkey").agg(F.sum(revenue()).alias("revenue")), 10, "revenue", "l_partkey")
    return joining.semi_top(lines, "l_partkey", best).select("l_orderkey", "l_linenumber", "l_partkey")


@query("not_in_list", """SELECT n_name, COUNT(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name NOT IN ('NATION_0', 'NATION_7', 'NATION_11') GROUP BY 1""")
def not_in_list(spark, sf):
    c = load(spark, sf, "customer").join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return filters.in_list(c, "n_name", ["NATION_0", "NATION_7", "NATION_11"], negate=True).groupBy("n_name").agg(
        F.count("*").alias("customers"))


@query("future_grid", """SELECT segment, flag, CAST(y AS INTEGER) AS year FROM (SELECT DISTINCT c_mktsegment AS segment FROM customer),
(SELECT DISTINCT o_orderpriority AS flag FROM orders), range(2018, 2038) t(y)""")
def future_grid(spark, sf):
    c, o = load(spark, sf, "customer"), load(spark, sf, "orders")
    both = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("segment"), F.col("o_orderpriority").alias("flag"))
    return joining.category_grid(both, ["segment", "flag"], "year", 2018, 2037)


@query("union_chunks", """SELECT o_orderstatus AS status, COUNT(*) AS n FROM orders GROUP BY 1
UNION ALL SELECT l_linestatus, COUNT(*) FROM lineitem GROUP BY 1""")
def union_chunks(spark, sf):
    a = load(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    return a.unionByName(load(spark, sf, "lineitem").groupBy(F.col("l_linestatus").alias("status")).agg(F.count("*").alias("n")))


@query("range_of_latest", f"WITH {NATION_YEAR} SELECT entity, orders, round(total, 2) AS total FROM nation_year WHERE year = (SELECT max(year) FROM nation_year)")
def range_of_latest(spark, sf):
    return rounded(filters.rows_at_max(nation_year(spark, sf, stored=True), "year").select("entity", "orders", "total"), 2, "total")
