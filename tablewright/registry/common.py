"""Registration and the table views several queries share (one Spark and one SQL form each)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.functions.numbers import cents
from tablewright.operators.panel import to_panel
from tablewright.session import cut_lineage
from tablewright.sources.tables import load

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in REGISTRY:
            raise KeyError(f"query {name} is registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return add


def r(c: Column | str, digits: int = 4) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def rounded(df: DataFrame, digits: int = 4, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# events with a JSON field as a number and values missing for part of its range
GAPS = """
gaps AS (
  SELECT event_id, ts, user_id, k, CASE WHEN k NOT BETWEEN 50 AND 54 THEN event_type END AS kind,
         CASE WHEN k >= 15 THEN value END AS v, CASE WHEN k BETWEEN 5 AND 80 THEN value * 2 END AS w,
         CAST(hour(ts) AS INTEGER) AS h, value
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""


def gaps(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return e.select(
        "event_id", "ts", "user_id", "k", F.when(~F.col("k").between(50, 54), F.col("event_type")).alias("kind"),
        F.when(F.col("k") >= 15, F.col("value")).alias("v"),
        F.when(F.col("k").between(5, 80), F.col("value") * 2).alias("w"), F.hour("ts").alias("h"), "value")


# revenue per brand and quarter
PANEL = """
panel AS (
  SELECT p_brand AS series, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""


def revenue() -> Column:
    return cents(F.col("l_extendedprice")) * (1 - F.col("l_discount").cast("decimal(4,2)"))


def panel(spark: SparkSession, sf: str, by: str = "p_brand", stored: bool = False) -> DataFrame:
    """``stored`` for queries that read the panel more than once: the lines are then scanned once."""
    lines = load(spark, sf, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice", "l_discount")
    part = load(spark, sf, "part").select("p_partkey", F.col(by).alias("series"))
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    out = to_panel(joined, ["series"], F.trunc("l_shipdate", "quarter"), F.sum(revenue()).cast("double"))
    return cut_lineage(out, "panel") if stored else out


# mean order price per region, segment and year
CELLS = """
cells AS (
  SELECT r_name AS region, c_mktsegment AS segment, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS price, COUNT(*) AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2, 3)"""


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    nations = load(spark, sf, "nation").join(load(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return load(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))


def cells(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    joined = orders.join(_customers(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment"),
                          F.year("o_orderdate").alias("year")).agg(
        (F.sum(cents(F.col("o_totalprice"))).cast("double") / F.count("*")).alias("price"), F.count("*").alias("orders"))


# order value and count per nation and year
NATION_YEAR = """
nation_year AS (
  SELECT n_name AS entity, CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS orders,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""


def nation_year(spark: SparkSession, sf: str, stored: bool = False) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    joined = orders.join(_customers(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    out = joined.groupBy(F.col("n_name").alias("entity"), F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("orders"), F.sum(cents(F.col("o_totalprice"))).cast("double").alias("total"))
    return cut_lineage(out, "nation_year") if stored else out
