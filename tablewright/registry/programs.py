"""The remaining composed programs and small sources, on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions.numbers import decade
from tablewright.operators import schema
from tablewright.plans import catalogue, economy, life, storms
from tablewright.registry.analyses import _catalogue, _economy
from tablewright.registry.common import CELLS, GAPS, cells, query
from tablewright.session import scratch_path
from tablewright.sources import csv
from tablewright.sources.tables import load, preview


def _record(spark, sf):
    """Orders in the shape of storm records."""
    o = load(spark, sf, "orders")
    text = {"date": F.date_format("o_orderdate", "yyyy-MM-dd"), "time": F.lit("16:30:00"), "st": F.col("o_orderstatus")}
    numbers = {"yr": F.year("o_orderdate"), "mag": F.col("o_orderkey") % 6, "inj": F.col("o_custkey") % 5, "fat": F.col("o_custkey") % 2,
               "loss": F.lit(2.0), "closs": F.lit(0.5), "slat": F.lit(33.1), "slon": F.lit(-87.0), "elat": F.lit(33.4), "elon": F.lit(-86.5),
               "len": F.lit(80.0), "wid": F.lit(2600.0)}
    return o.select(F.col("o_orderkey").cast("string").alias("om"), *[c.alias(n) for n, c in {**text, **numbers}.items()])


@query("storm_merge", """WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, COUNT(*) AS n, CAST(SUM(o_custkey % 5) AS BIGINT) AS inj, CAST(SUM(o_custkey % 2) AS BIGINT) AS fat FROM orders GROUP BY 1)
SELECT CAST(o.o_orderkey % 6 AS BIGINT) AS scale, y.y AS "Year", COUNT(*) AS records, any_value(y.n) AS api_records, any_value(y.inj) AS api_injuries,
  CAST(any_value(y.fat) % 1000 + 1 AS DOUBLE) AS html_fatalities, CAST(1234.5 AS DOUBLE) AS html_damage
FROM orders o JOIN y ON year(o.o_orderdate) = y.y WHERE y.y BETWEEN 1993 AND 1996 GROUP BY 1, 2""")
def storm_merge(spark, sf):
    """Flat records meet the yearly totals of feature pages and of a summary page."""
    rec = _record(spark, sf)
    flat = storms.from_flat_file(rec.withColumns({c: F.lit("0") for c in storms.FLAT_UNUSED}))
    api = storms.from_features(rec.withColumn("objectid", F.lit(7)).toDF(*[c.upper() for c in rec.columns], "OBJECTID"), 1993, 1996)
    per_year = rec.groupBy("yr").agg(F.sum("fat").alias("fat"))
    def td(*parts):
        return F.concat(F.lit("<td>"), *parts, F.lit("</td>"))
    tr = F.concat(F.lit("<tr>"), td(F.col("yr").cast("string")), td(F.lit("1,691")), td(F.lit("5")), td(F.lit("6")),
                  td((F.col("fat") % 1000).cast("string")), td(F.lit("1")), td(F.lit("$1,234.5")), td(F.lit("$10")), F.lit("</tr>"))
    page = per_year.agg(F.concat(F.lit(f'<table id="{storms.SUMMARY_TABLE}"><tr><th>Year</th></tr>'), F.array_join(F.collect_list(tr), ""), F.lit("</table>")).alias("html"))
    merged = storms.merge(flat, api, storms.from_summary_page(page))
    return merged.groupBy(F.col("F-Scale").alias("scale"), "Year").agg(
        F.count("*").alias("records"), F.max("api_records").alias("api_records"), F.max("api_injuries").alias("api_injuries"),
        F.max("html_fatalities").alias("html_fatalities"), F.max("`html_Property Damage`").alias("html_damage"))


def _life_tables(spark, sf):
    c = cells(spark, sf)
    table = c.select(F.col("year").alias("Year"), F.col("region").alias("Race"), F.col("segment").alias("Sex"),
                     F.when(F.col("year") % 3 != 0, F.col("price")).alias(life.LIFE), F.concat(F.lit("1,"), F.format_string("%03d.5", F.col("orders") % 1000)).alias(life.DEATHS))
    people = load(spark, sf, "orders").groupBy(decade(F.year("o_orderdate")).alias("Year")).agg(F.format_number(F.count("*"), 0).alias(life.POPULATION))
    return table, people.withColumn("Geography Type", F.lit("Nation"))


@query("life_combined", f"""WITH {CELLS}, x AS (SELECT *, CASE WHEN year % 3 <> 0 THEN price END AS v FROM cells),
m AS (SELECT region, segment, median(v) AS gm FROM x GROUP BY 1, 2), d AS (SELECT CAST(floor(year(o_orderdate) / 10.0) * 10 AS INTEGER) AS decade, COUNT(*) AS people FROM orders GROUP BY 1)
SELECT year AS "Year", region AS "Race", segment AS "Sex", round(coalesce(v, gm), 6) AS life, CAST(1000.5 + orders % 1000 AS DOUBLE) AS deaths, decade AS "Decade", people
FROM x JOIN m USING (region, segment) LEFT JOIN d ON decade = CAST(floor(year / 10.0) * 10 AS INTEGER)""")
def life_combined(spark, sf):
    c = life.combine(*_life_tables(spark, sf))
    return c.select("Year", "Race", "Sex", F.round(f"`{life.LIFE}`", 6).alias("life"), F.col(f"`{life.DEATHS}`").alias("deaths"), "Decade",
                    F.col(f"`{life.POPULATION}`").alias("people"))


@query("life_projection", f"""WITH {CELLS} SELECT r.region AS "Race", s.segment AS "Sex", CAST(y AS INTEGER) AS "Year", true AS predicted
FROM (SELECT DISTINCT region FROM cells) r, (SELECT DISTINCT segment FROM cells) s, range(2018, 2038) t(y)""")
def life_projection(spark, sf):
    c = life.combine(*_life_tables(spark, sf))
    wide, features, levels = life.model_table(c)
    _, linear, models, safe = life.fit(wide, features)
    done = life.predict_all(life.future_table(c, levels), linear, models, safe)
    fine = [F.col(m).isNotNull() & (F.abs(m) < float("inf")) for m in ("linear", "tree", "forest")]
    return done.select("Race", "Sex", "Year", (fine[0] & fine[1] & fine[2]).alias("predicted"))


@query("world_population", """SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS rank, n_name AS "Country", n * 1234567 AS "Population_2024", CAST(n % 50 - 25 AS DOUBLE) / 100 AS "Yearly_Change",
  -n AS "Net_Change", CAST(n * 10 AS DOUBLE) AS density, CASE WHEN n % 2 = 0 THEN CAST(0.5 AS DOUBLE) END AS urban_share
FROM (SELECT n_nationkey, n_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)""")
def world_population(spark, sf):
    names = load(spark, sf, "nation")
    n = load(spark, sf, "customer").join(names, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_nationkey", "n_name").agg(F.count("*").alias("n"))
    order = F.array_position(n.agg(F.sort_array(F.collect_list("n_nationkey"))).scalar(), F.col("n_nationkey"))
    cell = {"Rank": order.cast("string"), "Country": F.col("n_name"), "Population (2024)": F.format_number(F.col("n") * 1234567, 0),
            "Yearly Change": F.concat((F.col("n") % 50 - 25).cast("string"), F.lit("%")), "Net Change": F.format_number(-F.col("n"), 0),
            "Density (P/Km²)": F.format_number(F.col("n") * 10, 0), "Urban Pop %": F.when(F.col("n") % 2 == 0, "50%").otherwise("N.A.")}
    raw = n.select(*[cell.get(c, F.lit("1")).alias(c) for c in economy.WORLD_POPULATION])
    return economy.world_population(raw).select("rank", "Country", "Population_2024", "Yearly_Change", "Net_Change", "density", "urban_share")


_LISTED = ", ".join("('" + c.replace("'", "''") + "')" for c in economy.LISTED_COUNTRIES)
_NAMED = "CASE country " + " ".join("WHEN '{}' THEN '{}'".format(a.replace("'", "''"), b.replace("'", "''")) for a, b in economy.COUNTRY_NAMES.items()) + " ELSE country END"


@query("country_backfill", f"""WITH n AS (SELECT n_name, n_nationkey, COUNT(*) AS c FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
listed AS (SELECT country, {_NAMED} AS entity FROM (VALUES {_LISTED}) v(country))
SELECT n_name AS country, c AS people, n_name AS entity, 2020 AS year, CAST(c AS DOUBLE) AS output FROM n
UNION ALL SELECT country, (SELECT c FROM n WHERE n_nationkey = 3 AND country = 'Guam'), entity, {economy.BACKFILL_YEAR}, (SELECT CAST(c AS DOUBLE) FROM n WHERE n_nationkey = 4 AND entity = 'Greenland*') FROM listed""")
def country_backfill(spark, sf):
    n = load(spark, sf, "customer").join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "n_nationkey").agg(F.count("*").alias("c"))
    have = n.select(F.col("n_name").alias("Country"), F.col("c").alias("Population_2024"), F.col("n_name").alias("Entity"), F.lit(2020).alias("Year"),
                    F.col("c").cast("double").alias(economy.OUTPUT))
    people = n.select(F.when(F.col("n_nationkey") == 3, "Guam").otherwise(F.col("n_name")).alias("Country"), F.col("c").alias("Population_2024"))
    output = n.select(F.when(F.col("n_nationkey") == 4, "Greenland*").otherwise(F.col("n_name")).alias("Entity"), F.col("c").cast("double").alias(economy.OUTPUT))
    return economy.backfill_countries(have, people, output).toDF("country", "people", "entity", "year", "output")


@query("negative_depths", f"WITH {GAPS} SELECT COUNT(*) FILTER (value - 5 < 0) AS floored FROM gaps")
def negative_depths(spark, sf):
    return catalogue.negative_depths(_catalogue(spark, sf))


@query("predict_output")
def predict_output(spark, sf):
    return economy.predict_output(economy.prepare(*_economy(spark, sf), since=1996)).select("Entity", "Year", "prediction")


@query("latin1_csv", """SELECT s_suppkey AS key, 'Côte ' || s_name AS label, false AS missing_read FROM supplier""")
def latin1_csv(spark, sf):
    """A Latin-1 file read with its encoding; a source that is not there gives no table."""
    path = scratch_path(spark, "latin")
    rows = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.concat(F.lit("Côte "), F.col("s_name")).alias("label"))
    rows.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    none = csv.try_read_csv(spark, scratch_path(spark, "nothing"), "key bigint")
    return csv.try_read_csv(spark, path, "key bigint, label string").withColumn("missing_read", F.lit(none is not None))


@query("columns_like", "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem")
def columns_like(spark, sf):
    x = load(spark, sf, "lineitem")
    return x.select("l_orderkey", "l_linenumber", *schema.columns_like(x, "shipd"))


@query("preview_rows", "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5")
def preview_rows(spark, sf):
    return preview(load(spark, sf, "orders").select("o_orderkey", "o_orderstatus").orderBy("o_orderkey"))
