"""Sources, headers, casts, dates and text."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import functions as F

from tablewright.functions import dates, numbers, text
from tablewright.operators import filters, profiling, schema
from tablewright.registry.common import query
from tablewright.session import cut_lineage, scratch_path
from tablewright.sources import csv, feature_pages, html, json_pages, tables
from tablewright.sources.tables import load
from tablewright.streaming.landing import land_new_pages


@query("header_normalise", """
SELECT c_custkey AS "Cust_Key", c_name AS "Name_full", c_acctbal AS balance, c_mktsegment AS "Segment" FROM customer""")
def header_normalise(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    raw = c.toDF(" Cust Key ", "Name (full)", "Nation", "Balance (USD)Â", "Segment")
    named = schema.rename(schema.normalise_headers(raw), {"Balance_USD": "balance"})
    return schema.keep(schema.drop_columns(named, ["Nation", "not_there"]), ["Cust_Key", "Name_full", "balance", "Segment"])


@query("header_lower", "SELECT s_suppkey AS suppkey, s_name AS name, s_acctbal AS acctbal FROM supplier")
def header_lower(spark, sf):
    s = load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal").toDF("SuppKey", " NAME ", "AcctBal")
    return schema.lower_headers(schema.trim_headers(s))


@query("coerce_numeric", """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice) AS BIGINT) END AS whole FROM orders""")
def coerce_numeric(spark, sf):
    o = load(spark, sf, "orders")
    low = F.col("o_orderpriority") == "5-LOW"
    raw = o.select("o_orderkey", F.when(low, "N.A.").otherwise(
        F.concat(F.lit("$"), F.format_number("o_totalprice", 2))).alias("price"),
        F.when(low, "").otherwise(F.format_number(F.floor("o_totalprice"), 0)).alias("whole"))
    return schema.apply_contract(raw, {"price": numbers.money(F.col("price")), "whole": numbers.to_long(F.col("whole"))})


@query("rejected_casts", """
SELECT 'o_orderpriority' AS "column", COUNT(*) - COUNT(TRY_CAST(o_orderpriority AS DOUBLE)) AS rejected FROM orders
UNION ALL SELECT 'o_totalprice', 0 FROM region WHERE r_regionkey = 0""")
def rejected_casts(spark, sf):
    o = load(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("string"))
    return schema.rejected_casts(o, {c: numbers.to_double(F.col(c)) for c in ("o_orderpriority", "o_totalprice")})


@query("percent_text", """
SELECT round(l_discount, 4) AS fraction, COUNT(*) AS "rows" FROM lineitem GROUP BY 1""")
def percent_text(spark, sf):
    p = load(spark, sf, "lineitem").select(F.concat(F.format_number(F.col("l_discount") * 100, 2), F.lit("%")).alias("t"))
    return p.groupBy(F.round(numbers.percent_fraction(F.col("t")), 4).alias("fraction")).agg(F.count("*").alias("rows"))


@query("infinite_to_null", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 THEN round(l_tax / l_discount, 6) END AS ratio,
       CASE WHEN l_tax > 0 THEN round(sqrt(l_tax), 6) END AS root FROM lineitem""")
def infinite_to_null(spark, sf):
    x = load(spark, sf, "lineitem")
    inf = F.when(F.col("l_discount") > 0, F.col("l_tax") / F.when(F.col("l_discount") > 0, F.col("l_discount"))).otherwise(F.lit(float("inf")))
    nan = F.when(F.col("l_tax") > 0, F.sqrt("l_tax")).otherwise(F.lit(float("nan")))
    return x.select("l_orderkey", "l_linenumber", F.round(numbers.finite(inf), 6).alias("ratio"),
                    F.round(numbers.finite(nan), 6).alias("root"))


@query("date_parts", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, dayname(ts) AS day_name, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
       COUNT(*) AS "rows" FROM events GROUP BY ALL""")
def date_parts(spark, sf):
    e = load(spark, sf, "events")
    return e.groupBy(F.hour("ts").alias("hour"), dates.day_name(F.col("ts")).alias("day_name"),
                     dates.weekday_monday0(F.col("ts")).alias("weekday")).agg(F.count("*").alias("rows"))


@query("calendar_parts", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
       CAST(month(o_orderdate) AS INTEGER) AS month, CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS DATE) AS quarter_end,
       CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH AS DATE) AS next_quarter, COUNT(*) AS "rows"
FROM orders GROUP BY ALL""")
def calendar_parts(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return load(spark, sf, "orders").groupBy(
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        dates.quarter_end(d).alias("quarter_end"), dates.next_quarter(d).alias("next_quarter")).agg(F.count("*").alias("rows"))


@query("date_bounds", """
SELECT strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day FROM events""")
def date_bounds(spark, sf):
    return load(spark, sf, "events").agg(dates.iso_date_text(F.min("ts")).alias("first_day"),
                                         dates.iso_date_text(F.max("ts")).alias("last_day"))


@query("parse_dates", """
SELECT o_orderkey, strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS stamp,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS month_start,
       CAST(o_orderdate AS DATE) AS day FROM orders""")
def parse_dates(spark, sf):
    o = load(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit("01:00:00").alias("time"),
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.date_format("o_orderdate", "MMM yyyy")).alias("month"))
    return o.select(
        "o_orderkey", F.date_format(dates.date_and_time(F.col("date"), F.col("time")), "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        dates.month_text(F.col("month")).alias("month_start"), dates.iso(F.col("date")).cast("date").alias("day"))


@query("decade_floor", """
SELECT CAST(floor(year(o_orderdate) / 10.0) * 10 AS INTEGER) AS decade, COUNT(*) AS "rows" FROM orders GROUP BY 1""")
def decade_floor(spark, sf):
    return load(spark, sf, "orders").groupBy(numbers.decade(F.year("o_orderdate")).alias("decade")).agg(F.count("*").alias("rows"))


@query("quarter_parse", """
SELECT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS quarter_start, CAST(quarter(l_shipdate) AS INTEGER) AS quarter,
       CAST(year(l_shipdate) * 4 + quarter(l_shipdate) - 1 AS INTEGER) AS quarter_index, COUNT(*) AS "rows"
FROM lineitem GROUP BY ALL""")
def quarter_parse(spark, sf):
    d = F.col("l_shipdate")
    raw = load(spark, sf, "lineitem").select(
        F.concat(F.year(d), F.lit("Q"), F.quarter(d)).alias("label"),
        F.element_at(F.array(*map(F.lit, dates.ROMAN)), F.quarter(d)).alias("roman"))
    start = dates.quarter_text_start(F.col("label"))
    return raw.groupBy(start.alias("quarter_start"), dates.roman_quarter(F.col("roman")).alias("quarter"),
                       dates.quarter_index(start).alias("quarter_index")).agg(F.count("*").alias("rows"))


@query("text_labels", """
SELECT p_partkey, CASE WHEN length(t) > 20 THEN substr(t, 1, 20) || '...' ELSE t END AS label,
       '$' || format('{:,.2f}', p_retailprice) AS price, 'Brand' AS prefix, regexp_replace(p_brand, '^[^#]*#', '') AS code
FROM (SELECT *, p_name || ' ' || p_type || ' ' || p_brand AS t FROM part)""")
def text_labels(spark, sf):
    t = text.spaced(F.col("p_name"), F.col("p_type"), F.col("p_brand"))
    return load(spark, sf, "part").select(
        "p_partkey", text.shortened(t).alias("label"), text.number_text(F.col("p_retailprice"), 2, "$").alias("price"),
        F.split("p_brand", "#")[0].alias("prefix"), text.after_prefix(F.col("p_brand"), "#").alias("code"))


@query("pack_coordinates", """
SELECT s_suppkey, s_nationkey AS at_s_nationkey, s_acctbal AS at_s_acctbal FROM supplier""")
def pack_coordinates(spark, sf):
    s = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return schema.flatten_structs(schema.pack(s, "at", "s_nationkey", "s_acctbal"))


@query("code_names", "SELECT p_brand AS code, max(p_type) AS name FROM part GROUP BY 1")
def code_names(spark, sf):
    return schema.code_names(load(spark, sf, "part").select(F.col("p_brand").alias("code"), F.col("p_type").alias("name")),
                             "code", "name")


@query("year_selection", """
SELECT o_orderstatus, COUNT(*) AS "rows" FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
GROUP BY 1""")
def year_selection(spark, sf):
    o = load(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return filters.rows_at_max(o, "year").groupBy("o_orderstatus").agg(F.count("*").alias("rows"))


@query("filter_mix", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_linenumber <> 1 AND l_returnflag IN ('A', 'R') AND (l_linestatus = 'F' OR l_quantity >= 45)
  AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'""")
def filter_mix(spark, sf):
    x = filters.drop_ordinals(load(spark, sf, "lineitem"), "l_linenumber", 1)
    x = filters.in_list(x, "l_returnflag", ["A", "R"])
    x = x.where(filters.any_of(F.col("l_linestatus") == "F", F.col("l_quantity") >= 45))
    bounds = [F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1998-12-31")]
    return filters.between_closed(x, "l_shipdate", *bounds).select("l_orderkey", "l_linenumber", "l_quantity")


@query("json_field", """
SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, COUNT(*) AS "rows",
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1""")
def json_field(spark, sf):
    e = load(spark, sf, "events").select(F.from_json("props", "k int")["k"].alias("k"), "value")
    return e.groupBy("k").agg(F.count("*").alias("rows"), F.sum(numbers.cents(F.col("value"))).cast("double").alias("total"))


def _pages(spark, sf, per_page: int = 500):
    """Response pages of at most ``per_page`` features each, and one empty page at the end."""
    o = load(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / per_page).alias("page"),
        F.struct(F.struct(F.col("o_orderkey").alias("objectid"), F.year("o_orderdate").alias("yr"),
                          F.col("o_orderstatus").alias("st"), F.col("o_totalprice").alias("loss")).alias("attributes")).alias("f"))
    pages = o.groupBy("page").agg(F.to_json(F.struct(F.collect_list("f").alias("features"))).alias("value"))
    return pages.select("value").unionByName(spark.createDataFrame([('{"features": []}',)], "value string"))


ATTRIBUTES = "objectid bigint, yr int, st string, loss double"
PAGED_SQL = """
SELECT o_orderkey AS objectid, CAST(year(o_orderdate) AS INTEGER) AS "Year", o_orderstatus AS state, o_totalprice AS "Property Damage"
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999"""
PAGE_NAMES = {"yr": "Year", "st": "state", "loss": "Property Damage"}


@query("paged_json", PAGED_SQL)
def paged_json(spark, sf):
    path = scratch_path(spark, "pages")
    _pages(spark, sf).write.text(path)
    rows = json_pages.features(spark.read.text(path), ATTRIBUTES).where(F.col("yr").between(1996, 1999))
    return schema.rename(rows, PAGE_NAMES)


def _numbered(pages):
    """(value, nth) with the numbers 0, 1, 2, ... in any order, and how many there are: rows keep their place in their task, only
    the tasks' counts meet."""
    stored = cut_lineage(pages.select("value", F.monotonically_increasing_id().alias("uid")), "pages")
    task, place = F.shiftright("uid", 33), F.col("uid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = stored.groupBy(task.alias("task")).agg(F.count("*").alias("c")).orderBy("task").collect()  # one row a task
    starts = list(itertools.accumulate((r.c for r in counts), initial=0))
    first = tables.literal_table(stored.sparkSession, [(r.task, at) for r, at in zip(counts, starts)], "task long, first long")
    return stored.withColumn("task", task).join(first, "task").select("value", (F.col("first") + place).alias("nth")), starts[-1]


@query("paged_json_source", PAGED_SQL)
def paged_json_source(spark, sf):
    """Pages planned by offset, the years compared by the reader; an empty page ends the query."""
    path, limit = scratch_path(spark, "offsets"), 1000
    pages, n = _numbered(_pages(spark, sf).where(F.contains("value", F.lit("attributes"))))
    empty = tables.literal_table(spark, [('{"features": []}', n)], "value string, nth long")
    pages.unionByName(empty).select("value", (F.col("nth") * limit).alias("offset")).write.partitionBy("offset").text(path)
    feature_pages.register(spark)
    rows = spark.read.format("feature_pages").schema(ATTRIBUTES).option("path", path).option("limit", limit).load()
    return schema.rename(rows.where(F.col("yr").between(1996, 1999)), PAGE_NAMES)


@query("paged_json_landing", PAGED_SQL)
def paged_json_landing(spark, sf):
    base = scratch_path(spark, "landing")
    _pages(spark, sf).repartition(4).write.text(f"{base}/pages")
    for _ in range(2):  # the second run finds nothing new
        land_new_pages(spark, f"{base}/pages", f"{base}/table", f"{base}/progress", ATTRIBUTES, whole=False)
    rows = spark.read.parquet(f"{base}/table").where(F.col("yr").between(1996, 1999))
    return schema.rename(rows, PAGE_NAMES)


@query("envelope_json", """
SELECT CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS "TimePeriod",
       CASE WHEN o_orderpriority <> '5-LOW' THEN round(o_totalprice, 2) END AS "DataValue", o_orderkey AS "Code" FROM orders""")
def envelope_json(spark, sf):
    d = F.col("o_orderdate")
    row = F.struct(
        F.concat(F.year(d), F.lit("Q"), F.quarter(d)).alias("TimePeriod"), F.col("o_orderkey").cast("string").alias("Code"),
        F.when(F.col("o_orderpriority") == "5-LOW", "(NA)").otherwise(F.format_number("o_totalprice", 2)).alias("DataValue"),
        F.lit("x").alias("NoteRef"))
    page = F.floor(F.col("o_orderkey") / 500)
    body = load(spark, sf, "orders").groupBy(page.alias("page")).agg(F.collect_list(row).alias("Data"))
    results = F.struct(F.struct(F.struct("Data").alias("Results")).alias("BEAAPI"))["BEAAPI"]
    as_object = F.to_json(F.struct(results.alias("BEAAPI")))
    as_list = F.to_json(F.struct(F.struct(F.array(F.struct("Data")).alias("Results")).alias("BEAAPI")))
    responses = body.select(F.when(F.col("page") < 10, as_object).otherwise(as_list).alias("value"))
    data = json_pages.envelope(responses, "TimePeriod string, Code string, DataValue string")
    return data.select("TimePeriod", numbers.money(F.col("DataValue")).alias("DataValue"),
                       numbers.strict_long(F.col("Code")).alias("Code"))


@query("html_cells", """
SELECT page_id, position, cell FROM (
  SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS position,
         trim(regexp_replace(unnest(l), '<[^>]*>', '', 'g')) AS cell
  FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1) AS l FROM pages)) WHERE cell <> ''""")
def html_cells(spark, sf):
    return html.elements(load(spark, sf, "pages"), "html", "li", ["page_id"])


@query("html_table_rows", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS orders,
       CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18,2)))) AS BIGINT) AS damage FROM orders GROUP BY 1""")
def html_table_rows(spark, sf):
    o = load(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(
        F.count("*").alias("n"), F.floor(F.sum(numbers.cents(F.col("o_totalprice")))).alias("d"))
    def td(c):
        return F.concat(F.lit("<td> "), c, F.lit(" </td>"))
    tr = F.concat(F.lit("<tr>"), td(F.col("y").cast("string")), td(F.format_number("n", 0)),
                  td(F.concat(F.lit("$"), F.format_number(F.col("d").cast("decimal(38,0)"), 0))), F.lit("</tr>\n"))
    # one table row per year
    page = o.agg(F.concat(F.lit('<html><table id="other"><tr><td>9</td></tr></table><table class="x" id="summary">'
                                '<tr><th>Year</th><th>Orders</th><th>Damage</th></tr>'),
                          F.array_join(F.sort_array(F.collect_list(tr)), ""), F.lit("</table></html>")).alias("html"))
    rows = html.table_rows(page, "html", "summary", ["year", "orders", "damage"])
    return rows.select(F.col("year").cast("int").alias("year"), numbers.to_long(F.col("orders")).alias("orders"),
                       numbers.to_long(F.col("damage")).alias("damage"))


@query("csv_roundtrip", """
SELECT c_custkey, c_name, c_nationkey AS home_c_nationkey, c_acctbal AS home_c_acctbal, 'é, "quoted"' AS note FROM customer""")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "customers")
    c = schema.pack(load(spark, sf, "customer").drop("c_mktsegment"), "home", "c_nationkey", "c_acctbal")
    csv.write_csv(c.withColumn("note", F.lit('é, "quoted"')), path)
    ddl = "c_custkey bigint, c_name string, home_c_nationkey int, home_c_acctbal double, note string"
    return csv.read_csv(spark, path, ddl)


@query("table_replace", """
SELECT n_name AS name, COUNT(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def table_replace(spark, sf):
    names = {t: f"{t}_{uuid.uuid4().hex[:8]}" for t in ("customer", "nation")}
    for table, name in names.items():
        tables.replace_table(load(spark, sf, table), name, scratch_path(spark, name))
    return tables.run_sql(spark, f"SELECT n_name AS name, COUNT(*) AS customers FROM {names['customer']} "
                                 f"JOIN {names['nation']} ON c_nationkey = n_nationkey GROUP BY n_name")


@query("schema_report", """
SELECT 's_suppkey' AS "column", 'bigint' AS type, COUNT(s_suppkey) AS present FROM supplier
UNION ALL SELECT 's_name', 'string', COUNT(s_name) FROM supplier
UNION ALL SELECT 's_nationkey', 'int', COUNT(s_nationkey) FROM supplier
UNION ALL SELECT 's_acctbal', 'double', COUNT(s_acctbal) FROM supplier""")
def schema_report(spark, sf):
    return profiling.schema_report(load(spark, sf, "supplier"))


@query("type_counts", """
SELECT CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS type,
  COUNT(*) AS columns FROM (DESCRIBE lineitem) GROUP BY 1""")
def type_counts(spark, sf):
    return profiling.type_counts(load(spark, sf, "lineitem"))
