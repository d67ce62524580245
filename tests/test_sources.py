import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablewright.functions.numbers import money
from tablewright.operators import schema
from tablewright.plans import economy
from tablewright.registry import ingest
from tablewright.sources import csv, html, json_pages, tables
from tablewright.streaming.landing import land_new_pages


def test_latin1_and_missing_source(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes("Entity,Year,Population (historical)\nCôte,1950,\"1,5\"\nX,bad,2\n".encode("latin1"))
    df = csv.read_csv(spark, str(tmp_path / "p.csv"), "Entity string, Year int, pop string", "ISO-8859-1", keep_bad_lines=True).cache()
    got = {r["Entity"]: r for r in df.collect()}
    assert got["Côte"]["Year"] == 1950 and money(F.lit("1,5")) is not None
    assert got["X"]["Year"] is None and got["X"][csv.BAD_LINE] == "X,bad,2"
    assert csv.try_read_csv(spark, str(tmp_path / "none.csv"), "a int") is None


def test_csv_sink_replaces_and_flattens(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "i int, lat double, lon double")
    for _ in range(2):
        csv.write_csv(schema.pack(df, "at", "lat", "lon"), str(tmp_path / "out"))
    assert rows(csv.read_csv(spark, str(tmp_path / "out"), "i int, at_lat double, at_lon double")) == [(1, 2.0, 3.0)]


def test_yearly_population_contract(spark, tmp_path):
    head = ",".join(economy.WORLD_POPULATION)
    (tmp_path / "w.csv").write_text(f'{head}\n7,"Land, North","1,234,567",-0.71%,-756,65,"652,860","-44,089",4.8,17,N.A.,0.52%\n')
    raw = csv.read_csv(spark, str(tmp_path / "w.csv"), economy.WORLD_POPULATION_DDL)
    r = economy.world_population(raw).first()
    assert (r["rank"], r["Country"], r["Population_2024"], r["Net_Change"], r["migrants"]) == (7, "Land, North", 1234567, -756, -44089)
    assert r["Yearly_Change"] == pytest.approx(-0.0071) and r["urban_share"] is None and r["land_area"] == 652860.0


def test_feature_pages(spark, tmp_path):
    pages = [{"features": [{"attributes": {"yr": 2010, "st": "TX", "extra": 1}}, {"attributes": {"yr": 2020, "st": "KS"}}]}, {"features": []}]
    for i, p in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(p, indent=1))
    got = json_pages.read_feature_pages(spark, str(tmp_path), "yr int, st string, mag int", F.col("yr") <= 2019)
    assert rows(got) == [(2010, "TX", None)]


def test_pages_are_numbered_in_their_tasks(spark):
    df = spark.range(0, 1000, numPartitions=7).where("id < 900 and id % 3 > 0").select(F.col("id").cast("string").alias("value"))
    pages, n = ingest._numbered(df)
    got = rows(pages, "nth")
    assert n == 600 and [r[1] for r in got] == list(range(600)) and len({r[0] for r in got}) == 600
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    none, n = ingest._numbered(df.limit(0))
    assert n == 0 and none.count() == 0


def test_landing_is_incremental(spark, tmp_path):
    pages, args = tmp_path / "pages", [str(tmp_path / d) for d in ("pages", "table", "progress")]
    pages.mkdir()
    for i in range(3):
        (pages / f"{i}.json").write_text(json.dumps({"features": [{"attributes": {"yr": i}}] if i else []}))
        land_new_pages(spark, *args, "yr int")
    assert rows(spark.read.parquet(args[1]), "yr") == [(1,), (2,)]


def test_envelopes_of_both_shapes(spark):
    data = {"Data": [{"Code": "A", "DataValue": "1,2"}]}
    bodies = [json.dumps({"BEAAPI": {"Results": r}}) for r in (data, [data])] + [json.dumps({"BEAAPI": {"Error": {"code": 3}}})]
    df = spark.createDataFrame([(b,) for b in bodies], "value string")
    assert rows(json_pages.envelope(df, "Code string, DataValue string")) == [("A", "1,2")] * 2
    assert rows(json_pages.response_error(df)) == [('{"code":3}',)]


def test_html_table(spark):
    page = ('<table id="x"><tr><td>0</td></tr></table><TABLE>no</TABLE><table border=1 id="t" class="c">\n<tr><th>h</th></tr>'
            '<tr><td> 1 </td><td></td></tr><tr class="q"><td><b>2</b></td><td>$3,0</td></tr><tr><td>only one</td></tr></table>')
    df = spark.createDataFrame([(5, page), (6, "<p>none</p>")], "id int, html string")
    assert rows(html.table_rows(df, "html", "t", ["a", "b"], ["id"]), "row") == [(5, 1, "1", None), (5, 2, "2", "$3,0")]


def test_catalog_table_is_replaced(spark, tmp_path):
    for n in (3, 2):
        tables.replace_table(spark.range(n), "replace_me", str(tmp_path / "t"))
    assert tables.run_sql(spark, "SELECT count(*) FROM replace_me WHERE id < :x", {"x": 9}).first()[0] == 2
    spark.sql("DROP TABLE replace_me")


def test_literals(spark):
    assert rows(tables.integers(spark, "y", 2018, 2020)) == [(2018,), (2019,), (2020,)]
    assert rows(tables.literal_table(spark, [("a", None), ("b", 2)], "k string, v int")) == [("a", None), ("b", 2)]


def test_rejected_casts(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    assert rows(schema.rejected_casts(df, {"a": F.col("a").try_cast("int")})) == [("a", 1)]
