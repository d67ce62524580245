import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablewright.plans import catalogue, economy, energy, life, outlook, storms
from tablewright.sources.json_pages import envelope
from tablewright.sources.tables import literal_table


def test_storm_sources(spark):
    unused = {c: "0" for c in storms.FLAT_UNUSED}
    rec = {"yr": 2011, "date": "2011-04-27", "time": "16:30:00", "st": "AL", "mag": 4, "inj": 3, "fat": 1, "loss": 2.0,
           "closs": 0.5, "slat": 33.1, "slon": -87.0, "elat": 33.4, "elon": -86.5, "len": 80.0, "wid": 2600.0}
    flat = storms.from_flat_file(spark.createDataFrame([{**rec, **unused}, {**rec, **unused, "yr": 2012}]))
    assert flat.columns == list(storms.ORDER)
    r = flat.where("Year = 2011").first()
    assert r["datetime"] == dt.datetime(2011, 4, 27, 16, 30) and r["start_coords"]["slat"] == 33.1
    api = storms.from_features(spark.createDataFrame([{k.upper(): v for k, v in {**rec, "objectid": 7}.items()},
                                                      {k.upper(): v for k, v in {**rec, "objectid": 8, "yr": 1999}.items()}]))
    assert api.count() == 1
    page = ('<table id="tornadoSummary"><tr><th>Year</th></tr><tr><td>2011</td><td>1,691</td><td>5,000</td><td>483</td><td>550</td><td>3</td>'
            '<td>$9,493,250.5</td><td>$10</td></tr></table>')
    # counts with separators are not numbers until stripped: the losses are coerced as they stand
    summary = storms.from_summary_page(spark.createDataFrame([(page,)], "html string"))
    s = summary.first()
    assert s["Property Damage"] == 9493250.5 and s["injuries"] is None and s["fatalities"] == 553.0
    merged = storms.merge(flat, api, summary).collect()
    assert len(merged) == 1 and merged[0]["api_records"] == 1 and merged[0]["html_fatalities"] == 553.0


def test_catalogue(spark):
    rng = np.random.default_rng(6)
    def some(v, p=0.2):
        return None if rng.random() < p else float(v)
    data = []
    for i in range(300):
        la, lo, d = rng.uniform(-60, 60), rng.uniform(-180, 180), rng.exponential(20) - 1
        data.append((f"e{i:03d}", dt.datetime(2024, 1, 1 + i % 28, i % 24), [None, "ml", "mb"][i % 3], float(la), float(lo), float(d),
                     None if i == 7 else float(rng.normal(2, 1)), *(some(rng.gamma(2)) for _ in range(8))))
    ddl = ("id string, time timestamp, magType string, latitude double, longitude double, depth double, mag double, nst double, gap double, "
           "dmin double, rms double, horizontalError double, depthError double, magError double, magNst double")
    df = spark.createDataFrame(data, ddl)
    clean = catalogue.impute_catalogue(df, trees=5)
    out = catalogue.cap_catalogue(clean).collect()
    assert len(out) == 299 and all(v is not None for r in out for k, v in r.asDict().items() if k != "magType")
    assert min(r["depth"] for r in out) == 0.0 and {r["day_of_week"] for r in out} <= {
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"}
    known = {d[0]: d[8] for d in data if d[8] is not None}
    got = {r["id"]: r["gap"] for r in clean.collect()}
    assert all(got[k] == v for k, v in known.items() if k in got)
    assert catalogue.negative_depths(df).first()[0] == sum(d[5] < 0 for d in data)


def test_life(spark):
    races, sexes = ["All Races", "Black", "White"], ["Both Sexes", "Female", "Male"]
    data = [(y, r, s, None if y % 17 == 0 else 50 + (y - 1900) * 0.2 + 3 * races.index(r) + sexes.index(s), f"{2500 - y:,}.5")
            for y in range(1900, 2018) for r in races for s in sexes]
    table = spark.createDataFrame(data, f"Year int, Race string, Sex string, ` {life.LIFE} ` double, `{life.DEATHS}` string")
    pop = spark.createDataFrame([("Nation", y, f"{y * 1000:,}") for y in range(1910, 2020, 10)] + [("State", 1900, "1")],
                                f"`Geography Type` string, Year int, `{life.POPULATION}` string")
    raw = table.toDF("Year", "Race", "Sex", life.LIFE, life.DEATHS)
    c = life.combine(raw, pop).cache()
    assert c.where(F.col(life.LIFE).isNull()).count() == 0
    assert {r[0] for r in c.where("Decade = 1900").select(life.POPULATION).distinct().collect()} == {life.CENSUS_1900}
    assert c.where("Year = 1955").first()[life.POPULATION] == 1950000 and c.where("Year = 1955").first()[life.DEATHS] == 545.5
    wide, features, levels = life.model_table(c)
    marked, linear, models, safe = life.fit(wide, features, trees=5)
    future = life.predict_all(life.future_table(c, levels), linear, models, safe)
    assert future.count() == 20 * 9
    r = future.where("Year = 2030 and Race = 'White' and Sex = 'Male'").first()
    assert r["linear"] == pytest.approx(50 + 26 + 6 + 2, abs=1.5) and r["tree"] > 60 and r["forest"] > 60


def test_energy(spark):
    months = [dt.date(2001 + i // 12, 1 + i % 12, 1) for i in range(96)]
    rng = np.random.default_rng(0)
    data = [(m.strftime("%b %Y"), *map(float, v), float(v.sum())) for m, v in zip(months, rng.uniform(10, 90, (96, 6)))] + [("bad", *[1.0] * 7)]
    ready = energy.prepare(spark.createDataFrame(data, "Month string, " + ", ".join(f"{s} double" for s in [*energy.SOURCES, energy.TOTAL])))
    assert ready.count() == 96
    cls = energy.classes(ready)["natural"]
    assert {r["coal_category"] for r in cls.collect()} == {"Low", "Medium", "High", "Very High"}
    coefs, cv, scores = energy.regression(ready)
    assert scores.first()["r2"] == pytest.approx(1.0, abs=1e-6) and cv.orderBy("place").first()["mean_r2"] == pytest.approx(1.0, abs=1e-6)
    assert energy.correlations(ready).where("a = b and r = 1.0").count() == 7


def test_economy(spark):
    pop = spark.createDataFrame([(e, y, float(100 * (i + 1) + y - 1950 + (y - 1950) * i)) for i, e in enumerate("ABCDEFGH") for y in range(1940, 1961)],
                                "Entity string, Year int, `Population (historical)` double")
    gdp = spark.createDataFrame([(e, y, "oops" if (e, y) == ("H", 1960) else str(10.0 * i + y), e) for i, e in enumerate("ABCDEFGH") for y in (1959, 1960)],
                                f"Entity string, Year int, `{economy.OUTPUT}` string, Code string")
    ready = economy.prepare(pop, gdp)
    out = {r["Entity"]: r for r in ready.collect()}
    assert set(out) == set("ABCDEFG") and {r["Year"] for r in out.values()} == {1960}
    assert out["A"][economy.OUTPUT] == 0.0 and out["G"][economy.OUTPUT] == 1.0 and out["G"]["Population_historical"] == 1.0
    coefs, summary = economy.regression_report(ready)
    assert summary.first()["n"] == 7 and coefs.count() == 3
    full = economy.prepare(pop, gdp.withColumn("Year", F.col("Year")), scaled=False)
    assert full.count() == 7


def test_country_backfill(spark):
    assert len(economy.LISTED_COUNTRIES) == len(set(economy.LISTED_COUNTRIES)) == 46
    have = spark.createDataFrame([("Guam", 1, "Guam", 2020, 5.0)], f"Country string, Population_2024 bigint, Entity string, Year int, `{economy.OUTPUT}` double")
    pop = spark.createDataFrame([("Greenland", 56)], "Country string, Population_2024 bigint")
    out = spark.createDataFrame([("Greenland*", 3.5)], f"Entity string, `{economy.OUTPUT}` double")
    got = {r["Country"]: r for r in economy.backfill_countries(have, pop, out).collect()}
    assert len(got) == 46 and got["Guam"]["Year"] == 2020
    g = got["Greenland"]
    assert (g["Population_2024"], g["Entity"], g["Year"], g[economy.OUTPUT]) == (56, "Greenland*", 2023, 3.5)
    assert got["South Korea"]["Entity"] == "Korea, Rep." and got["Tonga"]["Population_2024"] is None


def test_outlook(spark):
    rng = np.random.default_rng(1)
    names = [("111", "Farms"), ("31G", "Manufacturing"), ("52", "Finance and insurance"), ("GDP", "Gross domestic product")]
    rows_ = []
    for k, (code, name) in enumerate(names):
        for i in range(32):
            value = "(NA)" if (k, i) == (0, 5) else f"{1000 * (k + 1) + 10 * i + rng.normal():,.1f}"
            rows_.append({"TableID": "1", "Year": str(2005 + i // 4), "Quarter": ["I", "II", "III", "IV"][i % 4], "Industry": code,
                          "IndustrYDescription": name, "DataValue": value})
    rows_.append({**rows_[0], "TableID": "2"})
    import json
    body = json.dumps({"BEAAPI": {"Results": [{"Data": rows_}]}})
    panel = outlook.industry_panel(envelope(spark.createDataFrame([(body,)], "value string"), outlook.INDUSTRY_FIELDS))
    assert panel.count() == 128
    single = outlook.industries_only(panel)
    assert single.count() == 96 and single.where("value is null").count() == 0
    shares = outlook.key_shares(panel, F.col("series_id") != "GDP")
    assert {r["series_name"] for r in shares.collect()} == {"Manufacturing", "Finance and insurance"}
    sectors = literal_table(spark, outlook.SECTORS, "series_name string, sector string")
    named = single.withColumn("series_name", F.col("series_name"))
    out = outlook.industry_outlook(named.select("series_name", "period", "value"), sectors, key="series_name")
    best = rows(out["by_value"].select("rank", "series_name"), "rank")
    assert [b[1] for b in best] == ["Finance and insurance", "Manufacturing", "Farms"]
    assert out["rows"].count() == 120 and out["summary"].first()["series"] == 3
    first = out["rows"].where("series_name = 'Farms'").orderBy("step").first()
    assert first["period"] == dt.date(2013, 3, 31) and first["year_label"] == 2025
    assert {r["sector"] for r in out["sectors"].collect()} == {"Agriculture", "Manufacturing", "Finance"}


def test_state_frames(spark):
    data = [(g, f"{2010 + i // 4}Q{i % 4 + 1}", str(100.0 + i + j)) for j, g in enumerate([*outlook.REGIONS, "Ohio"]) for i in range(8 - (g == "Plains"))]
    panel = outlook.state_panel(spark.createDataFrame(data, "GeoName string, TimePeriod string, DataValue string"))
    parts = outlook.split_states(panel)
    assert parts["states"].count() == 8 and parts["country"].count() == 8
    f = outlook.region_features(panel)
    assert f.columns == ["period", "target_gdp", *outlook.REGIONS[:-1]] and f.count() == 7


def test_catalogue_input_is_read_once(spark, monkeypatch):
    """The medians, which read a frame several times, read the stored one."""
    class Seen(Exception):
        pass

    def seen(df, *_, **__):
        raise Seen(df.inputFiles())

    monkeypatch.setattr(catalogue, "fill_group_median", seen)
    with pytest.raises(Seen) as told:
        catalogue.impute_catalogue(spark.range(3).withColumn("mag", F.col("id") * 1.0))
    assert any("tablewright-" in f for f in told.value.args[0])
