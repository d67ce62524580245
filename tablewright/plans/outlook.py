"""Industry and state output: panels from statistics responses, shares, forecasts, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.dates import quarter_text_start, roman_quarter
from tablewright.functions.numbers import to_double, without_separators
from tablewright.operators import arima, joining, panel as pn, ranking, reshape
from tablewright.operators.filters import complete_rows, in_list
from tablewright.operators.missing import forward_back_fill
from tablewright.session import cut_lineage

# fixed values: fields of the three responses
INDUSTRY_FIELDS = ("TableID string, Frequency string, Year string, Quarter string, Industry string, "
                   "IndustrYDescription string, DataValue string, NoteRef string")
STATE_FIELDS = ("Code string, GeoFips string, GeoName string, TimePeriod string, CL_UNIT string, "
                "UNIT_MULT string, DataValue string")
INCOME_FIELDS = ("TableName string, SeriesCode string, LineNumber string, LineDescription string, TimePeriod string, "
                 "METRIC_NAME string, CL_UNIT string, UNIT_MULT string, DataValue string, NoteRef string")
# fixed values: industry codes that sum up other industries
AGGREGATES = ("GDP", "PVT", "PSERV", "PGOOD", "PROF", "G", "FIRE", "HS", "GSL", "GSLG", "GSLE", "GF", "GFE", "GFGD",
              "GFGN", "ORE")
# fixed values: regions among the state names; the last is the whole country
REGIONS = ("Far West", "Great Lakes", "Mideast", "New England", "Plains", "Rocky Mountain", "Southeast", "Southwest",
           "United States")
COUNTRY = "United States"
# fixed values: sector of an industry, others are "Other"
SECTORS = (("Agriculture, forestry, fishing, and hunting", "Agriculture"), ("Farms", "Agriculture"),
           ("Manufacturing", "Manufacturing"), ("Retail trade", "Retail"),
           ("Transportation and warehousing", "Transportation"), ("Finance and insurance", "Finance"),
           ("Health care and social assistance", "Healthcare"))
# fixed values: industries whose shares are reported
KEY_INDUSTRIES = ("Manufacturing", "Finance and insurance", "Health care and social assistance")


def _value():
    return to_double(without_separators(F.col("DataValue")))


def industry_panel(rows: DataFrame, table: str = "1") -> DataFrame:
    """(series_id, series_name, period, value) of one table of the industry response."""
    year, quarter = F.col("Year").try_cast("int"), roman_quarter(F.col("Quarter"))
    return rows.where(F.col("TableID") == table).select(
        F.col("Industry").alias("series_id"), F.col("IndustrYDescription").alias("series_name"),
        F.make_date(year, quarter * 3 - 2, F.lit(1)).alias("period"), _value().alias("value"))


def state_panel(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("GeoName").alias("series_id"), quarter_text_start(F.col("TimePeriod")).alias("period"),
                       _value().alias("value"))


def income_panel(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("LineDescription").alias("series_id"), quarter_text_start(F.col("TimePeriod")).alias("period"),
                       _value().alias("value"))


def industries_only(panel: DataFrame) -> DataFrame:
    """Without the aggregate codes, gaps filled forward and then backward within a series."""
    return forward_back_fill(in_list(panel, "series_id", AGGREGATES, negate=True), ["series_id"], "period", ["value"])


def key_shares(panel: DataFrame, members=None) -> DataFrame:
    """Percent of the period's total for the key industries; ``members`` restricts the total."""
    return in_list(pn.share_of_total(panel, "period", "value", members), "series_name", KEY_INDUSTRIES)


def split_states(panel: DataFrame) -> dict[str, DataFrame]:
    """States, regions and the country as separate panels."""
    return {"states": in_list(panel, "series_id", REGIONS, negate=True), "regions": in_list(panel, "series_id", REGIONS),
            "country": panel.where(F.col("series_id") == COUNTRY)}


def region_features(panel: DataFrame) -> DataFrame:
    """period, target_gdp and one column per region, on the common date range, complete rows only."""
    parts = split_states(cut_lineage(panel, "panel"))  # read for the bounds and for the columns
    country, regions = joining.common_range([parts["country"], parts["regions"]], "period")
    wide = reshape.pivot(regions, ["period"], "series_id", "value", REGIONS[:-1])
    target = country.select("period", F.col("value").alias("target_gdp"))
    return complete_rows(joining.align_outer([target, wide], "period"))


def seasonality(panel: DataFrame) -> DataFrame:
    """Per series and quarter of the year: level, growth and year-over-year growth, mean and deviation."""
    p = pn.growth(panel, ["series_id"], "period", "value", "growth", scale=100.0)
    p = pn.year_over_year(p, ["series_id"], "period", "value", "yoy")
    stats = [f(c).alias(f"{c}_{n}") for c in ("value", "growth", "yoy") for f, n in ((F.avg, "mean"), (F.stddev_samp, "std"))]
    return p.groupBy("series_id", F.quarter("period").alias("quarter")).agg(*stats)


def industry_outlook(panel: DataFrame, sectors: DataFrame, key: str = "series_id", sector_key: str | None = None,
                     periods: int = 40, top: int = 15) -> dict[str, DataFrame]:
    """Forecast table of all series and everything ranked from it.

    The forecasts are materialised once (one row per series); all reports read that.
    """
    panel = cut_lineage(panel, "panel")
    table = cut_lineage(arima.arima_search(panel, [key], "period", "value", periods=periods))
    last = panel.groupBy(key).agg(F.max("period").alias("last"))
    rows = reshape.forecast_rows(table.select(key, "forecast").join(last, key), "forecast", "last", legacy_year=2025)
    rolled = ranking.roll_up(rows.select("period", key, "forecast"), "period", key, "forecast", sectors)
    growths = pn.growth_present(rows, [key], "period", "forecast")
    return {
        "table": table,
        "by_value": ranking.ranked(table.drop("forecast"), top, "forecast_avg", key),
        "by_growth": ranking.ranked(table.drop("forecast"), top, "growth_rate", key),
        "summary": ranking.rank_summary(table),
        "rows": rows,
        "sectors": rolled,
        "sector_growth": ranking.sector_growth(rolled, "period", "forecast"),
        "stability": ranking.stability_classes(growths, key, "growth"),
    }
