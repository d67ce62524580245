"""Storm records from three sources, brought to one shape and merged by year."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.dates import date_and_time
from tablewright.functions.numbers import money, to_double
from tablewright.operators.filters import drop_ordinals
from tablewright.operators.joining import three_way_join
from tablewright.operators.schema import drop_columns, keep, lower_headers, pack, rename
from tablewright.sources.html import table_rows

# fixed values: unused fields, new names and final order
FLAT_UNUSED = ("om", "stf", "stn", "tz", "ns", "sn", "sg", "mo", "dy", "f1", "f2", "f3", "f4", "fc")
FEATURE_UNUSED = ("objectid", "om", "mo", "dy", "tz", "stf", "month_calc", "date_calc", "shape__length")
NAMES = {"closs": "Crop Damage", "loss": "Property Damage", "yr": "Year", "st": "state", "inj": "injuries",
         "fat": "fatalities", "len": "length", "wid": "width", "mag": "F-Scale"}
ORDER = ("Year", "state", "start_coords", "end_coords", "datetime", "length", "width", "F-Scale", "injuries",
         "fatalities", "Crop Damage", "Property Damage")
SUMMARY_TABLE = "tornadoSummary"
SUMMARY = ("Year", "Number of Tornadoes", "Direct Injury", "Indirect Injury", "Direct Fatality", "Indirect Fatality",
           "Property Damage", "Crop Damage")


def _shape(df: DataFrame) -> DataFrame:
    timed = df.withColumn("datetime", date_and_time(F.col("date"), F.col("time"))).drop("date", "time")
    placed = pack(pack(rename(timed, NAMES), "start_coords", "slat", "slon"), "end_coords", "elat", "elon")
    return keep(placed, ORDER)


def from_flat_file(raw: DataFrame) -> DataFrame:
    return _shape(drop_columns(raw, FLAT_UNUSED, must_exist=True))


def from_features(raw: DataFrame, first: int = 2009, last: int = 2019) -> DataFrame:
    """Feature attributes of the wanted years; names of any case, unused fields dropped where present."""
    rows = lower_headers(raw).where(F.col("yr").between(first, last))
    return _shape(drop_columns(rows, FEATURE_UNUSED))


def from_summary_page(pages: DataFrame, html: str = "html", header_rows=()) -> DataFrame:
    """Yearly summary: direct and indirect losses added, damages as numbers.

    ``header_rows`` are ordinals of table rows that repeat the header.
    """
    rows = table_rows(pages, html, SUMMARY_TABLE, SUMMARY)
    rows = drop_ordinals(rows, "row", *header_rows) if header_rows else rows
    def both(kind):
        return to_double(F.col(f"Direct {kind}")) + to_double(F.col(f"Indirect {kind}"))
    return rows.select(
        F.col("Year").try_cast("int").alias("Year"), to_double(F.col("`Number of Tornadoes`")).alias("Number of Tornadoes"),
        money(F.col("`Property Damage`")).alias("Property Damage"), money(F.col("`Crop Damage`")).alias("Crop Damage"),
        both("Injury").alias("injuries"), both("Fatality").alias("fatalities"))


def yearly(records: DataFrame) -> DataFrame:
    """Records of a source reduced to the year, the grain the merge needs."""
    totals = ["injuries", "fatalities", "Crop Damage", "Property Damage"]
    return records.groupBy("Year").agg(F.count("*").alias("records"), *[F.sum(f"`{c}`").alias(c) for c in totals])


def merge(flat: DataFrame, features: DataFrame, summary: DataFrame) -> DataFrame:
    """Each flat record with the yearly totals of the other two sources."""
    return three_way_join(flat, yearly(features), summary, "Year")
