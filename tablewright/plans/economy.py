"""Population and output of countries: preparation, regression, country names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.numbers import percent_fraction, to_double, to_long, without_separators
from tablewright.functions.text import null_tokens
from tablewright.operators import joining, learners as ml, panel as pn, regression as rg, scaling
from tablewright.operators.filters import complete_rows, require
from tablewright.operators.schema import normalise_headers
from tablewright.session import cut_lineage

FEATURES = ["Population_historical", "Pop_Growth"]
# fixed values: value column of the output file
OUTPUT = "GDP (constant 2015 USD)"

# fixed values: country names and their counterpart in the output table, applied once
COUNTRY_NAMES = {
    "United States": "United States",
    "South Korea": "Korea, Rep.",
    "North Korea": "Korea, Dem. People’s Rep.",
    "DR Congo": "Democratic Republic of Congo",
    "Côte d'Ivoire": "Cote d'Ivoire",
    "Syria": "Syrian Arab Republic",
    "Cape Verde": "Cabo Verde",
    "Timor-Leste": "East Timor",
    "Micronesia": "Micronesia (country)",
    "Saint Kitts & Nevis": "Saint Kitts and Nevis",
    "Sint Maarten": "Sint Maarten (Dutch part)",
    "Saint Vincent & Grenadines": "Saint Vincent and the Grenadines",
    "Curacao": "Curaçao",
    "Czechia": "Czech Republic (Czechia)",
    "Sao Tome and Principe": "Sao Tome & Principe",
    "Palestine": "State of Palestine",
    "Turks and Caicos Islands": "Turks and Caicos",
    "Taiwan": "Taiwan*",
    "United States of America": "United States",
    "Greenland": "Greenland*",
    "Korea, Dem. People’s Rep.": "North Korea",
    "Korea, Rep.": "South Korea",
    "Reunion": "Réunion",
    "Saint Vincent and the Grenadines": "St. Vincent & Grenadines",
    "Saint Helena, Ascension and Tristan da Cunha": "Saint Helena",
}
# fixed values: countries that must be in the result
LISTED_COUNTRIES = (
    "United States of America", "Greenland", "North Korea", "South Korea", "Taiwan", "Sao Tome & Principe", "Guam",
    "Gibraltar", "Martinique", "French Polynesia", "Réunion", "Western Sahara", "Eritrea", "Isle of Man",
    "Caribbean Netherlands", "British Virgin Islands", "Cook Islands", "New Caledonia", "Wallis & Futuna",
    "French Guiana", "Liechtenstein", "Mayotte", "Saint Martin", "Tokelau", "Anguilla", "Tonga", "South Sudan", "Yemen",
    "Falkland Islands", "Syrian Arab Republic", "Holy See", "Saint Helena", "Northern Mariana Islands", "San Marino",
    "Niue", "Saint Barthelemy", "Guadeloupe", "Lebanon", "State of Palestine", "U.S. Virgin Islands",
    "Saint Pierre & Miquelon", "Venezuela", "American Samoa", "Montserrat", "Cabo Verde", "Bhutan")
BACKFILL_YEAR = 2023

# fixed values: columns of the yearly population file
WORLD_POPULATION = ("Rank", "Country", "Population (2024)", "Yearly Change", "Net Change", "Density (P/Km²)",
                    "Land Area (Km²)", "Migrants (net)", "Fert. Rate", "Med. Age", "Urban Pop %", "World Share")
WORLD_POPULATION_DDL = ", ".join(f"`{c}` string" for c in WORLD_POPULATION)


def world_population(raw: DataFrame) -> DataFrame:
    """Typed yearly population table: separators, percent signs and N.A. cells resolved."""
    def text(i):
        return null_tokens(F.col(f"`{WORLD_POPULATION[i]}`"))
    def plain(i):
        return to_double(without_separators(text(i)))
    return raw.select(
        text(0).try_cast("int").alias("rank"), text(1).alias("Country"), to_long(text(2)).alias("Population_2024"),
        percent_fraction(text(3)).alias("Yearly_Change"), to_long(text(4)).alias("Net_Change"), plain(5).alias("density"),
        plain(6).alias("land_area"), to_long(text(7)).alias("migrants"), plain(8).alias("fertility"),
        plain(9).alias("median_age"), percent_fraction(text(10)).alias("urban_share"), percent_fraction(text(11)).alias("world_share"))


def prepare_population(population: DataFrame, since: int = 1950) -> DataFrame:
    """Clean headers, rows since a year, and growth against the previous year (0 for the first)."""
    p = normalise_headers(population).where(F.col("Year") >= since)
    return pn.growth(p, ["Entity"], "Year", "Population_historical", "Pop_Growth", first=0.0)


def prepare(population: DataFrame, output: DataFrame, since: int = 1950, scaled: bool = True) -> DataFrame:
    """Population joined with the latest year's output, complete rows, the three measures scaled to [0, 1]."""
    typed = output.withColumn(OUTPUT, to_double(F.col(f"`{OUTPUT}`").cast("string")))
    joined = joining.inner_on_latest(prepare_population(population, since), typed, ["Entity"], "Year", [OUTPUT])
    ready = cut_lineage(complete_rows(require(joined, *FEATURES)), "economy")  # limits and reports read it again
    return scaling.minmax(ready, [*FEATURES, OUTPUT]) if scaled else ready


def regression_report(ready: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Coefficient table and summary of output on population and growth."""
    return (rg.ols_coefficients(ready, FEATURES, OUTPUT), rg.ols_summary(ready, FEATURES, OUTPUT, ["Entity", "Year"]))


def predict_output(ready: DataFrame, rounds: int = 50) -> DataFrame:
    """Held-out rows with the prediction of a boosted model stopped early on a validation share."""
    d = rg.hash_split(ready, ["Entity", "Year"], 20)
    d = rg.hash_split(d, ["Entity", "Year"], 10, seed=7, into="_fit").withColumn("_valid", ~F.col("_fit"))
    model = ml.boosted_early_stop(d.where("is_train"), FEATURES, OUTPUT, "_valid", rounds)
    return ml.score(d.where("not is_train"), model, FEATURES, "prediction").drop("_fit", "_valid", "is_train")


def backfill_countries(df: DataFrame, population: DataFrame, output: DataFrame) -> DataFrame:
    """Append the listed countries that are absent, with what the two source tables know about them.

    ``population`` holds (Country, Population_2024); ``output`` holds (Entity, output value).
    """
    spark = df.sparkSession
    listed = spark.createDataFrame([(c,) for c in LISTED_COUNTRIES], "Country string").withColumn(
        "Entity", joining.map_values(F.col("Country"), COUNTRY_NAMES))
    lookups = [(population.select(F.col("Country").alias("_name"), "Population_2024"), "_name", "Country"),
               (output.select(F.col("Entity").alias("_name"), OUTPUT), "_name", "Entity")]
    return joining.backfill_missing(df, listed, "Country", lookups, {"Year": F.lit(BACKFILL_YEAR)})
