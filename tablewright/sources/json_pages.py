"""Landed JSON responses: paged feature queries and statistics envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def features(pages: DataFrame, attributes: str, body: str = "value") -> DataFrame:
    """One row per feature of response pages ({"features": [{"attributes": {...}}]}); empty pages give none.

    ``attributes`` is the DDL of the wanted fields, so nothing else is parsed.
    """
    shape = f"features array<struct<attributes: struct<{attributes}>>>"
    rows = pages.select(F.explode(F.from_json(body, shape)["features"]).alias("f"))
    return rows.select("f.attributes.*")


def read_feature_pages(spark: SparkSession, path: str, attributes: str, where: Column | None = None) -> DataFrame:
    """Features of a folder of pages, one whole response per file, with the service-side filter."""
    out = features(spark.read.text(path, wholetext=True), attributes)
    return out if where is None else out.where(where)


def envelope(responses: DataFrame, fields: str, body: str = "value") -> DataFrame:
    """Data rows of a statistics response, whether Results is an object or a one-element list."""
    data = f"Data array<struct<{fields}>>"
    as_object = F.from_json(body, f"BEAAPI struct<Results: struct<{data}>>")["BEAAPI"]["Results"]["Data"]
    as_list = F.from_json(body, f"BEAAPI struct<Results: array<struct<{data}>>>")["BEAAPI"]["Results"]
    first = F.try_element_at(as_list, F.lit(1))["Data"]
    return responses.select(F.inline(F.coalesce(as_object, first)))


def response_error(responses: DataFrame, body: str = "value") -> DataFrame:
    """Error text of responses that carry one."""
    e = F.coalesce(F.get_json_object(body, "$.BEAAPI.Error"), F.get_json_object(body, "$.BEAAPI.Results.Error"))
    return responses.select(e.alias("error")).where("error is not null")
