"""CSV with a declared schema, tolerant of bad lines and legacy encodings."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from tablewright.operators.schema import flatten_structs

LOG = logging.getLogger(__name__)
BAD_LINE = "_bad_line"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, encoding: str = "UTF-8",
             keep_bad_lines: bool = False) -> DataFrame:
    """Header CSV under a declared schema; with ``keep_bad_lines`` unreadable lines land in `_bad_line`.

    All-string schemas plus `operators.schema.apply_contract` give coercive casts.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
    reader = spark.read.option("header", True).option("encoding", encoding).option("mode", "PERMISSIVE")
    # only quoted fields may hold commas; doubled quotes stand for a quote
    reader = reader.option("quote", '"').option("escape", '"')
    if keep_bad_lines:
        wanted = wanted.add(BAD_LINE, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", BAD_LINE)
    return reader.schema(wanted).csv(path)


def try_read_csv(spark: SparkSession, path: str, schema, encoding: str = "ISO-8859-1") -> DataFrame | None:
    """As `read_csv`, but a missing source is reported and gives None."""
    try:
        return read_csv(spark, path, schema, encoding)
    except AnalysisException as error:
        LOG.warning("cannot read %s: %s", path, error)
        return None


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, replacing the target; struct columns become one column per field."""
    flatten_structs(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
