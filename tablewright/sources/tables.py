"""Catalog tables, SQL reads and literal tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.session import small_frame


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by=(), buckets: int = 0,
                  bucket_by=()) -> None:
    """Write a catalog table, replacing an existing one; ``path`` keeps its files in a shared folder.

    Tables bucketed alike on a key are later joined on it without a shuffle.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def run_sql(spark: SparkSession, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL over catalog tables and the given frames; the result is partitioned, not chunked."""
    return spark.sql(query, args=args, **frames)


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small table from Python rows (lookups, lists)."""
    return small_frame(spark, rows, schema)


def integers(spark: SparkSession, name: str, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(name))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows, for display."""
    return df.limit(n)


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
