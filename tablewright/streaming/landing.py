"""The page loop of a paged query as an incremental job.

A fetcher drops one file per response page. Each run picks up the pages that arrived since
the last one (file-source offsets in the checkpoint) and stops; an empty page adds nothing.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tablewright.sources.json_pages import features


def land_new_pages(spark: SparkSession, pages: str, target: str, checkpoint: str, attributes: str,
                   whole: bool = True) -> None:
    """Append the features of not yet landed pages to a parquet folder, exactly once.

    ``whole`` files hold one response each; otherwise each line is a response.
    """
    arrived = spark.readStream.format("text").option("wholetext", whole).schema("value string").load(pages)
    run = (features(arrived, attributes).writeStream.format("parquet").option("path", target)
           .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    run.awaitTermination()
