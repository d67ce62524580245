"""Session construction, the shared scratch folder and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def build_session(app: str = "tablewright", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC timestamps.

    ``master`` and every size-related setting stay with the cluster unless given.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a temporary folder: on a
    cluster a machine-local path would be lost with its executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tablewright-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder, in a sub-folder named after the application."""
    return f"{scratch_dir(spark)}/tablewright-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    Used where a result is read several times: the work before it runs once, survives lost
    executors, and the new frame has real sizes, so later joins choose their strategy from them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deal_by_range(df: DataFrame, by, name: str, parts: int | None = None) -> DataFrame:
    """``df`` range-partitioned by the columns, with the number of its range as column ``name``.

    The ranges come from a sample, so they hold about equally many rows; store the result before it is read twice.
    ``parts`` defaults to the session's shuffle partitions.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, *by).withColumn(name, F.spark_partition_id())


def small_frame(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """A frame of driver-side rows as a local relation: no Python workers, true size known to the planner."""
    shape = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    table = pa.Table.from_pylist([dict(zip(shape.names, r)) for r in rows], schema=to_arrow_schema(shape))
    return spark.createDataFrame(table, schema=shape)


def measured(stats: DataFrame) -> DataFrame:
    """Store an aggregate that a large side is about to be joined with.

    The planner otherwise assumes an aggregate to be as large as its input and shuffles both
    sides. With the stored table it sees the real size: small statistics are broadcast and the
    large side is not shuffled; big ones take the shuffle join with skew handling.
    """
    return cut_lineage(stats, "stats")
