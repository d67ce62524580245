"""A paged feature query as a data source: pages are planned by offset, and conditions go to the reader.

The responses of a service are landed as ``<folder>/offset=<n>/<file>``, one response ({"features": [{"attributes":
{...}}]}) per line, n = 0, limit, 2 limit, ... The query ends at the first empty or missing page, as the loop against the
service would. A service has nothing behind an empty page, so that page is found by bisection, and planning opens few files. Each partition reads a run of pages and gives
only the rows that meet the pushed conditions.

    feature_pages.register(spark)
    spark.read.format("feature_pages").schema("yr int, st string").option("path", folder).option("limit", 1000).load().where("yr >= 1996")
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession, types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
                                    LessThan, LessThanOrEqual)
from pyspark.sql.pandas.types import to_arrow_schema

COMPARED = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
            LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b}
PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DoubleType, T.BooleanType)


class Run(InputPartition):
    """Pages that one task reads."""

    def __init__(self, offsets: list[int]):
        self.offsets = offsets


def _features(files: fs.FileSystem, folder: str, offset: int) -> list[dict]:
    found = files.get_file_info(fs.FileSelector(f"{folder}/offset={offset}"))
    out = []
    for name in sorted(f.path for f in found if f.is_file and not f.base_name.startswith(("_", "."))):
        with files.open_input_stream(name) as stream:
            for line in stream.read().decode().splitlines():
                out += [f.get("attributes") or {} for f in (json.loads(line).get("features") or [])] if line.strip() else []
    return out


def cast(value, kind: T.DataType):
    """A JSON value as a value of a plain type; null where it is none."""
    if value is None or isinstance(value, (dict, list)):
        return None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else json.dumps(value)
    if isinstance(kind, T.BooleanType):
        return value if isinstance(value, bool) else None
    try:
        if isinstance(value, bool):
            return None
        if isinstance(kind, T.DoubleType):
            return float(value)
        return int(value) if float(value) == int(float(value)) else None
    except (ValueError, OverflowError):
        return None


class PagesReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.shape, self.conditions = schema, []
        self.folder, self.limit = options["path"].rstrip("/"), int(options.get("limit", "1000"))
        self.a_task = int(options.get("pagesPerTask", "16"))

    def _files(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith("file:") else (fs.LocalFileSystem(), self.folder)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of an attribute with a value are met here, the others are left to Spark."""
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in self.shape.names and isinstance(self.shape[name].dataType, PLAIN) and (type(f) in COMPARED or isinstance(f, IsNotNull)):
                self.conditions.append((name, type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Run]:
        files, folder = self._files()
        names = [f.base_name for f in files.get_file_info(fs.FileSelector(folder))]
        offsets = sorted(int(n.removeprefix("offset=")) for n in names if n.startswith("offset="))
        there = [i * self.limit for i, o in enumerate(offsets) if o == i * self.limit]
        # pages are filled from the front: the first empty one is found by bisection
        low, high = 0, len(there)
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if _features(files, folder, there[middle]) else (low, middle)
        kept = there[:low]
        return [Run(kept[i: i + self.a_task]) for i in range(0, len(kept), self.a_task)] or [Run([])]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        files, folder = self._files()
        kinds, shape = [(f.name, f.dataType) for f in self.shape], to_arrow_schema(self.shape)
        place = {n: i for i, (n, _) in enumerate(kinds)}
        for offset in partition.offsets:
            rows = [[cast(a.get(n), k) for n, k in kinds] for a in _features(files, folder, offset)]
            kept = [r for r in rows if all(r[place[n]] is not None and (how is IsNotNull or COMPARED[how](r[place[n]], v)) for n, how, v in self.conditions)]
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), shape)], schema=shape)


class FeaturePages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feature_pages"

    def schema(self) -> str:
        raise ValueError("name the wanted attributes with .schema(...)")

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagesReader(schema, self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, conditions included."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(FeaturePages)
