"""Daily snow archives as a data source: spark.read.format("snow_archives").

A partition is ``days`` archives (8 by default), one after another. Conditions on ``t`` are taken over when the plan is
made, so that archives of other days are not opened. With ``mode`` "headers" a task reads the tar
headers and the text member, and skips the grids; with "pixels" (the default) it inflates each grid
once. Options: ``path`` (a folder), ``pattern`` (of the file name, whose first group is the day as
yyyymmdd), ``fill``, ``days``.

Files are opened by Arrow's file systems (local, hdfs, s3, gs) on the executors. For a store that
only Spark reads there is ``archives.snow_pixels`` over binary files. Pushing conditions down needs
spark.sql.python.filterPushdown.enabled; without it they are applied after reading.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from catchment.sources.archives import Archive

PIXELS = "t date, iy int, ix int, value double"
HEADERS = "t date, path string, rows int, columns int, min_x double, max_y double, dx double, dy double"
# Keys of the header that describe the grid.
GRID = (("rows", "Number of rows", int), ("columns", "Number of columns", int), ("min_x", "Minimum x-axis coordinate", float), ("max_y", "Maximum y-axis coordinate", float), ("dx", "X-axis resolution", float), ("dy", "Y-axis resolution", float))
TESTS = {EqualTo: lambda d, v: d == v, In: lambda d, v: d in v, GreaterThan: lambda d, v: d > v, GreaterThanOrEqual: lambda d, v: d >= v, LessThan: lambda d, v: d < v, LessThanOrEqual: lambda d, v: d <= v}


@dataclass
class Day:
    t: dt.date
    path: str


@dataclass
class Days(InputPartition):
    days: list[Day]


def listing(path: str, pattern: str) -> list[Day]:
    """Archives of a folder by day; names that do not match are other files."""
    store, root = fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri(re.sub(r"^file:", "", path))
    found = []
    for f in store.get_file_info(fs.FileSelector(root)):
        if f.type == fs.FileType.File and (m := re.search(pattern, f.base_name)):
            scheme = path.split("://")[0] + "://" if "://" in path else ""
            found.append(Day(dt.datetime.strptime(m[1], "%Y%m%d").date(), f"{scheme}{f.path}" if not scheme.startswith("file") else f.path))
    return sorted(found, key=lambda d: (d.t, d.path))


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.headers, self.fill = options["path"], options.get("mode", "pixels") == "headers", int(options.get("fill", "-9999"))
        self.pattern = options.get("pattern", r"(\d{8}).*\.tar$")
        self.days = max(1, int(options.get("days", "8")))
        self.conditions: list[tuple[type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            if type(f) in TESTS and f.attribute == ("t",):
                self.conditions.append((type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Days]:
        days = [d for d in listing(self.path, self.pattern) if all(TESTS[kind](d.t, v) for kind, v in self.conditions)]
        return [Days(days[k : k + self.days]) for k in range(0, len(days), self.days)] or [Days([])]

    def read(self, partition: Days) -> Iterator[pa.RecordBatch]:
        for day in partition.days:
            yield from self.one(day)

    def one(self, partition: Day) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(partition.path)
        with store.open_input_file(at) as f:
            archive = Archive(file=f)
            head = archive.header()
            if self.headers:
                columns = {"t": [partition.t], "path": [partition.path], **{c: [kind(head[key])] for c, key, kind in GRID}}
                kinds = [pa.date32(), pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns.values(), kinds, strict=True)], names=list(columns))
                return
            grid = archive.grid(head)
        iy, ix = np.nonzero(grid != self.fill)
        for lo in range(0, len(iy), 200_000):
            y, x = iy[lo : lo + 200_000], ix[lo : lo + 200_000]
            yield pa.RecordBatch.from_arrays([pa.array([partition.t] * len(y), pa.date32()), pa.array(y, pa.int32()), pa.array(x, pa.int32()), pa.array(grid[y, x].astype(float))], names=["t", "iy", "ix", "value"])


class SnowArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "snow_archives"

    def schema(self) -> str:
        return HEADERS if self.options.get("mode", "pixels") == "headers" else PIXELS

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SnowArchives)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
