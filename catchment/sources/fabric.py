"""Fabrics as GeoParquet with covering boxes, so that a scan skips what lies outside a grid.

Polygons are packed into files and row groups by place: strips along x, and by y in a strip. Each
row carries its box as ``bbox`` (xmin, ymin, xmax, ymax), the covering column of GeoParquet 1.1.
Reading for a box turns into filters on its fields, which Spark pushes down to Parquet: row groups
whose boxes lie aside are not read. Files of other writers with such a column are read alike; those
without it are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.operators.geometry import bounds
from catchment.sources.archives import polygons

ENDS = ("xmin", "ymin", "xmax", "ymax")


def with_bbox(fabric: DataFrame, rings: str = "rings") -> DataFrame:
    """Adds the covering box of the outline."""
    w, s, e, n = bounds(F.col(rings))
    return fabric.withColumn("bbox", F.struct(w.alias("xmin"), s.alias("ymin"), e.alias("xmax"), n.alias("ymax")))


def write_fabric(fabric: DataFrame, path: str, files: int = 64, group_bytes: int = 8 << 20) -> None:
    """Write polygons that have a ``bbox``, packed by place into about ``files`` files with row groups of ``group_bytes``."""
    x, y = (F.col("bbox.xmin") + F.col("bbox.xmax")) / 2, (F.col("bbox.ymin") + F.col("bbox.ymax")) / 2
    ends = fabric.agg(F.min(x), F.max(x)).first()
    strips = max(1, math.ceil(math.sqrt(files)))
    width = ((ends[1] - ends[0]) if ends[0] is not None else 0.0) / strips or 1.0
    packed = fabric.withColumn("__strip", F.floor((x - (ends[0] or 0.0)) / width)).withColumn("__y", y)
    packed = packed.repartitionByRange(files, "__strip", "__y").sortWithinPartitions("__strip", "__y").drop("__strip", "__y")
    packed.write.mode("overwrite").option("parquet.block.size", str(group_bytes)).parquet(path)


def meets(box: tuple[float, float, float, float], bbox: str = "bbox") -> Column:
    """Whether a covering box meets (west, south, east, north), as comparisons that Parquet can take."""
    w, s, e, n = box
    f = lambda end: F.col(f"{bbox}.{end}")
    return (f("xmin") <= F.lit(float(e))) & (f("xmax") >= F.lit(float(w))) & (f("ymin") <= F.lit(float(n))) & (f("ymax") >= F.lit(float(s)))


def read_fabric(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None, id_col: str = "hru", blob: str = "geometry") -> DataFrame:
    """(hru, part, rings) of the polygons at ``path`` that may meet ``box``; only their rows' blobs are decoded."""
    rows = spark.read.parquet(path)
    if box is not None and "bbox" in rows.columns:
        rows = rows.where(meets(box))
    return polygons(rows, id_col, blob)
