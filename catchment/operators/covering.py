"""Point lookup by quadtree coverings, for fabrics of small and very large polygons.

Cells of level L are squares of side 2 ** -L at whole multiples of it. A polygon is covered from
the level on which it meets four cells at the most: cells that it leaves are dropped, cells inside
it stay as they are, and cells that its edges meet are split, ``depth`` times. So a covering grows
with a polygon's shape, not with its size, and only points in edge cells need the ray test; inner
cells carry no rings.

A point has one cell on each level that a covering uses, so points meet coverings by an equi-join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.operators.cutting import RINGS, _points
from catchment.operators.geometry import inside
from catchment.sources.tables import cut

LEVELS = range(-40, 41)


def meets(edges: np.ndarray, x0: np.ndarray, y0: np.ndarray, side: float) -> np.ndarray:
    """Whether each closed square meets any of the segments (n, 2, 2)."""
    lo, hi = edges.min(axis=1), edges.max(axis=1)
    near = (lo[None, :, 0] <= x0[:, None] + side) & (hi[None, :, 0] >= x0[:, None]) & (lo[None, :, 1] <= y0[:, None] + side) & (hi[None, :, 1] >= y0[:, None])
    d = edges[:, 1] - edges[:, 0]
    # Corners on both sides of the segment's line, or on it.
    cross = [d[None, :, 0] * (y0[:, None] + b - edges[None, :, 0, 1]) - d[None, :, 1] * (x0[:, None] + a - edges[None, :, 0, 0]) for a in (0.0, side) for b in (0.0, side)]
    return (near & (np.minimum.reduce(cross) <= 0) & (np.maximum.reduce(cross) >= 0)).any(axis=1)


def within(edges: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether each point lies inside: a ray crosses edges an odd number of times."""
    (ax, ay), (bx, by) = edges[:, 0].T, edges[:, 1].T
    spans = (ay[None] > y[:, None]) != (by[None] > y[:, None])
    at = ax[None] + (y[:, None] - ay[None]) * (bx - ax)[None] / np.where(by == ay, 1.0, by - ay)[None]
    return (spans & (x[:, None] < at)).sum(axis=1) % 2 == 1


def cover(rings: list[np.ndarray], depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(level, cx, cy, inner) of a polygon's cells, from coarse to fine."""
    edges = np.concatenate([np.stack([r, np.roll(r, -1, axis=0)], axis=1) for r in rings if len(r)])
    (w, s), (e, n) = rings[0].min(axis=0), rings[0].max(axis=0)
    extent = max(e - w, n - s)
    level = min(max(math.floor(-math.log2(extent)) if extent > 0 else LEVELS[-1], LEVELS[0]), LEVELS[-1] - depth)
    side = 2.0**-level
    cx, cy = (g.ravel() for g in np.meshgrid(np.arange(math.floor(w / side), math.floor(e / side) + 1), np.arange(math.floor(s / side), math.floor(n / side) + 1)))
    for k in range(depth + 1):
        side = 2.0 ** -(level + k)
        hit = np.concatenate([meets(edges, cx[i : i + 512] * side, cy[i : i + 512] * side, side) for i in range(0, len(cx), 512)])
        rest = ~hit
        inner = np.zeros(len(cx), bool)
        inner[rest] = within(edges, (cx[rest] + 0.5) * side, (cy[rest] + 0.5) * side)
        if inner.any():
            yield level + k, cx[inner], cy[inner], True
        cx, cy = cx[hit], cy[hit]
        if not len(cx):
            return
        if k == depth:
            yield level + k, cx, cy, False
            return
        cx, cy = (np.concatenate([2 * c + d for d in ds]) for c, ds in ((cx, (0, 1, 0, 1)), (cy, (0, 0, 1, 1))))


def covering(fabric: DataFrame, depth: int = 4, hru: str = "hru", rings: str = "rings") -> DataFrame:
    """(level, cx, cy, hru, rings) of all polygons; ``rings`` is NULL for inner cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, size = [], 0
            for i, value in enumerate(batch.column(1)):
                shape = _points(value.as_py())
                if shape and len(shape[0]):
                    for level, cx, cy, inner in cover(shape, depth):
                        found.append((level, cx, cy, i, inner))
                        size += len(cx)
                if found and (size > 50_000 or i == batch.num_rows - 1):
                    many = [len(f[1]) for f in found]
                    column = lambda k, kind: pa.array(np.repeat([f[k] for f in found], many), kind)  # noqa: B023, E731
                    at = column(3, pa.int64())
                    cx, cy = (pa.array(np.concatenate([f[k] for f in found]).astype(np.int64)) for k in (1, 2))
                    kept = pa.array(at.to_numpy(), mask=np.repeat([f[4] for f in found], many))
                    yield pa.RecordBatch.from_arrays([column(0, pa.int32()), cx, cy, batch.column(0).take(at), batch.column(1).take(kept)], names=["level", "cx", "cy", "hru", "rings"])
                    found, size = [], 0

    some = fabric.select(F.col(hru).cast("long").alias("hru"), F.col(rings).cast(RINGS).alias("rings"))
    return some.repartition("hru").mapInArrow(run, f"level int, cx long, cy long, hru long, rings {RINGS}")


KEY = ["level", "cx", "cy"]


def foremost(cells: DataFrame, levels: list[int], crowd: int = 8) -> DataFrame:
    """``cells`` without those that cannot give any point its least polygon.

    Of the inner cells of one place the least id stays. Where more than ``crowd`` polygons have an
    edge cell, those go that come after a polygon of which this cell or one around it is an inner cell.
    """
    inner = cells.where("rings is null").groupBy(*KEY).agg(F.min("hru").alias("hru"))
    edges = cells.where("rings is not null")
    around = edges.groupBy(*KEY).count().where(F.col("count") > crowd).withColumn("up", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).where("up <= level")
    wide = F.pow(F.lit(2.0), F.col("level") - F.col("up"))
    around = around.withColumns({"ux": F.floor(F.col("cx") / wide), "uy": F.floor(F.col("cy") / wide)})
    # Marked for a shuffle: Spark judges by the size of packed files, and a fabric's cells are many times as large.
    first = around.join(inner.select(*(F.col(c).alias(a) for c, a in zip((*KEY, "hru"), ("up", "ux", "uy", "first"), strict=True))).hint("merge"), ["up", "ux", "uy"])
    first = first.groupBy(*KEY).agg(F.min("first").alias("first"))
    edges = edges.join(first, KEY, "left").where(F.col("first").isNull() | (F.col("hru") < F.col("first")))
    return edges.select(*KEY, "hru", "rings").unionByName(inner.withColumn("rings", F.lit(None).cast(RINGS)))


def locate(points: DataFrame, cells: DataFrame, x: str = "x", y: str = "y", hru: str = "hru") -> DataFrame:
    """``points`` with the polygon of a covering that each lies in, NULL outside; the least id of several.

    Points of one place are looked up once, on the levels that the covering has (81 at the most).
    The covering is written first, and only its foremost cells meet points.
    """
    cells = cut(cells.select(*KEY, "hru", "rings"))
    levels = [r["level"] for r in cells.select("level").distinct().collect()]
    places = points.select(F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")).where("__x is not null and __y is not null").distinct()
    size = F.pow(F.lit(2.0), -F.col("level"))
    keyed = places.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumns({"cx": F.floor(F.col("__x") / size), "cy": F.floor(F.col("__y") / size)})
    met = keyed.join(foremost(cells, levels).withColumnsRenamed({"hru": "__hru", "rings": "__rings"}).hint("merge"), KEY)
    found = met.where(F.col("__rings").isNull() | inside(F.col("__x"), F.col("__y"), F.col("__rings"))).groupBy("__x", "__y").agg(F.min("__hru").alias(hru))
    return points.join(found, (F.col(x) == F.col("__x")) & (F.col(y) == F.col("__y")), "left").select(*points.columns, hru)
