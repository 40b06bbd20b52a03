"""Polygons as rings of points: areas, centroids, weights against a grid, point lookup.

``rings`` is ARRAY<ARRAY<STRUCT<x, y>>>: the first ring is the outline, the others are
holes. Rings may repeat their first point at the end or not, in either direction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.functions.projections import from_albers


def _edges(ring: Column, term) -> Column:
    """Sum of ``term(p, q)`` over the edges of a ring, its closing edge included."""
    turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.aggregate(F.zip_with(ring, turned, term), F.lit(0.0), lambda acc, v: acc + v)


def _cross(p: Column, q: Column) -> Column:
    return p["x"] * q["y"] - q["x"] * p["y"]


def ring_area(ring: Column) -> Column:
    return F.abs(_edges(ring, _cross)) / 2


def area(rings: Column) -> Column:
    """Area of the outline less its holes."""
    return F.aggregate(F.transform(rings, lambda r, i: F.when(i == 0, ring_area(r)).otherwise(-ring_area(r))), F.lit(0.0), lambda acc, v: acc + v)


def centroid(rings: Column) -> tuple[Column, Column]:
    """Centroid of the outline less its holes; NULL for an empty area."""

    def moment(axis: str) -> Column:
        def one(r: Column) -> Column:
            signed = _edges(r, _cross)
            return F.signum(signed) * _edges(r, lambda p, q: (p[axis] + q[axis]) * _cross(p, q)) / 6

        return F.aggregate(F.transform(rings, lambda r, i: F.when(i == 0, one(r)).otherwise(-one(r))), F.lit(0.0), lambda acc, v: acc + v)

    a = area(rings)
    return tuple(F.when(a > 0, moment(axis) / F.when(a > 0, a)) for axis in ("x", "y"))


def area_and_centroids(fabric: DataFrame, rings: str = "rings") -> DataFrame:
    """Adds area_m2, centroid_x, centroid_y, centroid_lon, centroid_lat to a fabric in the equal-area system.

    A fabric with a ``part`` column gives one row (hru and these) per polygon of all its parts.
    """
    x, y = centroid(F.col(rings))
    out = fabric.withColumn("area_m2", area(F.col(rings))).withColumn("centroid_x", x).withColumn("centroid_y", y)
    if "part" in fabric.columns:
        middle = lambda c: F.try_divide(F.sum(F.col(c) * F.col("area_m2")), F.sum("area_m2")).alias(c)
        out = out.groupBy("hru").agg(F.sum("area_m2").alias("area_m2"), middle("centroid_x"), middle("centroid_y"))
    lon, lat = from_albers(F.col("centroid_x"), F.col("centroid_y"))
    return out.withColumn("centroid_lon", lon).withColumn("centroid_lat", lat)


def project(rings: Column, to) -> Column:
    """Rings with every point projected by ``to(x, y)``."""
    def point(p: Column) -> Column:
        x, y = to(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda r: F.transform(r, point))


def bounds(rings: Column) -> tuple[Column, Column, Column, Column]:
    """West, south, east, north of the outline."""
    points = rings[0]
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)


def extent(fabric: DataFrame, buffer: float = 0.0, rings: str = "rings") -> DataFrame:
    """One row: the fabric's buffered bounding box and its number of polygons."""
    w, s, e, n = bounds(F.col(rings))
    return fabric.select(w.alias("w"), s.alias("s"), e.alias("e"), n.alias("n")).agg((F.min("w") - buffer).alias("west"), (F.min("s") - buffer).alias("south"), (F.max("e") + buffer).alias("east"), (F.max("n") + buffer).alias("north"), F.count("*").alias("n_polygons"))


def _left_of(ring: np.ndarray, lines: np.ndarray, y0: float, y1: float) -> np.ndarray:
    """Signed area of the ring within y0..y1 and left of each vertical line, up to one constant.

    By Green's theorem this is the integral of min(x, line) dy along the edges, cut to the
    band; along an edge that has a closed form. Concave rings need no special care.
    """
    a, b = ring, np.roll(ring, -1, axis=0)
    rise = b[:, 1] - a[:, 1]
    use = (rise != 0) & (np.maximum(a[:, 1], b[:, 1]) > y0) & (np.minimum(a[:, 1], b[:, 1]) < y1)
    a, b, rise = a[use], b[use], rise[use]
    slope = (b[:, 0] - a[:, 0]) / rise
    ya, yb = np.clip(a[:, 1], y0, y1), np.clip(b[:, 1], y0, y1)
    xa, xb = a[:, 0] + (ya - a[:, 1]) * slope, a[:, 0] + (yb - a[:, 1]) * slope
    lo, hi = np.minimum(xa, xb)[:, None], np.maximum(xa, xb)[:, None]
    c = np.clip(lines[None, :], lo, hi)
    part = np.divide(c - lo, hi - lo, out=np.zeros_like(c), where=hi > lo)
    mean = np.where(lines[None, :] <= lo, lines[None, :], part * (lo + c) / 2 + (1 - part) * c)
    mean = np.where(lines[None, :] >= hi, (lo + hi) / 2, mean)
    return ((yb - ya)[:, None] * mean).sum(axis=0)


def clip_area(ring: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> float:
    """Area of a ring inside a box."""
    left = _left_of(np.asarray(ring, float).reshape(-1, 2), np.array([x0, x1]), y0, y1)
    return abs(float(left[1] - left[0]))


def _cover(rings: list[np.ndarray], x_lo: np.ndarray, x_hi: np.ndarray, y_lo: np.ndarray, y_hi: np.ndarray) -> np.ndarray:
    """Area of a polygon in each cell, a row per interval of y; holes are taken off."""
    out = np.zeros((len(y_lo), len(x_lo)))
    lines = np.concatenate([x_lo, x_hi])
    for k, ring in enumerate(rings):
        for r, (lo, hi) in enumerate(zip(y_lo, y_hi, strict=True)):
            left = _left_of(ring, lines, lo, hi)
            out[r] += np.abs(left[len(x_lo) :] - left[: len(x_lo)]) * (-1 if k else 1)
    return out


def _weigh(fabric: DataFrame, hru: str, rings: str, axes) -> DataFrame:
    """(iy, ix, hru, area); ``axes(w, s, e, n)`` gives indices and edges of the columns and rows that a box meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shape = [np.array([(p["x"], p["y"]) for p in r], float).reshape(-1, 2) for r in parts or []]
                if not shape or not len(shape[0]):
                    continue
                (w, s), (e, n) = shape[0].min(axis=0), shape[0].max(axis=0)
                ix, x_lo, x_hi, iy, y_lo, y_hi = axes(w, s, e, n)
                area = _cover(shape, x_lo, x_hi, y_lo, y_hi)
                # What is left of a cell that only touches the polygon is rounding.
                r, c = np.nonzero(area > 1e-12 * (x_hi - x_lo)[None, :] * (y_hi - y_lo)[:, None])
                yield pa.RecordBatch.from_arrays([pa.array(iy[r], pa.int32()), pa.array(ix[c], pa.int32()), pa.array(np.full(len(r), one), pa.int64()), pa.array(area[r, c])], names=["iy", "ix", "hru", "area"])

    # Polygons differ in size, so they are dealt out before the work; each travels once.
    some = fabric.select(F.col(hru).cast("long").alias("hru"), F.col(rings).alias("rings"))
    out = some.repartition("hru").mapInArrow(run, "iy int, ix int, hru long, area double")
    return out.groupBy("iy", "ix", "hru").agg(F.sum("area").alias("area")) if "part" in fabric.columns else out


def weights(fabric: DataFrame, x0: float, y0: float, dx: float, dy: float, nx: int, ny: int, hru: str = "hru", rings: str = "rings") -> DataFrame:
    """(iy, ix, hru, area) of every grid cell that a polygon covers in part.

    Candidate cells come from the bounding box by index arithmetic, so no join is needed. A
    fabric with a ``part`` column has a row per part of a polygon; the parts are added up.
    """

    def axes(w, s, e, n):
        ix = np.arange(max(0, int(np.floor((w - x0) / dx))), min(nx, int(np.ceil((e - x0) / dx))))
        iy = np.arange(max(0, int(np.floor((s - y0) / dy))), min(ny, int(np.ceil((n - y0) / dy))))
        return ix, x0 + ix * dx, x0 + (ix + 1) * dx, iy, y0 + iy * dy, y0 + (iy + 1) * dy

    return _weigh(fabric, hru, rings, axes)


def irregular_weights(fabric: DataFrame, x_axis: DataFrame, y_axis: DataFrame, hru: str = "hru", rings: str = "rings", most: int = 1_000_000) -> DataFrame:
    """The same for irregular axes (idx, lo, hi), such as Gaussian latitudes.

    Axes go to every task as sorted arrays, ``most`` intervals each at most; a polygon finds
    its intervals by bisection.
    """
    sides = []
    for axis in (x_axis, y_axis):
        rows = axis.select("idx", F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi")).orderBy("lo").limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"an axis has more than {most} intervals")
        idx, lo, hi = (np.array([r[c] for r in rows], t) for c, t in (("idx", np.int64), ("lo", float), ("hi", float)))
        sides.append((idx, lo, hi, np.maximum.accumulate(hi) if len(hi) else hi))

    def axes(w, s, e, n):
        out = []
        for (idx, lo, hi, reach), a, b in zip(sides, (w, s), (e, n), strict=True):
            at = slice(int(np.searchsorted(reach, a, "right")), int(np.searchsorted(lo, b, "left")))
            keep = hi[at] > a
            out += [idx[at][keep], lo[at][keep], hi[at][keep]]
        return out

    return _weigh(fabric, hru, rings, axes)


def inside(px: Column, py: Column, rings: Column) -> Column:
    """Whether a point lies in the polygon: a ray crosses the edges of all rings an odd number of times."""

    def crossings(r: Column) -> Column:
        def one(p: Column, q: Column) -> Column:
            spans = (p["y"] > py) != (q["y"] > py)
            at = p["x"] + (py - p["y"]) * (q["x"] - p["x"]) / F.when(q["y"] != p["y"], q["y"] - p["y"])
            return F.when(spans & (px < at), 1.0).otherwise(0.0)

        return _edges(r, one)

    return F.aggregate(F.transform(rings, crossings), F.lit(0.0), lambda acc, v: acc + v) % 2 == 1


def locate(points: DataFrame, fabric: DataFrame, cell: float, x: str = "x", y: str = "y", hru: str = "hru", rings: str = "rings") -> DataFrame:
    """``points`` with the polygon each lies in, NULL outside; the least id of several.

    Both sides are keyed by square cells of size ``cell``, so the join is an equi-join;
    points of one place are looked up once.
    """
    w, s, e, n = bounds(F.col(rings))
    at = lambda v: F.floor(v / cell)
    keyed = fabric.select(F.col(hru).alias("__hru"), F.col(rings).alias("__rings"), F.explode(F.sequence(at(w), at(e))).alias("__cx"), at(s).alias("__s"), at(n).alias("__n")).withColumn("__cy", F.explode(F.sequence("__s", "__n"))).drop("__s", "__n")
    places = points.select(F.col(x).alias("__x"), F.col(y).alias("__y")).where("__x is not null and __y is not null").distinct()
    p = places.withColumn("__cx", at(F.col("__x"))).withColumn("__cy", at(F.col("__y")))
    found = p.join(keyed, ["__cx", "__cy"]).where(inside(F.col("__x"), F.col("__y"), F.col("__rings")))
    found = found.groupBy("__x", "__y").agg(F.min("__hru").alias(hru))
    return points.join(found, (F.col(x) == F.col("__x")) & (F.col(y) == F.col("__y")), "left").select(*points.columns, hru)


def locate_all(points: DataFrame, fabric: DataFrame, cell: float, **how) -> DataFrame:
    """Like ``locate``, but a point outside all polygons raises."""
    out = locate(points, fabric, cell, **how)
    if not out.where(F.col(how.get("hru", "hru")).isNull()).isEmpty():
        raise ValueError("a point lies outside all polygons")
    return out
