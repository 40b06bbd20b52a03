"""Polygons cut by the cells of a grid in another system, in the polygons' equal-area system.

A cell of a geographic grid is a tilted quadrilateral there. Its area inside a polygon is one
closed form per pair of edge and cell, so that concave rings and holes need no clipping; areas
come in the square metres of the equal-area system whatever the grid's own units are.

Polygons meet cells by an equi-join on square buckets: a polygon is cut to the buckets that it
meets, a cell stands in every bucket that its box meets, and what a cell shares with the pieces of
a polygon adds up. So neither a polygon's size nor a bucket's number of polygons bounds what a
task can do, and no pair is counted twice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.functions.projections import to_albers
from catchment.operators.geometry import bounds
from catchment.sources.tables import cut

RINGS = "array<array<struct<x:double,y:double>>>"
#: Cells along a block's side, from coarse to fine; each holds the next a whole number of times.
BLOCKS = (512, 64, 8)


def lonlat_cells(spark: SparkSession, x0: float, y0: float, dx: float, dy: float, nx: int, ny: int, project=to_albers, near: DataFrame | None = None, rings: str = "rings") -> DataFrame:
    """(iy, ix, corners) of a regular geographic grid, corners projected by ``project(lon, lat)``.

    With ``near``, a fabric in the projected system, only cells of blocks that its polygons' boxes
    may meet: the work grows with them then, not with the grid. Blocks are looked for at once.
    """
    if near is None:
        cells = spark.range(nx * ny).select((F.col("id") / nx).cast("int").alias("iy"), (F.col("id") % nx).cast("int").alias("ix"))
    else:
        cells = _inside(cut(_blocks(spark, (x0, y0, dx, dy, nx, ny), project, near, rings)).repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), BLOCKS[-1], 1, nx, ny)
    west, south = x0 + F.col("ix") * dx, y0 + F.col("iy") * dy
    return with_corners(cells.withColumns({"w": west, "e": west + dx, "s": south, "n": south + dy}), project).select("iy", "ix", "corners")


def _inside(blocks: DataFrame, side: int, part: int, nx: int, ny: int) -> DataFrame:
    """(iy, ix) of the parts, ``part`` cells wide, of blocks (iy, ix) that are ``side`` cells wide; a last part may reach beyond the grid."""
    k = side // part
    step = lambda c: F.explode(F.sequence(F.col(c) * k, F.col(c) * k + (k - 1)))
    parts = blocks.withColumn("iy", step("iy")).withColumn("ix", step("ix")).where((F.col("ix") * part < nx) & (F.col("iy") * part < ny))
    return parts.select(F.col("iy").cast("int").alias("iy"), F.col("ix").cast("int").alias("ix"))


def _blocks(spark: SparkSession, grid: tuple[float, float, float, float, int, int], project, near: DataFrame, rings: str) -> DataFrame:
    """(iy, ix) of the finest blocks of a grid that may meet a fabric's boxes, found from coarse to fine.

    A block's cells lie within its projected rim, corner by corner, so the rim's box holds them all.
    Blocks and polygons meet on square buckets of a block's size. Blocks whose rim leaves the
    projection's domain stay.
    """
    x0, y0, dx, dy, nx, ny = grid
    some = spark.range(25).select((F.col("id") % 5 * (nx - 1) / 4).cast("int").alias("ix"), (F.floor(F.col("id") / 5) * (ny - 1) / 4).cast("int").alias("iy"))
    west, south = x0 + F.col("ix") * dx, y0 + F.col("iy") * dy
    mean = bucket_side(with_corners(some.withColumns({"w": west, "e": west + dx, "s": south, "n": south + dy}), project), 1)
    boxes = near.select(*(c.alias(n) for c, n in zip(bounds(F.col(rings)), "wsen", strict=True)))
    found = None
    for k, b in enumerate(BLOCKS):
        if k:
            blocks = _inside(found, BLOCKS[k - 1], b, nx, ny)
        else:
            wide = -(-nx // b)
            blocks = spark.range(wide * -(-ny // b)).select(F.floor(F.col("id") / wide).cast("int").alias("iy"), (F.col("id") % wide).cast("int").alias("ix"))
        rim = blocks.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4 * b - 1)))).withColumns({"side": F.floor(F.col("k") / b), "p": F.col("k") % b})
        # Around the rim: p cells to the east, to the north, and the same on the far sides from the far corner.
        along = lambda flat: F.when(F.col("side") == flat, F.col("p")).when(F.col("side") == flat + 2, b - F.col("p")).when(F.col("side").isin(0, 3), 0).otherwise(b)  # noqa: B023, E731
        lon, lat = x0 + F.least(F.col("ix") * b + along(0), F.lit(nx)) * dx, y0 + F.least(F.col("iy") * b + along(1), F.lit(ny)) * dy
        px, py = project(lon, lat)
        rim = rim.select("iy", "ix", px.alias("x"), py.alias("y"))
        odd = F.col("x").isNull() | F.col("y").isNull() | F.isnan("x") | F.isnan("y")
        ends = rim.groupBy("iy", "ix").agg(F.max(odd).alias("odd"), *(f(c).alias(n) for f, c, n in ((F.min, "x", "w"), (F.max, "x", "e"), (F.min, "y", "s"), (F.max, "y", "n"))))
        size = b * mean
        # A millionth of a block for rounding.
        steps = lambda lo, hi, more: F.sequence(F.floor(F.col(lo) / size - more), F.floor(F.col(hi) / size + more))  # noqa: B023, E731
        taken = boxes.withColumn("bx", F.explode(steps("w", "e", 0.0))).withColumn("by", F.explode(steps("s", "n", 0.0))).select("bx", "by", F.lit(True).alias("taken")).distinct()
        spread = ends.withColumn("bx", F.explode_outer(F.when(~F.col("odd"), steps("w", "e", 1e-6)))).withColumn("by", F.explode_outer(F.when(~F.col("odd"), steps("s", "n", 1e-6))))
        found = spread.join(taken, ["bx", "by"], "left").where("odd or taken").select("iy", "ix").distinct()
    return found


def axis_cells(x_axis: DataFrame, y_axis: DataFrame, project=to_albers) -> DataFrame:
    """The same from irregular axes (idx, lo, hi), such as Gaussian latitudes; the grid is their product."""
    ends = lambda axis, i, lo, hi: axis.select(F.col("idx").cast("int").alias(i), F.col("lo").cast("double").alias(lo), F.col("hi").cast("double").alias(hi))
    return with_corners(ends(y_axis, "iy", "s", "n").crossJoin(ends(x_axis, "ix", "w", "e")), project).select("iy", "ix", "corners")


def with_corners(cells: DataFrame, project=to_albers) -> DataFrame:
    """Adds the projected corners of cells that have w, e, s, n in their own system, in turn around the cell."""
    def corner(x: str, y: str):
        px, py = project(F.col(x), F.col(y))
        return F.struct(px.alias("x"), py.alias("y"))

    return cells.withColumn("corners", F.array(corner("w", "s"), corner("e", "s"), corner("e", "n"), corner("w", "n")))


def _positive(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Mean of max(line, 0) along a line from u to v."""
    hi, lo = np.maximum(u, v), np.minimum(u, v)
    slope = np.where(hi - lo > 0, hi - lo, 1.0)
    return np.where(lo >= 0, (u + v) / 2, np.where(hi > 0, hi * hi / (2 * slope), 0.0))


def _slices(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Levels of the corners of convex cells (n, k, 2) from below, and the cells' left and right ends there, (n, k) each."""
    a, b = cells, np.roll(cells, -1, axis=1)
    level = np.sort(cells[:, :, 1], axis=1)
    y, ya, yb = level[:, :, None], a[:, None, :, 1], b[:, None, :, 1]
    rise = yb - ya
    t = np.clip((y - ya) / np.where(rise == 0, 1.0, rise), 0, 1)
    on = (y >= np.minimum(ya, yb)) & (y <= np.maximum(ya, yb))
    xa, xb = a[:, None, :, 0], b[:, None, :, 0]
    x, flat = xa + t * (xb - xa), rise == 0
    left = np.where(on, np.where(flat, np.minimum(xa, xb), x), np.inf).min(axis=2)
    right = np.where(on, np.where(flat, np.maximum(xa, xb), x), -np.inf).max(axis=2)
    return level, left, right


def areas(rings: list[np.ndarray], cells: np.ndarray, most: int = 1 << 20) -> np.ndarray:
    """Area of a polygon (outline and holes) inside each convex cell (n, k, 2).

    By Green's theorem: an edge adds the integral, over the heights that it spans, of the
    cell's width to the left of the edge. Between two levels of a cell's corners edge, left and
    right end are lines, and the integral is that of max(line, 0) twice.
    """
    level, left, right = _slices(cells)
    out = np.zeros(len(cells))
    for k, ring in enumerate(rings):
        if len(ring) < 3:
            continue
        a, b = ring, np.roll(ring, -1, axis=0)
        use = a[:, 1] != b[:, 1]
        a, b = a[use], b[use]
        total = np.zeros(len(cells))
        step = max(1, most // max(1, len(cells)))
        for lo in range(0, len(a), step):
            p, q = a[lo : lo + step, None, :], b[lo : lo + step, None, :]
            lean = (q[:, :, 0] - p[:, :, 0]) / (q[:, :, 1] - p[:, :, 1])
            for j in range(level.shape[1] - 1):
                y0, y1 = level[None, :, j], level[None, :, j + 1]
                ya, yb = np.clip(p[:, :, 1], y0, y1), np.clip(q[:, :, 1], y0, y1)
                high = np.where(y1 > y0, y1 - y0, 1.0)
                ends = []
                for y in (ya, yb):
                    t = (y - y0) / high
                    x_left = left[None, :, j] + t * (left[:, j + 1] - left[:, j])[None]
                    x_right = right[None, :, j] + t * (right[:, j + 1] - right[:, j])[None]
                    x = p[:, :, 0] + (y - p[:, :, 1]) * lean
                    ends += [x - x_left, x - x_right]
                u0, w0, u1, w1 = ends
                total += ((yb - ya) * (_positive(u0, u1) - _positive(w0, w1))).sum(axis=0)
        out += np.abs(total) * (-1 if k else 1)
    return np.maximum(out, 0.0)


def half(ring: np.ndarray, axis: int, at: float, above: bool) -> np.ndarray:
    """A ring cut by a line across ``axis``; pieces hang together along the line, which adds no area."""
    if not len(ring):
        return ring
    d = (ring[:, axis] - at) * (1 if above else -1)
    e = np.roll(d, -1)
    cross = (d >= 0) != (e >= 0)
    t = np.divide(d, d - e, out=np.zeros_like(d), where=cross)
    both = np.empty((len(ring), 2, 2))
    both[:, 0], both[:, 1] = ring, ring + t[:, None] * (np.roll(ring, -1, axis=0) - ring)
    return both.reshape(-1, 2)[np.stack([d >= 0, cross], axis=1).ravel()]


def pieces(rings: list[np.ndarray], side: float) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(bx, by, rings) of a polygon cut to the buckets that it meets, first by rows, then by columns."""
    def parts(some: list[np.ndarray], axis: int) -> Iterator[tuple[int, list[np.ndarray]]]:
        lo, hi = (int(math.floor(f(some[0][:, axis]) / side)) for f in (np.min, np.max))
        rest = some
        for i in range(lo, hi + 1):
            if i == hi:
                yield i, rest
                return
            at = (i + 1) * side
            here = [half(r, axis, at, False) for r in rest]
            rest = [half(r, axis, at, True) for r in rest]
            if len(here[0]):
                yield i, here
            if not len(rest[0]):
                return

    for by, row in parts(rings, 1):
        for bx, one in parts(row, 0):
            yield bx, by, one


def _points(part) -> list[np.ndarray]:
    """Rings of one Arrow value as arrays."""
    return [np.array([(p["x"], p["y"]) for p in r], float).reshape(-1, 2) for r in part or []]


def _cells(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(iy, ix, corners) of each of the lists; the cells of one list have equally many corners."""
    flat, rows = lists.values, lists.offsets.to_numpy()
    iy, ix, points = (flat.field(c) for c in ("iy", "ix", "corners"))
    iy, ix, at = iy.to_numpy(), ix.to_numpy(), points.offsets.to_numpy()
    xy = np.stack([points.values.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y")], axis=1)
    for lo, hi in zip(rows[:-1], rows[1:], strict=True):
        yield iy[lo:hi], ix[lo:hi], xy[at[lo] : at[hi]].reshape(hi - lo, at[lo + 1] - at[lo], 2)


def bucketed(fabric: DataFrame, side: float, hru: str = "hru", rings: str = "rings") -> DataFrame:
    """(bx, by, hru, rings) of polygons cut to square buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
        for batch in batches:
            for one, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shape = _points(value)
                if not shape or not len(shape[0]):
                    continue
                found = list(pieces(shape, side))
                for lo in range(0, len(found), 256):
                    some = found[lo : lo + 256]
                    value = [[[{"x": x, "y": y} for x, y in r.tolist()] for r in p] for _, _, p in some]
                    yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in some], pa.int64()), pa.array([s[1] for s in some], pa.int64()), pa.array([one] * len(some), pa.int64()), pa.array(value, kind)], names=["bx", "by", "hru", "rings"])

    some = fabric.select(F.col(hru).cast("long").alias("hru"), F.col(rings).cast(RINGS).alias("rings"))
    return some.repartition("hru").mapInArrow(run, f"bx long, by long, hru long, rings {RINGS}")


def bucket_side(cells: DataFrame, per_side: int = 12) -> float:
    """A bucket of about ``per_side`` x ``per_side`` cells, from the cells' mean extent."""
    xs, ys = F.transform("corners", lambda p: p["x"]), F.transform("corners", lambda p: p["y"])
    r = cells.select((F.array_max(xs) - F.array_min(xs)).alias("w"), (F.array_max(ys) - F.array_min(ys)).alias("h")).agg(F.avg("w"), F.avg("h")).first()
    return per_side * max(r[0] or 1.0, r[1] or 1.0)


def cell_weights(fabric: DataFrame, cells: DataFrame, side: float | None = None, hru: str = "hru", rings: str = "rings") -> DataFrame:
    """(iy, ix, hru, area) of every pair of cell (iy, ix, corners) and polygon that share area.

    Both are in one equal-area system; ``geometry.project`` brings a geographic fabric there.
    Cells are convex. A cell that only touches a polygon is left out. A fabric with a row per
    part of a polygon has its parts added up.
    """
    side = side or bucket_side(cells)
    xs, ys = F.transform("corners", lambda p: p["x"]), F.transform("corners", lambda p: p["y"])
    at = lambda f, v: F.floor(f(v) / side)
    spread = cells.withColumn("bx", F.explode(F.sequence(at(F.array_min, xs), at(F.array_max, xs)))).withColumn("by", F.explode(F.sequence(at(F.array_min, ys), at(F.array_max, ys))))
    # A bucket's cells are a bounded list, so a polygon's piece travels once for all of them.
    groups = spread.groupBy("bx", "by").agg(F.collect_list(F.struct("iy", "ix", "corners")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, value, (iy, ix, corners) in zip(batch.column(0).to_pylist(), batch.column(1), _cells(batch.column(2)), strict=True):
                shape = _points(value.as_py())
                outline = shape[0]
                lo, hi = corners.min(axis=1), corners.max(axis=1)
                near = np.nonzero(((lo <= outline.max(axis=0)) & (hi >= outline.min(axis=0))).all(axis=1))[0]
                if not len(near):
                    continue
                area = areas(shape, corners[near])
                # What is left of a cell that only touches the piece is rounding.
                keep = area > 1e-11 * (hi - lo)[near].prod(axis=1)
                near = near[keep]
                yield pa.RecordBatch.from_arrays([pa.array(iy[near], pa.int32()), pa.array(ix[near], pa.int32()), pa.array([one] * len(near), pa.int64()), pa.array(area[keep])], names=["iy", "ix", "hru", "area"])

    met = bucketed(fabric, side, hru, rings).join(groups, ["bx", "by"]).select("hru", "rings", "cells")
    return met.mapInArrow(run, "iy int, ix int, hru long, area double").groupBy("iy", "ix", "hru").agg(F.sum("area").alias("area"))
