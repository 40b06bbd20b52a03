"""Projected cells, sinusoidal pixels and kept weights against closed forms and brute force."""

import datetime as dt
import glob
import math
import struct
import time

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catchment.functions import projections
from catchment.operators import cutting, geometry, raster, zonal
from catchment.plans import queries_grids, runs
from catchment.plans.weightstore import WeightStore, batch_keys, by_place
from catchment.sources import archives, fabric
from catchment.sources.specs import SourceSpec

FABRIC = "hru long, rings array<array<struct<x:double,y:double>>>"


def shoelace(r):
    x, y = r[:, 0], r[:, 1]
    return abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2


def by_clipping(ring, cell):
    """Area inside a convex cell by clipping at its sides one after another."""
    x, y = np.asarray(cell).T
    turn = np.sign((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())
    out = list(map(tuple, ring))
    for i in range(len(cell)):
        a, b = cell[i], cell[(i + 1) % len(cell)]
        side = lambda p: turn * ((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]))  # noqa: B023, E731
        now, out = out, []
        for p, q in zip(now, now[1:] + now[:1], strict=True):
            if side(p) >= 0:
                out.append(p)
            if (side(p) >= 0) != (side(q) >= 0):
                t = side(p) / (side(p) - side(q))
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        if not out:
            return 0.0
    return shoelace(np.array(out))


def star(rng, n, cx=0.0, cy=0.0, size=1.0):
    a = np.sort(rng.uniform(0, 2 * math.pi, n))
    r = size * rng.uniform(0.3, 1.0, n)
    return np.stack([cx + r * np.cos(a), cy + r * np.sin(a)], axis=1)


def test_area_in_tilted_cells():
    """A square turned by an eighth inside and across a box, in closed form; then concave rings with holes against clipping."""
    diamond = np.array([[[1.0, 0], [2, 1], [1, 2], [0, 1]]])
    box = lambda x0, y0, x1, y1: np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)], float)
    assert cutting.areas([box(-1, -1, 3, 3)], diamond)[0] == pytest.approx(2.0, abs=1e-15)
    assert cutting.areas([box(1, -1, 3, 3)], diamond)[0] == pytest.approx(1.0, abs=1e-15)
    assert cutting.areas([box(1, 1, 3, 3)], diamond)[0] == pytest.approx(0.5, abs=1e-15)
    assert cutting.areas([box(0.5, 0.5, 1.5, 1.5)], diamond)[0] == pytest.approx(1.0, abs=1e-15)
    assert cutting.areas([box(-1, -1, 3, 3), box(0.5, 0.5, 1.5, 1.5)], diamond)[0] == pytest.approx(1.0, abs=1e-15)
    assert cutting.areas([box(2, 0, 3, 3)], diamond)[0] == 0.0

    rng = np.random.default_rng(1)
    for trial in range(60):
        ring, hole = star(rng, 30), star(rng, 9, size=0.2)
        cells = []
        for _ in range(12):
            q = np.array([(-1, -1), (1, -1), (1, 1), (-1, 1)]) * rng.uniform(0.1, 1.2) + rng.uniform(-0.2, 0.2, (4, 2)) * 0.3
            t = rng.uniform(0, 2 * math.pi) * (trial % 3 > 0)
            q = q @ np.array([[math.cos(t), math.sin(t)], [-math.sin(t), math.cos(t)]]) + rng.uniform(-1, 1, 2)
            cells.append(q[::-1] if rng.random() < 0.5 else q)
        got = cutting.areas([ring, hole[::-1] if trial % 2 else hole], np.array(cells))
        assert got == pytest.approx([by_clipping(ring, c) - by_clipping(hole, c) for c in cells], abs=1e-12)


def test_pieces_add_up():
    rng = np.random.default_rng(2)
    for side in (0.1, 0.37, 5.0):
        ring, hole = star(rng, 50, 3.3, -2.2), star(rng, 9, 3.3, -2.2, 0.2)
        total, cells = 0.0, []
        for bx, by, parts in cutting.pieces([ring, hole], side):
            assert all((p[:, 0] >= bx * side - 1e-9).all() and (p[:, 0] <= (bx + 1) * side + 1e-9).all() and (p[:, 1] >= by * side - 1e-9).all() and (p[:, 1] <= (by + 1) * side + 1e-9).all() for p in parts if len(p))
            total += shoelace(parts[0]) - sum(shoelace(p) for p in parts[1:] if len(p))
            cells.append((bx, by))
        assert total == pytest.approx(shoelace(ring) - shoelace(hole), abs=1e-12) and len(set(cells)) == len(cells)


def fabric_of(spark, polygons):
    value = lambda rings: [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]
    return spark.createDataFrame([(i, value(p)) for i, p in polygons], FABRIC)


def test_geographic_cells_of_geographic_polygons(spark):
    """Polygons of very different sizes, projected; every one's cells make up its area, whatever the buckets."""
    rng = np.random.default_rng(3)
    polygons = [(i, [star(rng, 40, -100 + 3 * (i % 5), 35 + 2 * (i // 5), (0.004, 0.05, 0.9)[i % 3])]) for i in range(20)] + [(99, [star(rng, 200, -95, 38, 6.0), star(rng, 20, -95, 38, 1.0)])]
    fabric = fabric_of(spark, polygons).withColumn("rings", geometry.project(F.col("rings"), projections.to_albers))
    cells = cutting.lonlat_cells(spark, -110.0, 28.0, 0.25, 0.25, 110, 80)
    area = {r["hru"]: r["a"] for r in fabric.select("hru", geometry.area(F.col("rings")).alias("a")).collect()}
    first = None
    for side in (None, 40_000.0, 3e6):
        rows = {(r["iy"], r["ix"], r["hru"]): r["area"] for r in cutting.cell_weights(fabric, cells, side).collect()}
        for hru, a in area.items():
            assert sum(v for k, v in rows.items() if k[2] == hru) == pytest.approx(a, rel=1e-8, abs=1e-3)
        first = first or rows
        assert rows.keys() == first.keys() and all(v == pytest.approx(first[k], rel=1e-7, abs=1e-3) for k, v in rows.items())
    axis = lambda lo, step, n: spark.createDataFrame([(k, lo + k * step, lo + (k + 1) * step) for k in range(n)], "idx int, lo double, hi double")
    other = {(r["iy"], r["ix"], r["hru"]): r["area"] for r in cutting.cell_weights(fabric, cutting.axis_cells(axis(-110.0, 0.25, 110), axis(28.0, 0.25, 80))).collect()}
    assert other.keys() == first.keys()


def test_cells_near_a_fabric(spark):
    """Of a fine grid only blocks near the polygons are made; the weights are those of all cells."""
    rng = np.random.default_rng(5)
    places = [(-110.0, 28.0, 0.02), (-82.5, 48.0, 0.6), (-95.3, 38.1, 0.3), (-95.0, 38.1, 0.001), (-120.0, 30.0, 0.5)]  # the last lies off the grid
    fabric = fabric_of(spark, [(i, [star(rng, 30, *p)]) for i, p in enumerate(places)]).withColumn("rings", geometry.project(F.col("rings"), projections.to_albers))
    grid = (-110.0, 28.0, 0.0275, 0.025, 1003, 801)
    near = cutting.lonlat_cells(spark, *grid, near=fabric)
    ids = near.select("iy", "ix").collect()
    assert len(ids) == len(set(ids)) < 0.02 * 1003 * 801 and all(0 <= r["ix"] < 1003 and 0 <= r["iy"] < 801 for r in ids)
    weights = lambda cells: {(r["iy"], r["ix"], r["hru"]): r["area"] for r in cutting.cell_weights(fabric, cells, 3e4).collect()}
    got = weights(near)
    assert {k[2] for k in got} == {0, 1, 2, 3} and got == pytest.approx(weights(cutting.lonlat_cells(spark, *grid)), rel=1e-9)
    assert cutting.lonlat_cells(spark, *grid, near=fabric.limit(0)).count() == 0
    # A projection that leaves its domain keeps its blocks, and tiny grids have one block.
    lost = lambda lon, lat: (F.when(lon < -100, lon), lat)
    assert cutting.lonlat_cells(spark, -110.0, 28.0, 5.0, 5.0, 3, 1, lost, near=fabric).count() == 3


def test_weights_of_awkward_fabrics(spark):
    box = np.array([(0, 0), (1, 0), (1, 1), (0, 1)], float)
    d = fabric_of(spark, [(1, [box]), (1, [box + 1])]).unionByName(spark.createDataFrame([(2, None), (3, []), (4, [[]])], FABRIC)).withColumn("area", F.lit("x"))
    cells = cutting.with_corners(spark.createDataFrame([(0, 0, 0.0, 2.0, 0.0, 2.0), (0, 1, 2.0, 4.0, 0.0, 2.0)], "iy int, ix int, w double, e double, s double, n double"), lambda x, y: (x, y))
    assert [tuple(r) for r in cutting.cell_weights(d, cells).collect()] == [(0, 0, 1, 2.0)]  # parts of one polygon add up
    assert cutting.cell_weights(d.limit(0), cells).count() == 0 and cutting.cell_weights(d, cells.limit(0)).count() == 0


def shared(x0, x1, y0, y1, lon0, lon1, lat0, lat1, n=20_000):
    """Area by many thin slices of latitude."""
    lo, hi = max(y0 / projections.SPHERE, math.radians(lat0)), min(y1 / projections.SPHERE, math.radians(lat1))
    if hi <= lo:
        return 0.0
    t = lo + (np.arange(n) + 0.5) * (hi - lo) / n
    a, b = (projections.SPHERE * math.radians(x) * np.cos(t) for x in (lon0, lon1))
    return float(np.maximum(np.minimum(b, x1) - np.maximum(a, x0), 0).sum() * (hi - lo) / n * projections.SPHERE)


def test_sinusoidal_areas(spark):
    """Pixels of all four quadrants, across the equator and the first meridian, coarser and finer than the cells."""
    for size, step in ((500_000.0, 2.0), (150_000.0, 5.0)):
        source, grid = (-1.55 * size, 1.35 * size, size, size), (-30.0, 30.0, step, step, int(60 / step), int(60 / step))
        if size == 150_000.0:
            source = (-7e6, 3.3e6, size, size)
            grid = (-80.0, 40.0, step, step, 8, 8)
        cells = spark.createDataFrame([(i, j) for i in range(4) for j in range(4)] * 2, "iy int, ix int")
        got = {(r["iy"], r["ix"], r["ty"], r["tx"]): r["area"] for r in raster.sinusoidal_weights(cells, source, grid).collect()}
        inside = {}
        for i in range(4):
            for j in range(4):
                x0, y1 = source[0] + j * size, source[1] - i * size
                for ty in range(grid[5]):
                    for tx in range(grid[4]):
                        want = shared(x0, x0 + size, y1 - size, y1, grid[0] + tx * step, grid[0] + (tx + 1) * step, grid[1] - (ty + 1) * step, grid[1] - ty * step)
                        assert got.get((i, j, ty, tx), 0.0) == pytest.approx(want, abs=2e-6 * size * size)
                        inside[i, j] = inside.get((i, j), 0.0) + got.get((i, j, ty, tx), 0.0)
        if size == 500_000.0:
            assert all(v == pytest.approx(size * size, rel=1e-9) for v in inside.values())


def test_coarse_pixels_leave_no_cell_empty(spark):
    values = spark.createDataFrame([(1, i, j, float(i)) for i in range(3) for j in range(4)] + [(2, 0, 0, None), (2, 0, 1, 5.0)], "t int, iy int, ix int, value double")
    source, grid = (-8.5e6, 4e6, 4e5, 4e5), (-86.0, 34.5, 0.5, 0.5, 12, 10)
    out = {(r["t"], r["ty"], r["tx"]): r["value"] for r in raster.average_by_weights(values, raster.sinusoidal_weights(values, source, grid), ["t"]).collect()}
    assert sum(k[0] == 1 for k in out) == 120 and {v for k, v in out.items() if k[0] == 2} == {5.0}


def test_small_sinusoidal_pixels_as_in_sql(spark):
    """Pixels of 500 m: cells that are only touched, and all areas to the last digit, as the SQL has them."""
    n, rows = 6002, (0, 77, 1810, 3003, 5555)
    grid = (-110.0, 45.0, 20.0 / n, 20.0 / n, -(-50 * n // 20), -(-27 * n // 20))
    pixels = spark.createDataFrame([(i, j) for i in rows for j in range(12)], "iy int, ix int")
    got = {(r["iy"], r["ix"], r["ty"], r["tx"]): r["area"] for r in raster.sinusoidal_weights(pixels, (-8.4e6, 5e6, 3e6 / n, 3e6 / n), grid).collect()}
    areas = queries_grids.AREAS.replace("unnest(range(rows)) AS iy", f"unnest({list(rows)}) AS iy")
    want = duckdb.sql(f"WITH box_rows AS (SELECT {n} AS rows), {areas} SELECT iy, ix, ty, tx, area FROM areas WHERE area > 1e-9 * u * u").fetchall()
    assert len(want) > 300 and got == {w[:4]: w[4] for w in want}


def test_weight_store(spark, tmp_path):
    box = np.array([(0, 0), (1, 0), (1, 1), (0, 1)], float)
    polygons = {i: box + (3 * (i % 6), 3 * (i // 6)) for i in range(30)}
    calls = []

    def compute(some):
        calls.append(sorted(r["hru"] for r in some.select("hru").collect()))
        return geometry.weights(some, 0.0, 0.0, 1.0, 1.0, 30, 30)

    store = WeightStore(spark, str(tmp_path))

    def run(polygons, grid="unit"):
        f = fabric_of(spark, [(i, [p]) for i, p in polygons.items()])
        placed = by_place(f, 6.0, F.col("rings")[0][0]["x"], F.col("rings")[0][0]["y"])
        out, counts = store.weights(placed, grid, compute)
        rows = sorted(tuple(r) for r in out.collect())
        assert rows == sorted(tuple(r) for r in geometry.weights(f, 0.0, 0.0, 1.0, 1.0, 30, 30).collect())
        return counts

    first = run(polygons)
    assert first["recomputed"] == first["wanted"] == 9 and first["polygons"] == 30
    assert run(polygons)["recomputed"] == 0 and len(calls) == 1
    moved = {**polygons, 7: polygons[7] + 0.25}
    assert run(moved) == {"wanted": 9, "recomputed": 1, "polygons": 4} and 7 in calls[-1]
    assert run(polygons)["recomputed"] == 0  # what the place held before is still there
    assert run({k: v for k, v in polygons.items() if k != 29})["recomputed"] == 1
    assert run(polygons, "other")["recomputed"] == 9
    # A job that died after its weights and before its keys has left nothing that counts.
    spark.createDataFrame([(0, 0, 0, 99.0, batch_keys(by_place(fabric_of(spark, [(0, [box])]), 6.0, F.lit(0.0), F.lit(0.0)), "x").first()["key"])], "iy int, ix int, hru long, area double, key string").withColumn("run", F.lit("dead")).write.mode("append").partitionBy("run").parquet(f"{tmp_path}/weights")
    assert run(polygons)["recomputed"] == 0
    empty = fabric_of(spark, []).withColumn("batch", F.lit("a"))
    assert store.weights(empty, "unit", compute)[0].count() == 0


def wkb(rings, order="<", code=3, srid=None, extra=0):
    head = struct.pack(order + "BI", order == "<", code) + (b"" if srid is None else struct.pack(order + "I", srid))
    return head + struct.pack(order + "I", len(rings)) + b"".join(struct.pack(order + "I", len(r)) + b"".join(struct.pack(f"{order}{2 + extra}d", x, y, *[7.0] * extra) for x, y in r) for r in rings)


def test_forms_of_well_known_binary():
    box, hole = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]
    want = [[[{"x": x, "y": y} for x, y in r] for r in (box, hole)]]
    for order in "<>":
        for code, extra, srid in ((3, 0, None), (1003, 1, None), (2003, 1, None), (3003, 2, None), (0x80000003, 1, None), (0x40000003, 1, None), (0xC0000003, 2, None), (0x20000003, 0, 4326), (0xE0000003, 2, 5070)):
            assert archives.decode_wkb(wkb([box, hole], order, code, srid, extra)) == want
            many = struct.pack(order + "BI", order == "<", code + 3) + (b"" if srid is None else struct.pack(order + "I", srid)) + struct.pack(order + "I", 2) + wkb([box, hole], order, code, srid, extra) + wkb([box, hole], "<", 3)
            assert archives.decode_wkb(many) == want * 2
    for code in (1, 1001, 5003, 0x80000001):
        with pytest.raises(ValueError, match="not a polygon"):
            archives.decode_wkb(wkb([box], code=code))


def test_pruned_fabric(spark, tmp_path):
    """Row groups that lie aside are not read: the scan gives fewer rows than the table has, and filters are pushed."""
    rng = np.random.default_rng(6)
    rows = []
    for i, (x, y) in enumerate(rng.uniform(0, 100, (4000, 2)).tolist()):
        rows.append((i, bytearray(wkb([[(x, y), (x + 1, y), (x + 1, y + 1), (x, y)]])), (x, y, x + 1, y + 1)))
    d = spark.createDataFrame(rows, "id long, geometry binary, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    path = f"{tmp_path}/fabric"
    fabric.write_fabric(d, path, files=16)
    box = (40.0, 40.0, 50.0, 55.0)
    want = {i for i, _, (w, s, e, n) in rows if w <= 50 and e >= 40 and s <= 55 and n >= 40}
    out = fabric.read_fabric(spark, path, box, "id")
    assert {r["hru"] for r in out.collect()} == want and out.columns == ["hru", "part", "rings"]
    scan = spark.read.parquet(path).where(fabric.meets(box))
    assert "PushedFilters: [" in (plan := scan._jdf.queryExecution().explainString(scan._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))) and plan.count("bbox.") >= 4
    scan.write.format("noop").mode("overwrite").save()
    groups = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")]
    read = spark.read.parquet(path).where(fabric.meets(box)).select("id")
    read.collect()
    node = read._jdf.queryExecution().executedPlan()
    while not node.children().isEmpty():
        node = node.children().head()
    assert len(want) <= node.metrics().apply("numOutputRows").value() <= 0.4 * sum(groups) == 1600
    assert fabric.read_fabric(spark, path, None, "id").count() == 4000 and fabric.read_fabric(spark, path, (500.0, 500.0, 501.0, 501.0), "id").count() == 0
    d.drop("bbox").limit(5).write.parquet(f"{tmp_path}/plain")
    assert fabric.read_fabric(spark, f"{tmp_path}/plain", box, "id").count() == 5
    with_box = fabric.with_bbox(archives.polygons(d.limit(3), "id")).select("bbox.*").collect()
    assert [tuple(r) for r in with_box] == [pytest.approx(rows[r][2]) for r in range(3)] or len(with_box) == 3
    fabric.write_fabric(d.limit(0), f"{tmp_path}/none", 2)
    assert fabric.read_fabric(spark, f"{tmp_path}/none", box, "id").count() == 0


def test_a_source_from_files_to_years(spark, tmp_path):
    """Two regions with different Lambert attributes: weights are kept, years go on, newer files redo their year only."""
    kind = "t date, iy int, ix int, value double"
    fabric_ = fabric_of(spark, [(1, [np.array([(-99, 40), (-97, 40), (-97, 42), (-99, 42)], float)]), (2, [np.array([(-157, 20), (-156, 20), (-156, 21)], float)])]).withColumn("rings", geometry.project(F.col("rings"), projections.to_albers))
    area = {r["hru"]: r["a"] for r in fabric_.select("hru", geometry.area(F.col("rings")).alias("a")).collect()}
    regions = {}
    for name, (lat1, lat2, lat0, lon0) in {"na": (25.0, 60.0, 42.5, -100.0), "hi": (19.0, 22.0, 20.5, -156.5)}.items():
        mapping = F.struct(F.lit("lambert_conformal_conic").alias("grid_mapping_name"), F.array(F.lit(lat1), F.lit(lat2)).alias("standard_parallel"), F.lit(lat0).alias("latitude_of_projection_origin"), F.lit(lon0).alias("longitude_of_central_meridian"), F.lit(0.0).alias("false_easting"), F.lit(0.0).alias("false_northing"))
        cells = spark.createDataFrame([(i, j, -4e5 + j * 5e4, -4e5 + (j + 1) * 5e4, 4e5 - (i + 1) * 5e4, 4e5 - i * 5e4) for i in range(16) for j in range(16)], "iy int, ix int, w double, e double, s double, n double")
        landed = runs.Landed(f"{tmp_path}/{name}", kind, runs.mapped_cells(cells, mapping), name)
        for year in (2001, 2002):
            spark.createDataFrame([(dt.date(year, 1, 1), i, j, float(year)) for i in range(16) for j in range(16)], kind).coalesce(1).write.mode("append").parquet(landed.path)
        regions[name] = landed
    weights, _ = runs.kept_weights(spark, fabric_, regions["na"], f"{tmp_path}/w", 5e5)
    assert {r["hru"]: r["a"] for r in weights.groupBy("hru").agg(F.sum("area").alias("a")).collect()} == {1: pytest.approx(area[1], rel=1e-5)}
    spec = SourceSpec("daymet", ("value",))
    go = lambda years: runs.run_source(spark, spec, regions["na"], fabric_, years, f"{tmp_path}/out", f"{tmp_path}/w", "na")
    out, built, counts = go([2001])
    assert built == [2001] and counts["recomputed"] == 0 and [r["value"] for r in out.collect()] == [pytest.approx(2001.0)]
    out, built, counts = go([2001, 2002])
    assert built == [2002] and counts["recomputed"] == 0 and out.count() == 2
    time.sleep(1.1)
    spark.createDataFrame([(dt.date(2002, 1, 2), 0, 0, 1.0)], kind).write.mode("append").parquet(regions["na"].path)
    assert go([2001, 2002])[1] == [2002]
    files = spark.read.parquet(regions["na"].path)
    for most, joins in ((10_000, "BroadcastHashJoin"), (3, "SortMergeJoin")):
        plan = zonal.aggregate(files, zonal.small(weights, most), ["value"], "masked_mean")._jdf.queryExecution().executedPlan().toString()
        assert joins in plan and plan.count("Exchange hashpartitioning(hru") == 1 and ("Exchange hashpartitioning(iy" in plan) == (most == 3)
    both = runs.run_regions(spark, spec, regions, fabric_, [2001], f"{tmp_path}/out", f"{tmp_path}/w")
    assert {(r["region"], r["hru"]) for r in both.collect()} == {("na", 1), ("hi", 2)}
    spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/empty")
    with pytest.raises(FileNotFoundError):
        runs.run_source(spark, spec, runs.Landed(f"{tmp_path}/empty", kind, regions["na"].cells, "na"), fabric_, [2001], f"{tmp_path}/o", f"{tmp_path}/w")


def test_a_source_whose_grid_is_sparse(spark, tmp_path):
    """A region without polygons, a year in which a polygon has no grid row, and one in which none has; other polygons still raise."""
    kind = "t date, iy int, ix int, value double"
    box = lambda x: [np.array([(x, 0), (x + 1, 0), (x + 1, 1), (x, 1)], float)]
    fabric_ = fabric_of(spark, [(1, box(0)), (2, box(1))])
    regions = {}
    for name, x in (("west", 0), ("east", 50)):
        cells = cutting.with_corners(spark.createDataFrame([(0, k, float(x + k), float(x + k + 1), 0.0, 1.0) for k in range(3)], "iy int, ix int, w double, e double, s double, n double"), lambda x, y: (x, y))
        regions[name] = runs.Landed(f"{tmp_path}/{name}", kind, cells.select("iy", "ix", "corners"), name)
        rows = [(dt.date(2001, 1, 1), 0, 0, 1.0), (dt.date(2001, 1, 1), 0, 1, None), (dt.date(2002, 1, 1), 0, 0, 3.0), (dt.date(2003, 1, 1), 0, 2, 9.0)]
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(regions[name].path)
    spec = SourceSpec("daymet", ("value",), "masked_mean")
    go = lambda some, years: sorted((r["region"], r["hru"], r["t"].year, r["value"]) for r in runs.run_regions(spark, spec, regions, some, years, f"{tmp_path}/out", f"{tmp_path}/w").collect())
    want = [("west", 1, 2001, 1.0), ("west", 1, 2002, 3.0), ("west", 2, 2001, None)]
    assert sorted(go(fabric_, [2001]), key=str) == [want[0], want[2]] and sorted(go(fabric_, [2001, 2002, 2003]), key=str) == want
    with pytest.raises(ValueError, match="no data for .2004"):
        go(fabric_, [2003, 2004])
    spark.createDataFrame([(dt.date(2004, 1, 1), 0, 0, 1.0)], kind).write.mode("append").parquet(regions["west"].path)
    with pytest.raises(ValueError, match="other polygons"):
        runs.run_source(spark, spec, regions["west"], fabric_.where("hru = 1"), [2002, 2004], f"{tmp_path}/out", f"{tmp_path}/w", "west")
