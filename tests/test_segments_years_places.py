"""Carried increments, marked years, coverings, Lambert both ways, archive headers."""

import glob
import gzip
import io
import math
import os
import random
import tarfile

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from catchment.functions import projections
from catchment.operators import covering, geometry, temporal
from catchment.plans import yearly
from catchment.sources import archives


def whole_history(df, by, per_year=False):
    """Increments from one window over each series."""
    w = Window.partitionBy(*by, *([F.year("ts")] if per_year else [])).orderBy("ts")
    rows = df.withColumn("n", F.row_number().over(w)).withColumn("d", F.col("value") - F.lag("value").over(w))
    return rows.where("n > 1").withColumn("value", F.when(F.col("d") >= 0, F.col("d")).otherwise(F.col("value"))).drop("n", "d")


def samples(spark):
    """Series with gaps of months, missing values at edges, resets across months and years, and a missing key."""
    rng = random.Random(3)
    rows = []
    for k in (0, 1, None, 3):
        for h in sorted(rng.sample(range(24 * 900), 700)):
            rows.append((k, h, None if rng.random() < 0.1 else float(rng.randrange(40)), "x"))
    rows.append((9, 5, 1.0, "x"))
    d = spark.createDataFrame(rows, "cell long, h long, value double, __d string")
    return d.where("cell <> 1 or h < 5000 or h > 9000 or cell is null").withColumn("ts", F.expr("timestamp_ntz'2001-01-01 00:30:00' + make_dt_interval(0, cast(h as int))")).drop("h")


def test_increments_in_segments(spark):
    d = samples(spark)
    key = lambda df: sorted(map(str, df.select("cell", "ts", "value").collect()))
    for per_year in (False, True):
        assert key(temporal.increments(d.drop("__d"), ["cell"], per_year=per_year)) == key(whole_history(d, ["cell"], per_year))
    # A later year needs the last samples of the earlier ones, and nothing else.
    old, new = d.where("year(ts) = 2001").drop("__d"), d.where("year(ts) > 2001").drop("__d")
    edges = temporal.last_samples(old, ["cell"])
    assert edges.count() == d.where("year(ts) = 2001").select("cell").distinct().count()
    both = temporal.increments(old, ["cell"]).unionByName(temporal.increments(new, ["cell"], before=edges))
    assert key(both) == key(whole_history(d, ["cell"]))
    plan = temporal.increments(d.drop("__d"), ["cell"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "row_number()" in x and "Window" in x]
    assert windows and all("__m" in x.split("windowspecdefinition(")[1].split("ts#")[0] for x in windows)
    assert temporal.increments(d.drop("__d").limit(0), ["cell"]).count() == 0


def test_years_count_by_their_marks(spark, tmp_path):
    path, built = str(tmp_path / "out"), []

    def build(y):
        built.append(y)
        return spark.range(0 if y == 2009 else 1000).withColumnRenamed("id", "hru").repartition(4)

    def run(years):
        built.clear()
        yearly.run_years(spark, years, build, path)
        return list(built)

    assert run([2001, 2002]) == [2001, 2002] and run([2001, 2002, 2003]) == [2003] and run([2001, 2002, 2003]) == []
    # A job that died while its files were moved: some of them are there, the mark is not.
    yearly._mark(spark, path, 2002, 0, 0, 0)
    assert run([2001, 2002, 2003]) == [2002]
    # Files that went after the mark.
    for f in sorted(glob.glob(f"{path}/year=2001/*.parquet"))[:2]:
        os.remove(f)
    assert run([2001, 2002, 2003]) == [2001]
    assert yearly.stitch(spark, path, [2001, 2002, 2003]).count() == 3000
    assert run([2009]) == [2009] and run([2009]) == [2009]  # no rows, so nothing was done

    def dies(y):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        yearly.run_years(spark, [2001, 2010], dies, path)
    assert {r["year"] for r in yearly.years_done(spark, path).collect()} == {2001, 2002, 2003}


def test_coverings(spark):
    rng = np.random.default_rng(4)
    shapes = []
    for i in range(60):
        n = int(rng.integers(3, 30))
        a, r = np.sort(rng.uniform(0, 2 * math.pi, n)), rng.uniform(0.3, 1, n)
        size = 10.0 ** rng.uniform(-1, 2)
        shapes.append([np.stack([r * np.cos(a), r * np.sin(a)], axis=1) * size + rng.uniform(-60, 60, 2)])
    shapes[5].append(shapes[5][0].mean(axis=0) + 0.1 * (shapes[5][0] - shapes[5][0].mean(axis=0)))
    value = lambda rings: [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]
    kind = "hru long, rings array<array<struct<x:double,y:double>>>"
    fabric = spark.createDataFrame([(i, value(s)) for i, s in enumerate(shapes)] + [(70, None), (71, []), (72, value([[(1.0, 1.0), (1.0, 1.0)]]))], kind)
    p = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-90, 90, (3000, 2)))] + [(-1, None, 1.0), (-2, 1.0, 1.0), (-2, 1.0, 1.0)]
    points = spark.createDataFrame(p, "id long, x double, y double")
    cells = covering.covering(fabric, 4)
    got = sorted((r["id"], r["hru"] if r["hru"] is not None else -9) for r in covering.locate(points, cells).collect())
    plain = sorted((r["id"], r["hru"] if r["hru"] is not None else -9) for r in geometry.locate(points, fabric.where("hru < 71"), 4.0).collect())
    assert got == plain and sum(h >= 0 for _, h in got) > 500
    # Cells grow with the shape, not with the size.
    count = {r["hru"]: r["count"] for r in cells.groupBy("hru").count().collect()}
    assert max(count.values()) < 40 * 2**4 and cells.where("rings is null").count() > 1000
    area = {r["hru"]: r["a"] for r in cells.groupBy("hru").agg(F.sum(F.when(F.col("rings").isNull(), F.pow(F.lit(4.0), -F.col("level")))).alias("a")).collect()}
    for i, s in enumerate(shapes):
        x, y = s[0].T
        whole = abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2
        assert area[i] is None or area[i] <= whole
    assert covering.locate(points, covering.covering(fabric.limit(0))).where("hru is not null").count() == 0 and covering.locate(points.limit(0), cells).count() == 0


def test_foremost_cells(spark):
    """Polygons upon one another: each place has one inner cell, crowded edges lose what lies behind, and no cells go to the driver whole."""
    rng = np.random.default_rng(6)
    value = lambda r: [[{"x": float(x), "y": float(y)} for x, y in r]]
    square = np.array([(0, 0), (1, 0), (1, 1), (0, 1)], float)
    rows = [(i, value(square * side + rng.uniform(0, 60, 2))) for i, side in enumerate(rng.choice([0.7, 7.0, 70.0], 300))]
    fabric = spark.createDataFrame(rows, "hru long, rings array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-5, 130, (3000, 2)))], "id long, x double, y double")
    cells = covering.covering(fabric)
    out = covering.locate(points, cells)
    assert {(r["id"], r["hru"]) for r in out.collect()} == {(r["id"], r["hru"]) for r in geometry.locate(points, fabric, 8.0).collect()}
    left = covering.foremost(cells, [r["level"] for r in cells.select("level").distinct().collect()])
    inner = left.where("rings is null")
    assert inner.count() == inner.select(*covering.KEY).distinct().count() == cells.where("rings is null").select(*covering.KEY).distinct().count()
    most = lambda c: c.where("rings is not null").groupBy(*covering.KEY).count().agg(F.max("count")).first()[0]
    assert most(cells) > 2 * most(left)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin [level") >= 1 and "BroadcastHashJoin [level" not in plan


def test_inner_cells_skip_the_ray(spark):
    """A point in an inner cell is found without rings."""
    square = np.array([(0, 0), (1000, 0), (1000, 1000), (0, 1000)], float)
    for depth in (2, 5):
        found = list(covering.cover([square], depth))
        inner = sum(len(cx) * 4.0**-level for level, cx, _, one in found if one)
        assert inner >= 1e6 * (1 - 4 * 2.0 ** -(depth - 1)) and sum(len(cx) for _, cx, _, _ in found) <= 12 * 2**depth


def test_lambert_both_ways(spark):
    """Two regions with different attributes in one plan, both hemispheres and one standard parallel."""
    rows = [("na", 25.0, 60.0, 42.5, -100.0, 0.0, 0.0, -100.0 + i * 7, 20.0 + i * 5) for i in range(9)] + [("hi", 21.0, 21.0, 20.5, -157.0, 5e5, 1e5, -157.0 + i * 0.3, 19.0 + i * 0.4) for i in range(9)] + [("sa", -5.0, -42.0, -32.0, -60.0, 0.0, 0.0, -60.0 + i * 3, -50.0 + i * 5) for i in range(9)]
    d = spark.createDataFrame(rows, "region string, lat1 double, lat2 double, lat0 double, lon0 double, x0 double, y0 double, lon double, lat double")
    names = ("lat1", "lat2", "lat0", "lon0", "x0", "y0")
    x, y = projections.to_lambert_by(F.col("lon"), F.col("lat"), *map(F.col, names))
    lon, lat = projections.from_lambert(F.col("x"), F.col("y"), *map(F.col, names))
    mapping = F.struct(F.lit("lambert_conformal_conic").alias("grid_mapping_name"), F.when(F.col("lat1") == F.col("lat2"), F.array("lat1")).otherwise(F.array("lat1", "lat2")).alias("standard_parallel"), F.col("lat0").alias("latitude_of_projection_origin"), F.col("lon0").alias("longitude_of_central_meridian"), F.col("x0").alias("false_easting"), F.when(F.col("y0") != 0, F.col("y0")).alias("false_northing"))
    by = projections.geographic(F.col("x"), F.col("y"), mapping)
    out = d.withColumns({"x": x, "y": y}).withColumns({"lon1": lon, "lat1b": lat, "lon2": by[0], "lat2b": by[1]})
    plain = {r: projections.to_lambert(F.col("lon"), F.col("lat"), *(rows[k][1:7])) for r, k in (("na", 0), ("hi", 9), ("sa", 18))}
    for c, k in (("px", 0), ("py", 1)):
        out = out.withColumn(c, F.coalesce(*[F.when(F.col("region") == r, v[k]) for r, v in plain.items()]))
    for r in out.collect():
        assert abs(r["lon1"] - r["lon"]) < 1e-8 and abs(r["lat1b"] - r["lat"]) < 1e-8 and (r["lon2"], r["lat2b"]) == pytest.approx((r["lon1"], r["lat1b"]), abs=1e-12)
        assert (r["x"], r["y"]) == pytest.approx((r["px"], r["py"]), abs=1e-6)
    stepped = d.withColumns({"x": x, "y": y}).withColumn("q", projections.step_by_step(F.array(F.struct("x", "y")), *projections.geographic_steps(mapping), *projections.albers_steps())).withColumns(dict(zip(("ax", "ay"), projections.to_albers(F.col("lon"), F.col("lat")), strict=True)))
    for r in stepped.where("region = 'na'").collect():
        assert (r["q"][0]["x"], r["q"][0]["y"]) == pytest.approx((r["ax"], r["ay"]), abs=1e-3)
    # Snyder's worked example on the Clarke ellipsoid has other axes; this is EPSG's two-parallel form at its own origin.
    home = out.where("region = 'hi'").select(*projections.to_lambert_by(F.lit(-157.0), F.lit(20.5), 21.0, 21.0, 20.5, -157.0, 5e5, 1e5)).first()
    assert tuple(home) == pytest.approx((5e5, 1e5), abs=1e-6)
    with pytest.raises(Exception, match="unknown grid mapping"):
        d.limit(1).select(*projections.geographic(F.lit(0.0), F.lit(0.0), F.struct(F.lit("polar").alias("grid_mapping_name"), F.array(F.lit(1.0)).alias("standard_parallel"), *[F.lit(0.0).alias(c) for c in ("latitude_of_projection_origin", "longitude_of_central_meridian", "false_easting", "false_northing")]))).collect()


def test_headers_do_not_inflate_grids(monkeypatch):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for end, body in (("txt", b"Number of rows: 2\nNumber of columns: 3\n"), ("dat", np.arange(6, dtype=">i2").tobytes())):
            info = tarfile.TarInfo(f"us_ssmv11034_x.{end}.gz")
            packed = gzip.compress(body)
            info.size = len(packed)
            tar.addfile(info, io.BytesIO(packed))
    read, plain = [], gzip.decompress
    monkeypatch.setattr(archives.gzip, "decompress", lambda b: read.append(len(plain(b))) or plain(b))
    assert archives.Archive(out.getvalue()).header() == {"Number of rows": "2", "Number of columns": "3"} and read == [39]
    assert archives.decode_archive(out.getvalue())[1].tolist() == [[0, 1, 2], [3, 4, 5]] and read == [39, 39, 12]


def test_archives_as_a_source(spark, tmp_path):
    """Archives of other days are not opened, header scans leave the grids on disk, and pixels are those of the binary files."""
    import datetime as dt

    from catchment.plans import pipelines
    from catchment.sources import snow_source

    rng = np.random.default_rng(1)
    want = set()
    for d in range(1, 6):
        grid = rng.integers(-9999, 30_000, (200, 300)).astype(">i2")
        grid[rng.random((200, 300)) < 0.95] = -9999
        head = "Number of rows: 200\nNumber of columns: 300\nMinimum x-axis coordinate: 0\nMaximum y-axis coordinate: 200\nX-axis resolution: 1\nY-axis resolution: 1\n"
        with tarfile.open(tmp_path / f"SNODAS_2001010{d}.tar", "w") as tar:
            for name, body in ((f"us_ssmv01025_{d}.dat.gz", bytes(rng.bytes(200_000))), (f"us_ssmv11034_{d}.dat.gz", gzip.compress(grid.tobytes())), (f"us_ssmv11034_{d}.txt.gz", gzip.compress(head.encode()))):
                info = tarfile.TarInfo(name)
                info.size = len(body)
                tar.addfile(info, io.BytesIO(body))
        want |= {(dt.date(2001, 1, d), int(i), int(j), float(grid[i, j])) for i, j in zip(*np.nonzero(grid != -9999), strict=True)}
    (tmp_path / "SNODAS_20010103.txt").write_bytes(b"no archive")
    (tmp_path / "SNODAS_20010109.tar").write_bytes(b"not to be opened")
    snow_source.register(spark)
    read = lambda **o: spark.read.format("snow_archives").options(**o).load(str(tmp_path))
    some = read().where("t >= date'2001-01-02' and t < date'2001-01-05'")
    assert {tuple(r) for r in some.collect()} == {w for w in want if 2 <= w[0].day <= 4}
    assert some.rdd.getNumPartitions() == 1 and read(days="1").where("t >= date'2001-01-02' and t < date'2001-01-05'").rdd.getNumPartitions() == 3
    assert read(mode="headers").where("t in (date'2001-01-01', date'2001-01-05')").select("t", "rows", "max_y").collect() == [(dt.date(2001, 1, 1), 200, 200.0), (dt.date(2001, 1, 5), 200, 200.0)]
    assert read().where("t = date'1999-01-01'").count() == 0

    class Counted:
        def __init__(self, f):
            self.f, self.bytes = f, 0

        def read(self, n=-1):
            out = self.f.read(n)
            self.bytes += len(out)
            return out

        def __getattr__(self, name):
            return getattr(self.f, name)

    size = (tmp_path / "SNODAS_20010101.tar").stat().st_size
    with open(tmp_path / "SNODAS_20010101.tar", "rb", buffering=0) as f:
        counted = Counted(f)
        assert archives.Archive(file=counted).header()["Number of rows"] == "200" and counted.bytes < 6000 < size / 30

    targets = spark.createDataFrame([(k, j + 0.5, 200 - i - 0.5) for k, (i, j) in enumerate([(0, 0), (10, 20), (199, 299)])], "hru long, x double, y double")
    got = {(r["hru"], r["t"], r["value"]) for r in pipelines.snow_source(spark, str(tmp_path), targets, dt.date(2001, 1, 1), dt.date(2001, 1, 5)).select("hru", "t", "value").collect()}
    at = {(0, 0): 0, (10, 20): 1, (199, 299): 2}
    assert got == {(at[w[1], w[2]], w[0], w[3]) for w in want if (w[1], w[2]) in at}
