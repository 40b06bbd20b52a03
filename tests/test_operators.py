"""Single operators with closed-form expectations."""

import datetime as dt
import gzip
import io
import random
import struct
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from catchment.functions import masks, projections, timeaxis, units
from catchment.operators import bounds, diagnostics, geometry, nnfill, normalize, partitioning, quality, raster, temporal, zonal
from catchment.plans import pipelines
from catchment.plans.targets import runoff, swe
from catchment.sources import archives, filenames, specs, tables
from catchment.streaming import incremental

D = dt.date


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def box(i, x0, y0, x1, y1):
    return (i, [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]])


RINGS = "hru long, rings array<array<struct<x: double, y: double>>>"


def test_periods(spark):
    assert timeaxis.parse_period("2000/2001") == (D(2000, 1, 1), D(2001, 12, 31))
    for bad in ("2000", "2001/2000", "a/b", "2000-1-1/2001"):
        with pytest.raises(ValueError):
            timeaxis.parse_period(bad)
    assert [r["t"] for r in timeaxis.spine(spark, D(2000, 1, 15), D(2000, 3, 31)).collect()] == [D(2000, 2, 1), D(2000, 3, 1)]
    assert timeaxis.spine(spark, D(2000, 1, 2), D(2000, 1, 20)).count() == 0
    assert timeaxis.months_in_period(spark, D(2000, 1, 15), D(2000, 3, 2)).count() == 3


@pytest.mark.parametrize(
    ("column", "want"),
    [
        (lambda: units.metres_to_mm(F.lit(0.05)), 50),
        (lambda: units.three_hourly_mean_to_mm(F.lit(0.2), F.lit(D(2000, 1, 1))), 49.6),
        (lambda: units.three_hourly_mean_to_mm(F.lit(0.2), F.lit(D(2000, 2, 1))), 46.4),
        (lambda: units.three_hourly_mean_to_mm(F.lit(0.1), F.lit(D(2001, 2, 1))), 22.4),
        (lambda: units.mm_to_cfs(F.lit(31.0), F.lit(D(2000, 1, 1)), F.lit(1e6)), (31e-3 / 31) * 1e6 * 35.3146667 / 86400),
        (lambda: units.rate_to_mm_per_month(F.lit(1e-6), F.lit(D(2001, 2, 1))), 1e-6 * 28 * 86400),
        (lambda: units.mm_to_inches(F.lit(50.0)), 50 / 25.4),
        (lambda: units.wrap_longitude(F.lit(300.0)), -60),
        (lambda: units.bit_field(F.lit(0b10110110), 4, 4), 11),
    ],
)
def test_units(spark, column, want):
    assert one(spark, column().alias("v"))["v"] == pytest.approx(want)


def test_statistic_needs_its_size(spark):
    assert one(spark, units.statistic(F.array(*map(F.lit, (1.0, 2.0, 3.0, 4.0, 5.0))), 1).alias("v"))["v"] == 1
    with pytest.raises(Exception, match="expected 5"):
        one(spark, units.statistic(F.array(F.lit(1.0)), 1))


def test_header_map(spark):
    r = one(spark, timeaxis.header_map(F.lit("a: 1\nnone\na: 2\nurl: http://x:8")).alias("m"))
    assert r["m"] == {"a": "2", "url": "http://x:8"}


def test_names(spark):
    w = filenames.water_years(F.lit("WY1999_00"))
    r = one(spark, filenames.acquisition_date(F.lit("MOD.A2005017.h1")).alias("a"), filenames.archive_date(F.lit("SNODAS_20050117.tar")).alias("b"), w[0].alias("c"), w[1].alias("d"), filenames.trailing_year(F.lit("none")).alias("e"))
    assert tuple(r) == (D(2005, 1, 17), D(2005, 1, 17), 1999, 2000, None)


def test_quality_gate(spark):
    rows = [(0, 50.0, 80.0), (1, 50.0, 60.0), (2, 50.0, 30.0), (3, 50.0, 100.0), (4, 50.0, 70.0), (5, 250.0, 90.0), (6, 50.0, 255.0), (7, 50.0, None)]
    got = masks.quality_gate(spark.createDataFrame(rows, "i int, snow double, ci double"), "snow", "ci").orderBy("i").collect()
    assert [r["snow"] for r in got] == [50, None, None, 50, None, None, None, None]
    assert [r["valid_mask"] for r in got] == [1, 0, 0, 1, 0, 1, 0, 0]
    assert got[6]["ci"] is None and got[1]["ci"] == 60


def test_scope_and_box(spark):
    s = spark.createDataFrame([("a", None), ("b", ["or"]), ("c", ["x"])], "source string, fabrics array<string>")
    assert {r[0] for r in masks.in_scope(s, "or").collect()} == {"a", "b"} and {r[0] for r in masks.in_scope(s, None).collect()} == {"a"}
    with pytest.raises(ValueError, match="nothing in common"):
        masks.clip(spark.createDataFrame([(1.0, 1.0)], "lat double, lon double"), 9, 5, 8, 6)


def test_geometry(spark):
    u = (1, [[(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (2.0, 3.0), (2.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]])
    hole = (2, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0)]])
    f = spark.createDataFrame([u, hole], RINGS)
    got = {r["hru"]: r for r in geometry.area_and_centroids(f).collect()}
    assert got[1]["area_m2"] == pytest.approx(7) and got[2]["area_m2"] == pytest.approx(15) and got[2]["centroid_x"] == pytest.approx((2 * 16 - 1.5) / 15)
    assert geometry.clip_area(np.array(u[1][0]), 0.5, 2, 2.5, 2.5) == pytest.approx(0.5)
    w = geometry.weights(f, -1.0, -1.0, 0.7, 0.9, 9, 9).groupBy("hru").agg(F.sum("area")).collect()
    assert {r[0]: round(r[1], 9) for r in w} == {1: 7.0, 2: 15.0}
    p = spark.createDataFrame([(1, 1.5, 2.0), (2, 0.5, 2.0), (3, 1.5, 1.5), (4, 9.0, 9.0)], "i int, x double, y double")
    assert {r["i"]: r["hru"] for r in geometry.locate(p, f, 1.5).collect()} == {1: 2, 2: 1, 3: None, 4: None}
    with pytest.raises(ValueError):
        geometry.locate_all(p, f, 1.5)


def test_projections(spark):
    x, y = projections.to_albers(F.lit(-96.0), F.lit(23.0))
    lon, lat = projections.from_albers(*projections.to_albers(F.lit(-120.5), F.lit(44.25)))
    a, b = projections.from_sinusoidal(*projections.to_sinusoidal(F.lit(-100.0), F.lit(40.0)))
    r = one(spark, x.alias("x"), y.alias("y"), lon.alias("lon"), lat.alias("lat"), a.alias("a"), b.alias("b"))
    assert abs(r["x"]) < 1e-6 and abs(r["y"]) < 1e-6 and r["lon"] == pytest.approx(-120.5, abs=1e-9) and r["lat"] == pytest.approx(44.25, abs=1e-7)  # the inverse is a series, good to a millimetre
    assert r["a"] == pytest.approx(-100) and r["b"] == pytest.approx(40)
    x, y = projections.to_lambert(F.lit(-100.0), F.lit(42.5), 25, 60, 42.5, -100)
    assert tuple(abs(v) < 1e-6 for v in one(spark, x, y)) == (True, True)


def test_zonal_policies(spark):
    w = spark.createDataFrame([(0, 0, 1, 1.0), (0, 1, 1, 3.0)], "iy int, ix int, hru long, area double")
    rows = [(0, 0, 1, 10.0), (0, 1, 1, 20.0), (0, 0, 2, 10.0), (0, 1, 2, None), (0, 0, 3, None), (0, 1, 3, None), (0, 0, 4, 10.0)]
    g = spark.createDataFrame(rows, "iy int, ix int, t int, v double")
    get = lambda stat: {r["t"]: r["v"] for r in zonal.aggregate(g, w, ["v"], stat).collect()}
    assert get("mean") == {1: 17.5, 2: None, 3: None, 4: None}
    assert get("masked_mean") == {1: 17.5, 2: 10, 3: None, 4: 10}
    assert get("masked_median")[1] == 20 and get("masked_count")[3] == 0 and get("masked_std")[2] == 0
    with pytest.raises(ValueError):
        zonal.aggregate(g, w, ["v"], "mode")


def test_hourly(spark):
    start = dt.datetime(2020, 1, 1)
    rows = [(1, start + dt.timedelta(hours=h), 0.024 if h % 24 == 0 else 0.001 * (h % 24)) for h in range(49)]
    h = spark.createDataFrame(rows, "cell int, ts timestamp_ntz, value double")
    got = {r["t"]: r["value"] for r in temporal.hourly_to_daily(h, ["cell"]).collect()}
    assert got == {D(2020, 1, 1): pytest.approx(0.024), D(2020, 1, 2): pytest.approx(0.024)}
    daily = spark.createDataFrame([(1, D(2020, 1, 1) + dt.timedelta(days=k), 0.001) for k in range(60)], "cell int, t date, value double")
    got = {r["t"]: r["value"] for r in temporal.daily_to_monthly(daily, ["cell"], "sum").collect()}
    assert got == {D(2020, 1, 31): pytest.approx(0.031), D(2020, 2, 29): pytest.approx(0.029)}
    with pytest.raises(ValueError):
        temporal.kind_of("mean")


def composites(spark, year, value=None, extra=()):
    stamps = [D(year, 1, 1) + dt.timedelta(days=8 * k) for k in range(46)]
    rows = [(1, t, 8.0 if value is None else value(t)) for t in [*stamps, *extra]]
    return spark.createDataFrame(rows, "hru int, t date, value double")


def test_composites(spark):
    for year, feb in ((2001, 28.0), (2000, 29.0)):
        got = {r["t"].month: r["value"] for r in temporal.composites_to_monthly(composites(spark, year), ["hru"]).collect()}
        assert got[1] == pytest.approx(31) and got[2] == pytest.approx(feb)
    length = lambda t: float(min(8, (D(t.year + 1, 1, 1) - t).days))
    c = composites(spark, 2001, length, (D(2002, 1, 1), D(2002, 1, 9)))
    got = {(r["t"].year, r["t"].month): r["value"] for r in temporal.composites_to_monthly(c, ["hru"]).collect()}
    assert got[2001, 12] == pytest.approx(31) and (2002, 1) not in got
    gap = composites(spark, 2001, lambda t: None if t == D(2001, 6, 2) else 8.0)
    assert sum(r["value"] is None for r in temporal.composites_to_monthly(gap, ["hru"]).collect()) == 1
    assert all(r["value"] is None for r in temporal.composites_to_monthly(gap, ["hru"], strict_dot=True).collect())


def series(spark, rows):
    return spark.createDataFrame(rows, "hru long, t date, value double")


def test_normalize(spark):
    s = series(spark, [(h, D(2000 + k, 1, 1), v) for h, vs in ((1, (0.0, 50.0, 100.0)), (3, (5.0, 5.0, 5.0)), (4, (10.0, None, 20.0))) for k, v in enumerate(vs)])
    got = {(r["hru"], r["t"].year - 2000): r["value"] for r in normalize.normalize(s, ["hru"]).collect()}
    assert [got[1, k] for k in range(3)] == [0, 0.5, 1] and [got[3, k] for k in range(3)] == [None] * 3 and [got[4, k] for k in range(3)] == [0, None, 1]
    vals = {(2000, 1): 0, (2000, 7): 100, (2001, 1): 10, (2001, 7): 200, (2002, 1): 20, (2002, 7): 300, (2003, 1): 5, (2003, 7): 150}
    s = series(spark, [(1, D(y, m, 1), float(v)) for (y, m), v in vals.items()])
    got = {(r["t"].year, r["t"].month): r["value"] for r in normalize.normalize(s, ["hru"], window=(D(2000, 1, 1), D(2001, 12, 31)), monthly=True).collect()}
    assert got == {(2000, 1): 0, (2000, 7): 0, (2001, 1): 1, (2001, 7): 1, (2002, 1): 2, (2002, 7): 2, (2003, 1): 0.5, (2003, 7): 0.5}


def test_bounds(spark):
    a, b = series(spark, [(1, D(2000, 1, 1), 1.0), (2, D(2000, 1, 1), None)]), series(spark, [(1, D(2000, 1, 1), 3.0), (2, D(2000, 1, 1), None)])
    out = bounds.multi_source_bounds([a, b])
    assert {tuple(r) for r in out.collect()} == {(1, D(2000, 1, 1), 1.0, 3.0, 2), (2, D(2000, 1, 1), None, None, 0)} and dict(out.dtypes)["n_sources"] == "tinyint"
    twice = a.unionByName(a)
    with pytest.raises(Exception, match="occurs twice"):
        bounds.align(twice, timeaxis.spine(spark, D(2000, 1, 1), D(2000, 1, 31)), a).collect()


def fill(spark, low, points, k=10, **how):
    b = spark.createDataFrame([(i + 1, D(2000, 1, 1), v, None if v is None else v + 10, 1) for i, v in enumerate(low)], "hru long, t date, lower_bound double, upper_bound double, n_sources tinyint")
    c = spark.createDataFrame([(i + 1, float(x), 0.0) for i, x in enumerate(points)], "hru long, x double, y double")
    return [(r["lower_bound"], r["nn_filled"]) for r in nnfill.fill(b, c, k, **how).orderBy("hru").collect()]


def test_fill(spark):
    assert fill(spark, [10.0, None, 50.0], [0, 1, 5]) == [(10, 0), (10, 1), (50, 0)]
    assert fill(spark, [None, None, 50.0], [0, 1, 5]) == [(50, 1), (50, 1), (50, 0)]
    assert fill(spark, [None, None, None], [0, 1, 5], 2) == [(None, 0)] * 3
    assert fill(spark, [10.0, None, None, 99.0], [0.5, 1, 2, 10], 1) == [(10, 0), (10, 1), (None, 0), (99, 0)]
    assert fill(spark, [10.0, None, None, 99.0], [0.5, 1, 2, 10], 1, donors="chained") == [(10, 0), (10, 1), (10, 1), (99, 0)]


def test_far_donors(spark):
    assert fill(spark, [10.0, None, 50.0], [0, 500, 100_000], 1) == [(10, 0), (10, 1), (50, 0)]
    assert fill(spark, [None, None, 50.0], [0, 1, -3_000_000], 2) == [(50, 1), (50, 1), (50, 0)]
    assert fill(spark, [10.0, None, None, None, 99.0], [0, 200, 450, 900, 1e6], 1, donors="chained") == [(10, 0), (10, 1), (10, 1), (10, 1), (99, 0)]
    at = [(h, float((h * 7919) % 1009) ** 2, float((h * 104729) % 997) ** 2 if h % 7 else 4.0) for h in range(150)] + [(h, 9.0, 9.0) for h in range(150, 170)]
    p = spark.createDataFrame(at, "hru long, x double, y double")
    got = {}
    for r in nnfill.nearest(p.where("hru % 3 <> 0"), p, 4, 1.0).collect():
        got.setdefault(r["hru"], {})[r["rank"]] = r["donor"]
    for h, x, y in at:
        want = [d for _, d in sorted(((x - u) ** 2 + (y - v) ** 2, d) for d, u, v in at if d != h)[:4]]
        assert got.get(h) == (dict(enumerate(want, 1)) if h % 3 else None)


def test_chained_fill_goes_by_id(spark):
    rng = random.Random(2)
    n, k = 80, 3
    low = [float(i) if rng.random() < 0.25 else None for i in range(n)]
    at = [rng.random() * 1000 for _ in range(n)]
    want, flag = list(low), [0] * n
    for i in range(n):
        if low[i] is None:
            for j in sorted((j for j in range(n) if j != i), key=lambda j: ((at[i] - at[j]) ** 2, j))[:k]:
                if want[j] is not None:
                    want[i], flag[i] = want[j], 1
                    break
    assert fill(spark, low, at, k, donors="chained") == list(zip(want, flag, strict=True))


def test_one_sided_gap_stays(spark):
    b = spark.createDataFrame([(1, D(2000, 1, 1), 10.0, 20.0, 1), (2, D(2000, 1, 1), None, 30.0, 1)], "hru long, t date, lower_bound double, upper_bound double, n_sources tinyint")
    c = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0)], "hru long, x double, y double")
    assert [(r["lower_bound"], r["upper_bound"], r["nn_filled"]) for r in nnfill.fill(b, c).orderBy("hru").collect()] == [(10, 20, 0), (None, 30, 0)]


def test_batches(spark):
    p = spark.range(400).select(F.col("id").alias("hru"), (F.col("id") % 20).cast("double").alias("x"), F.floor(F.col("id") / 20).cast("double").alias("y"))
    sizes = [r["count"] for r in partitioning.spatial_batches(p, 50).groupBy("batch_id").count().collect()]
    assert len(sizes) > 1 and max(sizes) <= 100 and sum(sizes) == 400
    assert {r["batch_id"] for r in partitioning.spatial_batches(p.limit(25), 50).collect()} == {0}
    assert partitioning.spatial_batches(p.limit(0), 50).columns == ["hru", "x", "y", "batch_id"]
    key = lambda df, g: partitioning.fingerprint(df, g).first()["key"]
    assert key(p, "a") == key(p.orderBy(F.desc("hru")), "a") != key(p, "b") and key(p, "a") != key(p.limit(399), "a")


def archive(rows=2, columns=3, short=False, drop=False):
    grid = np.array([[1, -9999, 3], [4, 5, -9999]], ">i2")[:rows, :columns]
    text = f"Number of rows: {rows}\nNumber of columns: {columns}\nMinimum x-axis coordinate: -124.5\nMaximum y-axis coordinate: 52.5\nX-axis resolution: 0.1\nY-axis resolution: 0.1\n"
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tar:
        for name, data in (("us_ssmv11034tS__T0001TTNATS2005011705HP001.txt.gz", text.encode()), ("us_ssmv11034tS__T0001TTNATS2005011705HP001.dat.gz", grid.tobytes()[: -2 if short else None])):
            if drop and "dat" in name:
                continue
            z = gzip.compress(data)
            info = tarfile.TarInfo(name)
            info.size = len(z)
            tar.addfile(info, io.BytesIO(z))
    return buf.getvalue()


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_batches_start_from_rows(spark):
    """Each level is written, so the last one's plan does not hold the others; batches are even."""
    p = spark.range(3000).select(F.col("id").alias("hru"), (F.col("id") * 7919 % 3001).cast("double").alias("x"), (F.col("id") * 104729 % 3001).cast("double").alias("y"))
    out = partitioning.spatial_batches(p, 50)
    assert plan_of(out).count("Relation") <= 2
    sizes = [r["count"] for r in out.groupBy("batch_id").count().collect()]
    assert len(sizes) == 64 and max(sizes) - min(sizes) <= 2


def test_calendar_of_all_sources(spark):
    """The same as aligning each source, with one grouping and no product of tables."""
    months = (D(2000, 1, 1), D(2000, 6, 1), "month")
    a = spark.createDataFrame([(1, D(2000, 1, 1), 3.0), (1, D(2000, 2, 1), None), (9, D(2000, 1, 1), 1.0), (2, D(1999, 1, 1), 5.0)], "hru long, t date, value double")
    b = spark.createDataFrame([(1, D(2000, 1, 1), 1.0), (2, D(2000, 3, 1), 7.0)], "hru long, t date, value double")
    hrus = spark.createDataFrame([(1,), (2,), (2,)], "hru long")
    got = bounds.bounds_on_calendar([a, b], hrus, timeaxis.labels(*months))
    want = bounds.multi_source_bounds([bounds.align(x, timeaxis.spine(spark, *months), hrus) for x in (a, b)])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 12
    assert plan_of(got).count("Join") == 1 and "Cross" not in plan_of(got)
    with pytest.raises(Exception, match="occurs twice"):
        bounds.bounds_on_calendar([a.unionByName(a), b], hrus, timeaxis.labels(*months)).collect()


def test_areas_in_cells(spark):
    """Any ring, either way round, with a hole: areas by cell against points on a fine raster, and whole."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        angle = np.sort(rng.random(9)) * 2 * np.pi
        r = rng.uniform(0.5, 2.5, 9)
        ring = np.stack([3 + r * np.cos(angle), 3 + r * np.sin(angle)], axis=1)[:: rng.choice([-1, 1])]
        x, y = ring.T
        whole = abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2
        cells = geometry._cover([ring], np.arange(6.0), np.arange(1.0, 7), np.arange(6.0), np.arange(1.0, 7))
        assert cells.sum() == pytest.approx(whole)
        gx, gy = (v.ravel() for v in np.meshgrid(np.arange(0.005, 6, 0.01), np.arange(0.005, 6, 0.01)))
        a, b = ring, np.roll(ring, -1, axis=0)
        hit = sum(((p[1] > gy) != (q[1] > gy)) & (gx < p[0] + (gy - p[1]) * (q[0] - p[0]) / (q[1] - p[1])) for p, q in zip(a, b, strict=True)) % 2 == 1
        fine = np.zeros((6, 6))
        np.add.at(fine, (gy[hit].astype(int), gx[hit].astype(int)), 1e-4)
        assert np.abs(fine - cells).max() < 0.01
    f = spark.createDataFrame([(1, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]]), (2, None)], "hru long, rings array<array<struct<x: double, y: double>>>")
    got = {(r["iy"], r["ix"]): r["area"] for r in geometry.weights(f, 0.0, 0.0, 1.0, 1.0, 4, 4).collect()}
    assert (1, 1) not in got and len(got) == 15 and sum(got.values()) == pytest.approx(15)
    axis = spark.createDataFrame([(5, 2.0, 3.5), (7, 0.5, 1.0), (6, 1.0, 2.0), (9, 8.0, 9.0)], "idx int, lo double, hi double")
    odd = {(r["iy"], r["ix"]): r["area"] for r in geometry.irregular_weights(f, axis, axis).collect()}
    assert odd == {(5, 5): pytest.approx(2.25), (5, 6): pytest.approx(1.5), (6, 5): pytest.approx(1.5), (7, 7): pytest.approx(0.25), (7, 6): pytest.approx(0.5), (6, 7): pytest.approx(0.5), (5, 7): pytest.approx(0.75), (7, 5): pytest.approx(0.75)}


def test_grids_of_different_steps(spark):
    v = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 0, 1, 3.0), ("a", 1, 0, None), ("a", 1, 1, 5.0)], "t string, iy int, ix int, value double")
    source = (0.0, 2.0, 1.0, 1.0, 2, 2)
    get = lambda df: {(r["ty"], r["tx"]): r["value"] for r in df.collect()}
    assert get(raster.overlap_average(v, source, (0.0, 2.0, 2.0, 2.0, 1, 1), ["t"])) == {(0, 0): pytest.approx(3.0)}
    assert get(raster.overlap_average(v, source, (0.5, 2.0, 1.0, 1.0, 2, 2), ["t"])) == {(0, 0): pytest.approx(2.0), (0, 1): pytest.approx(3.0), (1, 0): pytest.approx(5.0), (1, 1): pytest.approx(5.0)}
    fine = get(raster.overlap_average(v, source, (0.0, 2.0, 0.25, 0.25, 8, 8), ["t"]))
    assert len(fine) == 48 and fine[0, 3] == 1 and fine[0, 4] == 3 and fine[7, 7] == 5
    other = spark.createDataFrame([("a", 0, k, float(k)) for k in range(4)] + [("b", 0, 1, 9.0)], "t string, iy int, ix int, value double")
    got = {(r["t"], r["iy"], r["ix"], r["value"], r["source_value"]) for r in raster.on_common_grid(v, source, other, (-1.0, 2.0, 1.0, 1.0, 4, 1), ["t"]).collect()}
    assert got == {("a", 0, 1, 1.0, 1.0), ("a", 0, 2, 2.0, 3.0), ("b", 0, 1, 9.0, None)}


def test_medians_of_several(spark):
    g = spark.createDataFrame([(0, k, D(2000, 1, 1), float(k), k * 10, None) for k in range(5)] + [(0, 0, D(2001, 1, 1), None, None, None)], "iy int, ix int, t date, a double, b int, c double")
    w = spark.createDataFrame([(0, k, 1, 4.0 if k == 3 else 1.0) for k in range(5)], "iy int, ix int, hru long, area double")
    out = zonal.aggregate(g, w, ["a", "b", "c"], "masked_median")
    assert dict(out.dtypes)["b"] == "int" and sorted(map(tuple, out.collect())) == [(1, D(2000, 1, 1), 3.0, 30, None), (1, D(2001, 1, 1), None, None, None)]


def test_percentile_sketches(spark):
    d = spark.range(1001).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("value"))
    exact, near = (diagnostics.percentiles(d, ["g"], [0.02, 0.5], accuracy=k).first() for k in (None, 100_000))
    assert tuple(exact) == tuple(near) == ("g", 20.0, 500.0)
    assert diagnostics.describe(d, "value", 1000).first()["p50"] == 500 and diagnostics.field_statistics(d, "value", 990, 1000).first()["p99"] == 990


def test_years_go_on(spark, tmp_path):
    from catchment.plans import yearly

    path, built = f"{tmp_path}/years", []

    def build(y):
        built.append(y)
        return spark.createDataFrame([(1, float(y)), (2, 0.0)] if y != 2004 else [(1, 4.0), (3, 0.0)], "hru long, value double").coalesce(1)

    assert yearly.run_years(spark, [2001, 2003], build, path) == [2001, 2003]
    assert yearly.run_years(spark, range(2001, 2004), build, path) == [2002] and built == [2001, 2003, 2002]
    assert {r["value"] for r in yearly.stitch(spark, path, range(2001, 2004)).collect()} == {2001.0, 2002.0, 2003.0, 0.0}
    (part,) = (tmp_path / "years" / "year=2002").glob("*.parquet")
    part.write_bytes(b"")
    inputs = spark.createDataFrame([(2001, dt.datetime(2000, 1, 1)), (2003, dt.datetime(2100, 1, 1))], "year int, modified timestamp")
    assert yearly.run_years(spark, range(2001, 2004), build, path, inputs) == [2002, 2003]
    with pytest.raises(ValueError, match="no data"):
        yearly.stitch(spark, path, range(2001, 2005))
    yearly.run_years(spark, [2004], build, path)
    with pytest.raises(ValueError, match="other polygons"):
        yearly.stitch(spark, path, range(2001, 2005))


def test_grid_files(spark, tmp_path):
    for year in (2000, 2001):
        spark.createDataFrame([(year, 0, 1.0)], "year int, ix int, v double").coalesce(1).write.parquet(f"{tmp_path}/grids/y{year}")
    grids = tables.read_grids(spark, f"{tmp_path}/grids", "year int, ix int, v double")
    assert {r["year"] for r in grids.collect()} == {2000, 2001}
    with pytest.raises(FileNotFoundError):
        tables.read_grids(spark, f"{tmp_path}/grids", "year int, ix int, v double", "*.nothing")
    stamps = {r["year"]: r["modified"] for r in tables.file_stamps(grids).collect()}
    listing = tables.read_file_listing(spark, f"{tmp_path}/grids", "*.parquet").collect()
    assert sorted(stamps) == [2000, 2001] and len(listing) == 2 and {r["modificationTime"] for r in listing} == set(stamps.values()) and all(r["length"] > 0 for r in listing)


def test_years_in_many_files(spark, tmp_path):
    rows = spark.range(50).select(F.lit("a").alias("source"), F.lit("v").alias("var"), F.col("id").alias("hru"), F.lit(D(2000, 1, 1)).alias("t"), F.lit(1.0).alias("value"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else so few rows come together again
    try:
        tables.write_series(rows, f"{tmp_path}/s", hru_span=5)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    got = spark.read.parquet(f"{tmp_path}/s").select("hru", F.input_file_name().alias("f")).collect()
    assert len(got) == 50 and len({r["f"] for r in got}) > 1


def test_archives_to_targets(spark):
    content = lambda **k: bytearray(archive(**k))
    files = spark.createDataFrame([("x/SNODAS_20050117.tar", content()), ("x/SNODAS_20050118.tar", content())], "path string, content binary")
    at = spark.createDataFrame([(1, -124.45, 52.45), (2, -124.25, 52.45), (3, -124.45, 52.35), (4, 0.0, 0.0), (5, -124.35, 52.45)], "hru long, x double, y double")
    got = {(r["t"], r["hru"], r["value"]) for r in pipelines.snow_archives(files, at).select("t", "hru", "value").collect()}
    assert got == {(D(2005, 1, d), h, v) for d in (17, 18) for h, v in ((1, 1.0), (2, 3.0), (3, 4.0))}
    other = files.unionByName(spark.createDataFrame([("x/SNODAS_20050119.tar", content(columns=2))], "path string, content binary"))
    with pytest.raises(ValueError):
        pipelines.snow_archives(other, at)
    with pytest.raises(FileNotFoundError):
        pipelines.snow_archives(files.limit(0), at)


def test_archives(spark, tmp_path):
    (tmp_path / "SNODAS_20050117.tar").write_bytes(archive())
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert {(r["iy"], r["ix"], r["value"]) for r in archives.snow_pixels(files).collect()} == {(0, 0, 1), (0, 2, 3), (1, 0, 4), (1, 1, 5)}
    assert archives.snow_headers(files).first()["max_y"] == 52.5
    for bad in (archive(short=True), archive(drop=True)):
        with pytest.raises(ValueError):
            archives.decode_archive(bad)


def test_wkb(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 2.0), (0.0, 0.0)]
    blob = struct.pack("<BIII", 1, 3, 1, 4) + b"".join(struct.pack("<dd", *p) for p in ring)
    f = archives.polygons(spark.createDataFrame([(7, bytearray(blob))], "id int, geometry binary"), "id")
    assert f.select(geometry.area(F.col("rings"))).first()[0] == 1.0
    island = struct.pack("<BIII", 1, 3, 1, 4) + b"".join(struct.pack("<dd", x + 6, y) for x, y in ring)
    big = struct.pack(">BIII", 0, 3, 1, 4) + b"".join(struct.pack(">dd", *p) for p in ring)
    several = struct.pack("<BII", 1, 6, 2) + big + island
    f = archives.polygons(spark.createDataFrame([(7, bytearray(several)), (8, None), (9, bytearray(struct.pack("<BII", 1, 6, 0)))], "hru int, geometry binary"))
    assert [(r["hru"], r["part"]) for r in f.orderBy("part").collect()] == [(7, 0), (7, 1)]
    (r,) = geometry.area_and_centroids(f).collect()
    assert (r["hru"], r["area_m2"], r["centroid_x"]) == (7, 2.0, pytest.approx(2 / 3 + 3))
    assert sum(w["area"] for w in geometry.weights(f, 0.0, 0.0, 10.0, 10.0, 1, 1).collect()) == pytest.approx(2.0) and geometry.weights(f, 0.0, 0.0, 10.0, 10.0, 1, 1).count() == 1
    with pytest.raises(ValueError):
        archives.decode_wkb(struct.pack("<BI", 1, 1) + bytes(16))


def test_drift_and_checks(spark):
    h = lambda rows: spark.createDataFrame(rows, "day int, rows int, columns int, min_x double, max_y double")
    assert quality.drift_summary(h([(1, 5, 6, 0.0, 0.0), (2, 5, 6, 0.004, 0.0), (3, 5, 6, 0.0, 0.0)])) == {"drifted": 1, "max_drift": pytest.approx(0.004)}
    for row in ((2, 5, 7, 0.0, 0.0), (2, 5, 6, 0.01, 0.0)):
        with pytest.raises(ValueError):
            quality.drift_summary(h([(1, 5, 6, 0.0, 0.0), row]))
    a, b = spark.range(3).toDF("hru"), spark.range(2, -1, -1).toDF("hru")
    quality.check_same_ids(a, b)
    with pytest.raises(ValueError):
        quality.check_same_ids(a, spark.range(4).toDF("hru"))
    with pytest.raises(ValueError):
        quality.check_unique(a.unionByName(a), "hru")
    with pytest.raises(ValueError):
        quality.require_variables(a, ["hru", "x"])


def test_diagnostics(spark):
    rows = [(D(2010, 1, 15 + d), h, v, c) for d, (vs, cs) in enumerate([((None,) * 4, (0.0,) * 4), ((0.6, 0.2, None, None), (0.9, 0.9, 0.1, 0.1)), ((0.6, 0.7, 0.8, None), (0.9, 0.9, 0.2, 0.3)), ((0.6, 0.7, 0.8, 0.9), (0.9,) * 4), ((0.6, 0.1, 0.1, 0.1), (0.9,) * 4)]) for h, (v, c) in enumerate(zip(vs, cs, strict=True))]
    s = diagnostics.coverage_by_day(spark.createDataFrame(rows, "t date, hru int, sca double, vaf double"), "sca", 0.5, "vaf", 0.5)
    got = [tuple(r)[1:] for r in s.orderBy("t").collect()]
    assert got == [(0, 0, 0, 0), (2, 1, 2, 1), (3, 3, 2, 2), (4, 4, 4, 4), (4, 1, 4, 1)]
    assert diagnostics.best_day(s, month=1).first()["t"] == D(2010, 1, 18)
    with pytest.raises(ValueError):
        diagnostics.best_day(s, month=5)


def test_calendar_year(spark):
    days = spark.range(1).select(F.explode(F.sequence(F.lit("1998-10-01").cast("date"), F.lit("2000-09-30").cast("date"))).alias("t"))
    rows = days.select("t", F.lit(1).alias("cell"), (F.year("t") + F.when(F.month("t") >= 10, 1).otherwise(0)).alias("water_year"))
    assert raster.calendar_year(rows, 1999, ["cell"]).count() == 365
    for bad in (rows.where("water_year = 1999"), rows.where("t <> date'1999-03-01'"), rows.unionByName(rows)):
        with pytest.raises(ValueError):
            raster.calendar_year(bad, 1999, ["cell"])


def test_resampling(spark):
    px = spark.createDataFrame([(1, 0.05, 0.95, 2.0), (1, 0.15, 0.85, 4.0), (1, 0.9, 0.1, 7.0), (1, 3.0, 3.0, 9.0)], "t int, lon double, lat double, value double")
    grid = raster.target_grid(0.0, 0.0, 1.0, 1.0, 0.5)
    assert grid == (0.0, 1.0, 0.5, 0.5, 2, 2)
    assert {(r["ty"], r["tx"], r["value"]) for r in raster.to_grid(px, grid, "average", ["t"]).collect()} == {(0, 0, 3.0), (1, 1, 7.0)}
    assert {(r["ty"], r["tx"], r["value"]) for r in raster.to_grid(px, grid, "nearest", ["t"]).collect()} == {(0, 0, 4.0), (1, 1, 7.0)}
    tiles = spark.createDataFrame([("b", 1, 1.0), ("a", 1, 2.0), ("b", 2, 3.0)], "tile string, cell int, value double")
    assert {(r["cell"], r["value"]) for r in raster.mosaic(tiles, ["cell"], "tile").collect()} == {(1, 2.0), (2, 3.0)}


def test_et_tiles(spark):
    x, y = projections.to_sinusoidal(F.lit(-100.0), F.lit(40.0))
    px = spark.createDataFrame([("h1", 1, 32000.0), ("h2", 2, 3000.0), ("h2", 2, 3300.0)], "tile string, k int, value double").select("tile", F.lit(1).alias("t"), (x + F.col("k") * 10).alias("x"), y.alias("y"), "value")
    got = pipelines.et_tiles(px, raster.target_grid(-101, 39, -99, 41, 2), ["tile"]).collect()
    assert len(got) == 1 and got[0]["value"] in (32000.0, 17500.0)


def test_runoff_plan(spark):
    months = lambda y0, y1, v: series(spark, [(h, D(y, m, 28), v) for h in (1, 2, 3) for y in range(y0, y1 + 1) for m in range(1, 13)])
    meta = spark.createDataFrame([(h, 1e6) for h in (1, 2, 3)], "hru long, area_m2 double")
    out = runoff.build({"era5": months(2000, 2001, 0.05), "gldas": months(2000, 2001, 2.0), "mwbm": months(2000, 2000, 30.0)}, meta, (D(2000, 1, 1), D(2001, 12, 31)))
    got = out.collect()
    assert len(got) == 72 and {(r["t"].year, r["n_sources"]) for r in got} == {(2000, 3), (2001, 2)}
    jan = next(r for r in got if r["hru"] == 1 and r["t"] == D(2000, 1, 1))
    assert jan["lower_bound"] == pytest.approx(30e-3 / 31 * 1e6 * 35.3146667 / 86400) and jan["upper_bound"] == pytest.approx(2 * 8 * 31e-3 / 31 * 1e6 * 35.3146667 / 86400)


def test_swe_plan(spark):
    days = lambda v: series(spark, [(h, D(2003, 10, 1) + dt.timedelta(days=k), v) for h in (1, 2, 3) for k in range(92)])
    hrus = spark.createDataFrame([(1,), (2,), (3,)], "hru long")
    src = {"daymet": days(50.0), "snodas": days(80.0), "era5": days(0.1), "margulis": days(0.2)}
    period = (D(2003, 10, 1), D(2003, 12, 31))
    for token, top, n in (("or", 200 / 25.4, 4), (None, 100 / 25.4, 3)):
        r = swe.build(src, hrus, period, token).agg(F.min("lower_bound"), F.max("upper_bound"), F.min("n_sources"), F.count("*")).first()
        assert tuple(r) == (pytest.approx(50 / 25.4), pytest.approx(top), n, 276)
    with pytest.raises(ValueError):
        swe.check_years(swe.build({"daymet": days(50.0).limit(0)}, hrus, period))


def test_specs(spark):
    assert len(specs.sources_by_key()) == 16
    with pytest.raises(ValueError):
        specs.sources_by_key(specs.SOURCES + specs.SOURCES[:1])
    cat = spark.createDataFrame([("era5_land", "ro", "m"), ("gldas_noah_v21_monthly", "runoff_total", "mm")], "source string, var string, cf_units string")
    assert {r["source"] for r in quality.unit_mismatches(specs.expected_units(spark, "runoff"), cat).collect()} == {"gldas_noah_v21_monthly", "mwbm_climgrid"}
    with pytest.raises(ValueError):
        specs.check_scope("zz")


def test_tables(spark, tmp_path):
    path = f"{tmp_path}/series"
    rows = spark.createDataFrame([("a", "v", 2, D(2000, 1, 1), 1.0), ("a", "v", 1, D(2001, 1, 1), 2.0)], "source string, var string, hru long, t date, value double")
    tables.write_series(rows, path)
    tables.write_series(rows.where("year(t) = 2001").withColumn("value", F.lit(5.0)), path)
    assert {(r["hru"], r["value"]) for r in tables.read_series(spark, path, "a", "v", (D(2000, 1, 1), D(2001, 12, 31))).collect()} == {(2, 1.0), (1, 5.0)}
    for args, error in ((("b", "v"), FileNotFoundError), (("a", "w"), KeyError)):
        with pytest.raises(error):
            tables.read_series(spark, path, *args, (D(2000, 1, 1), D(2001, 12, 31)))
    with pytest.raises(ValueError):
        tables.read_series(spark, path, "a", "v", (D(1990, 1, 1), D(1990, 12, 31)))
    b = bounds.multi_source_bounds([rows.select("hru", "t", "value")])
    tables.write_target(b, f"{tmp_path}/target")
    back = tables.read_target(spark, f"{tmp_path}/target", start=D(2001, 1, 1))
    assert back.count() == 1 and dict(back.dtypes)["lower_bound"] == "float"
    with pytest.raises(ValueError):
        tables.stack_pair(spark.createDataFrame([(2000,)], "year int"), spark.createDataFrame([(2001,)], "year int"))


def test_incremental_years(spark, tmp_path):
    w = spark.createDataFrame([(0, 0, 1, 1.0), (0, 1, 1, 3.0)], "iy int, ix int, hru long, area double")
    spec = specs.SourceSpec("demo", ("v",))
    schema = "iy int, ix int, t date, v double"
    run = lambda: incremental.run_available(spark, f"{tmp_path}/in", schema, w, spec, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    for year in (2000, 2001):
        spark.createDataFrame([(0, 0, D(year, 1, 1), 10.0), (0, 1, D(year, 1, 1), 20.0)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert {(r["year"], r["value"]) for r in got} == {(2000, 17.5), (2001, 17.5)}
