"""Zonal statistics, geometry, rasters and batches as queries."""

from __future__ import annotations

import struct

from pyspark.sql import functions as F

from catchment.functions import projections
from catchment.operators import geometry, partitioning, raster, zonal
from catchment.plans import pipelines, views
from catchment.plans.targets import sca_inputs
from catchment.plans.views import with_views
from catchment.sources import archives
from catchment.sources.specs import SourceSpec

QUERIES: dict = {}
CELL = ("cell",)
JOINED = "j AS (SELECT hru, t, value, quality, area FROM grid JOIN weights USING (cell))"


def r4(c):
    """Four digits; the shift keeps exact halves from falling either way. The SQL has the same shift."""
    return F.round(c + 3e-7, 4)


def rounded(df, *names):
    return df.withColumns({n: r4(F.col(n).cast("double")) for n in names})


QUERIES["j1_weighted_join"] = (lambda s, d: rounded(zonal.weighted(views.grid(s, d), views.weights(s, d), CELL).groupBy("hru", "t").agg(F.count("*").alias("n"), F.sum(F.col("value") * F.col("area")).alias("total")), "total"), with_views("pixels grid weights", JOINED, "SELECT hru, t, count(*) AS n, round(sum(value * area), 4) AS total FROM j GROUP BY ALL"))
MASS = "sum(CASE WHEN value IS NOT NULL THEN area END)"
FORMS = {
    "mean": f"sum(value * area) / {MASS}", "min": "min(value)", "max": "max(value)", "sum": "sum(value * area)", "count": "count(value)",
    "std": f"sqrt(greatest(sum(area * value * value) / {MASS} - (sum(area * value) / {MASS}) * (sum(area * value) / {MASS}), 0))",
}
for _id, _stat in (("a1_mean", "mean"), ("a2_masked_mean", "masked_mean"), ("a3_min", "min"), ("a3_masked_min", "masked_min"), ("a3_max", "max"), ("a3_masked_max", "masked_max"), ("a4_sum", "sum"), ("a4_masked_sum", "masked_sum"), ("a4_count", "count"), ("a4_masked_count", "masked_count"), ("a5_std", "std"), ("a5_masked_std", "masked_std")):
    _form = FORMS[_stat.removeprefix("masked_")]
    _value = _form if _stat.startswith("masked") else f"CASE WHEN count(value) = n_cells THEN {_form} END"
    QUERIES[_id] = (
        lambda s, d, stat=_stat: rounded(zonal.aggregate(views.grid(s, d), views.weights(s, d), ["value"], stat, cell=CELL), "value"),
        with_views("pixels grid weights cells", JOINED, f"SELECT hru, t, round(CAST({_value} AS DOUBLE), 4) AS value FROM j JOIN cells USING (hru) GROUP BY hru, t, n_cells"),
    )
MEDIAN = "run AS (SELECT hru, t, value, sum(area) OVER (PARTITION BY hru, t ORDER BY value RANGE UNBOUNDED PRECEDING) AS r, sum(area) OVER (PARTITION BY hru, t) AS a FROM j WHERE value IS NOT NULL), md AS (SELECT hru, t, min(value) AS v FROM run WHERE r >= a / 2 GROUP BY ALL), n AS (SELECT hru, t, count(value) AS k FROM j GROUP BY ALL)"
QUERIES["a6_masked_median"] = (lambda s, d: rounded(zonal.aggregate(views.grid(s, d), views.weights(s, d), ["value"], "masked_median", cell=CELL), "value"), with_views("pixels grid weights", f"{JOINED}, {MEDIAN}", "SELECT hru, t, round(v, 4) AS value FROM n LEFT JOIN md USING (hru, t)"))
QUERIES["a6_median"] = (lambda s, d: rounded(zonal.aggregate(views.grid(s, d), views.weights(s, d), ["value"], "median", cell=CELL), "value"), with_views("pixels grid weights cells", f"{JOINED}, {MEDIAN}", "SELECT hru, t, round(CASE WHEN k = n_cells THEN v END, 4) AS value FROM n LEFT JOIN md USING (hru, t) JOIN cells USING (hru)"))
QUERIES["a7_valid_area_fraction"] = (lambda s, d: rounded(zonal.valid_area_fraction(views.grid(s, d).withColumn("valid_mask", (F.col("quality") > 70).cast("double")), views.weights(s, d), cell=CELL), "valid_area_fraction"), with_views("pixels grid weights", JOINED, "SELECT hru, t, round(sum(CASE WHEN quality > 70 THEN area ELSE 0 END) / sum(area), 4) AS valid_area_fraction FROM j GROUP BY ALL"))
QUERIES["a8_several_variables"] = (lambda s, d: rounded(zonal.aggregate(views.grid(s, d), views.weights(s, d), ["value", "quality"], "masked_mean", cell=CELL), "value", "quality"), with_views("pixels grid weights", JOINED, f"SELECT hru, t, round(sum(value * area) / {MASS}, 4) AS value, round(sum(quality * area) / sum(CASE WHEN quality IS NOT NULL THEN area END), 4) AS quality FROM j GROUP BY ALL"))
QUERIES["a1_covered_fraction"] = (lambda s, d: rounded(zonal.covered_fraction(views.grid(s, d), views.weights(s, d), "value", cell=CELL), "covered_fraction"), with_views("pixels grid weights cells", JOINED, "SELECT hru, t, round(sum(CASE WHEN value IS NOT NULL THEN area ELSE 0 END) / all_area, 4) AS covered_fraction FROM j JOIN cells USING (hru) GROUP BY hru, t, all_area"))


def e1(spark, d):
    spec = SourceSpec("demo", ("value", "twice"), "masked_mean", before=lambda df: df.withColumn("twice", F.col("value") * 2), after=lambda df: df.withColumnsRenamed({"value": "v"}))
    out = pipelines.aggregate_source(views.grid(spark, d), views.weights(spark, d), spec, cell=CELL)
    return rounded(pipelines.to_long(out, "demo", ["v", "twice"]), "value")


QUERIES["e1_aggregate_source"] = (e1, with_views("pixels grid weights", f"{JOINED}, m AS (SELECT hru, t, sum(value * area) / {MASS} AS v FROM j GROUP BY ALL)", "SELECT 'demo' AS source, 'v' AS var, hru, t, round(v, 4) AS value FROM m UNION ALL SELECT 'demo', 'twice', hru, t, round(2 * v, 4) FROM m"))


def e7(spark, d):
    g = views.grid(spark, d).select("cell", "t", (F.col("value") * 3).alias("snow"), F.col("quality").alias("ci"))
    return rounded(sca_inputs.build(g, views.weights(spark, d), cell=CELL), "snow_fraction", "valid_area_fraction")


QUERIES["e7_sca_inputs"] = (e7, with_views("pixels grid weights", "g AS (SELECT cell, t, CASE WHEN quality > 70 AND value * 3 <= 100 THEN value * 3 END AS snow, CASE WHEN quality > 70 THEN 1 ELSE 0 END AS ok FROM grid)", "SELECT hru, t, round(sum(snow * area) / sum(CASE WHEN snow IS NOT NULL THEN area END) / 100, 4) AS snow_fraction, round(sum(ok * area) / sum(area), 4) AS valid_area_fraction FROM g JOIN weights USING (cell) GROUP BY ALL"))
QUERIES["q17_without_cells"] = (lambda s, d: zonal.without_cells(views.table(s, d, "customer").select((F.col("c_custkey") % 500).alias("hru")).distinct(), views.weights(s, d)), with_views("weights", "", "SELECT DISTINCT c_custkey % 500 AS hru FROM customer WHERE c_custkey % 500 NOT IN (SELECT hru FROM weights)"))
QUERIES["g3_area_and_centroid"] = (lambda s, d: rounded(views.boxes(s, d).select("hru", geometry.area(F.col("rings")).alias("area"), *[c.alias(n) for c, n in zip(geometry.centroid(F.col("rings")), ("cx", "cy"), strict=True)]), "area", "cx", "cy"), with_views("boxes", "", "SELECT hru, round(1.7::DOUBLE * 1.7::DOUBLE, 4) AS area, round(x0 + 0.85, 4) AS cx, round(y0 + 0.85, 4) AS cy FROM boxes"))
OVERLAP = "c AS (SELECT hru, x0, y0, ix, iy FROM boxes JOIN (SELECT unnest(range(12)) AS ix) ON ix BETWEEN floor(x0) AND floor(x0) + 2 JOIN (SELECT unnest(range(rows)) AS iy FROM box_rows) ON iy BETWEEN floor(y0) AND floor(y0) + 2), a AS (SELECT CAST(iy AS INT) AS iy, CAST(ix AS INT) AS ix, hru, (least(x0 + 1.7, ix + 1) - greatest(x0, ix)) * (least(y0 + 1.7, iy + 1) - greatest(y0, iy)) AS area FROM c WHERE x0 < ix + 1 AND x0 + 1.7 > ix AND y0 < iy + 1 AND y0 + 1.7 > iy)"
QUERIES["g5_weights"] = (lambda s, d: rounded(geometry.weights(views.boxes(s, d), 0.0, 0.0, 1.0, 1.0, 12, views.box_rows(s, d)), "area"), with_views("boxes box_rows", OVERLAP, "SELECT iy, ix, hru, round(area, 4) AS area FROM a"))


def g5_irregular(spark, d):
    axis = lambda n: spark.range(n).select(F.col("id").cast("int").alias("idx"), F.col("id").cast("double").alias("lo"), (F.col("id") + 1).cast("double").alias("hi"))
    return rounded(geometry.irregular_weights(views.boxes(spark, d), axis(12), axis(views.box_rows(spark, d))), "area")


QUERIES["g5_irregular_weights"] = (g5_irregular, with_views("boxes box_rows", OVERLAP, "SELECT iy, ix, hru, round(area, 4) AS area FROM a"))
QUERIES["g12_extent"] = (lambda s, d: rounded(geometry.extent(views.boxes(s, d), 0.5), "west", "south", "east", "north"), with_views("boxes", "", "SELECT round(min(x0) - 0.5, 4) AS west, round(min(y0) - 0.5, 4) AS south, round(max(x0) + 2.2, 4) AS east, round(max(y0) + 2.2, 4) AS north, count(*) AS n_polygons FROM boxes"))


def g8(spark, d):
    p = views.table(spark, d, "customer").select("c_custkey", ((F.col("c_custkey") * 7) % 120 / 10.0 + 0.05).cast("double").alias("x"), ((F.col("c_custkey") * 13) % 110 / 10.0 + 0.05).cast("double").alias("y"))
    return geometry.locate(p, views.boxes(spark, d), 2.0).select("c_custkey", "hru")


QUERIES["g8_locate"] = (g8, with_views("boxes", "p AS (SELECT c_custkey, CAST((c_custkey * 7) % 120 / 10.0 + 0.05 AS DOUBLE) AS x, CAST((c_custkey * 13) % 110 / 10.0 + 0.05 AS DOUBLE) AS y FROM customer)", "SELECT c_custkey, min(hru) AS hru FROM p LEFT JOIN boxes ON x > x0 AND x < x0 + 1.7 AND y > y0 AND y < y0 + 1.7 GROUP BY c_custkey"))


def g4(spark, d):
    p = views.centroids(spark, d).select("hru", (F.lit(-100.0) + F.col("x") * 20).alias("lon"), (F.lit(38.0) + F.col("y") * 10).alias("lat"))
    x, y = projections.to_albers(F.col("lon"), F.col("lat"))
    lon, lat = projections.from_albers(F.col("x"), F.col("y"))
    sx, sy = projections.to_sinusoidal(F.col("lon"), F.col("lat"))
    return p.withColumn("x", x).withColumn("y", y).select("hru", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"), F.round(sx, 2).alias("sx"), F.round(sy, 2).alias("sy"))


QUERIES["g4_reproject"] = (g4, with_views("centroids", "p AS (SELECT hru, -100.0::DOUBLE + x * 20 AS lon, 38.0::DOUBLE + y * 10 AS lat FROM centroids)", "SELECT hru, round(lon, 6) AS lon, round(lat, 6) AS lat, round(6371007.181::DOUBLE * radians(lon) * cos(radians(lat)), 2) AS sx, round(6371007.181::DOUBLE * radians(lat), 2) AS sy FROM p"))
MD5 = "sum(('0x' || substr(md5(CAST(hru AS VARCHAR)), {at}, 15))::UBIGINT)"
QUERIES["g6_weight_key"] = (lambda s, d: partitioning.fingerprint(views.boxes(s, d), "unit"), with_views("boxes", "", f"SELECT sha256(concat_ws('#', count(*), {MD5.format(at=1)}, {MD5.format(at=17)}, 'unit')) AS key FROM boxes"))


def _batches_sql(levels: int = 12) -> str:
    """Bisection level by level; those beyond the depth that the table needs change nothing."""
    out = ["depth AS (SELECT greatest(0, ceil(log2(greatest(1.0, count(*) / 50.0)))) AS depth FROM centroids)", "l0 AS (SELECT hru, x, y, '' AS path, true AS open FROM centroids)"]
    for k in range(levels):
        c = "x" if k % 2 == 0 else "y"
        out.append(f"c{k} AS (SELECT path, cut FROM (SELECT path, quantile_disc({c}, 0.5) AS cut, count(*) AS n, max({c}) AS hi FROM l{k} WHERE open GROUP BY path), depth WHERE n > 25 AND hi > cut AND {k} < depth)")
        out.append(f"l{k + 1} AS (SELECT hru, x, y, CASE WHEN open AND cut IS NOT NULL THEN path || CASE WHEN {c} <= cut THEN '0' ELSE '1' END ELSE path END AS path, open AND cut IS NOT NULL AS open FROM l{k} LEFT JOIN c{k} USING (path))")
    return ", ".join([*out, f"batches AS (SELECT hru, CAST(dense_rank() OVER (ORDER BY path) - 1 AS INT) AS batch_id FROM l{levels})"])


QUERIES["g7_spatial_batches"] = (lambda s, d: partitioning.spatial_batches(views.centroids(s, d), 50).select("hru", "batch_id"), with_views("centroids", _batches_sql(), "SELECT hru, batch_id FROM batches"))
QUERIES["a24_batch_statistics"] = (
    lambda s, d: rounded(partitioning.batch_statistics(partitioning.spatial_batches(views.centroids(s, d), 50)), "mean_size", "median_size"),
    with_views("centroids", f"{_batches_sql()}, n AS (SELECT batch_id, count(*) AS n FROM batches GROUP BY 1)", "SELECT count(*) AS n_batches, min(n) AS smallest, max(n) AS largest, round(avg(n), 4) AS mean_size, round(quantile_cont(n::DOUBLE, 0.5), 4) AS median_size FROM n"),
)


def parts(spark, d):
    """Boxes and the same boxes three units to the east as multipolygons in well-known binary."""
    def encode(frames):
        for f in frames:
            blobs = []
            for x, y in zip(f["x0"], f["y0"], strict=True):
                ring = [(x, y), (x + 1.7, y), (x + 1.7, y + 1.7), (x, y + 1.7), (x, y)]
                part = lambda by: struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", a + by, b) for a, b in ring)  # noqa: B023, E731
                blobs.append(struct.pack("<BII", 1, 6, 2) + part(0.0) + part(3.0))
            yield f.assign(geometry=blobs)[["hru", "geometry"]]

    return archives.polygons(views.boxes(spark, d).select("hru", "x0", "y0").mapInPandas(encode, "hru long, geometry binary"))


QUERIES["s3_multi_polygons"] = (
    lambda s, d: rounded(geometry.area_and_centroids(parts(s, d)).select("hru", F.col("area_m2").alias("area"), F.col("centroid_x").alias("cx"), F.col("centroid_y").alias("cy")), "area", "cx", "cy"),
    with_views("boxes", "", "SELECT hru, round(2 * 1.7::DOUBLE * 1.7::DOUBLE, 4) AS area, round(x0 + 2.35, 4) AS cx, round(y0 + 0.85, 4) AS cy FROM boxes"),
)
QUERIES["g5_multi_polygon_weights"] = (
    lambda s, d: rounded(geometry.weights(parts(s, d), 0.0, 0.0, 2.0, 1.0, 8, views.box_rows(s, d)), "area"),
    with_views("boxes box_rows", """p AS (SELECT hru, x0, y0 FROM boxes UNION ALL SELECT hru, x0 + 3, y0 FROM boxes),
    c AS (SELECT hru, CAST(ix AS INT) AS ix, CAST(iy AS INT) AS iy, least(x0 + 1.7, 2 * ix + 2) - greatest(x0, 2 * ix) AS w, least(y0 + 1.7, iy + 1) - greatest(y0, iy) AS h FROM (SELECT hru, x0, y0, unnest(range(8)) AS ix FROM p) JOIN (SELECT unnest(range(rows)) AS iy FROM box_rows) ON iy BETWEEN floor(y0) AND floor(y0) + 2)""",
    "SELECT iy, ix, hru, round(sum(w * h), 4) AS area FROM c WHERE w > 0 AND h > 0 GROUP BY ALL"),
)


def tiles(spark, d):
    return views.pixels(spark, d).select((F.col("cell") % 97).alias("cell"), "t", F.col("cell").alias("tile"), "value")


def g9(spark, d):
    t = tiles(spark, d).groupBy("cell", "t", "tile").agg(F.max("value").alias("value"))
    return raster.mosaic(t, ["t", "cell"], "tile").select("t", "cell", "tile", "value")


QUERIES["g9_mosaic"] = (g9, with_views("pixels", "x AS (SELECT cell % 97 AS cell, t, cell AS tile, max(value) AS value FROM pixels GROUP BY ALL)", "SELECT t, cell, tile, value FROM (SELECT *, row_number() OVER (PARTITION BY t, cell ORDER BY tile) AS k FROM x) WHERE k = 1"))


def g10(spark, d):
    c = views.centroids(spark, d).select(F.lit(1).alias("t"), "x", "y", F.col("hru").cast("double").alias("value"))
    return rounded(raster.to_grid(c, raster.target_grid(-0.5, -0.5, 0.5, 0.5, 0.1), "average", ["t"], lon="x", lat="y"), "value")


QUERIES["g10_average_to_grid"] = (g10, with_views("centroids", "", "SELECT 1 AS t, CAST(floor((0.5::DOUBLE - y) / 0.1::DOUBLE) AS INT) AS ty, CAST(floor((x + 0.5::DOUBLE) / 0.1::DOUBLE) AS INT) AS tx, round(avg(hru), 4) AS value FROM centroids WHERE floor((0.5::DOUBLE - y) / 0.1::DOUBLE) BETWEEN 0 AND 9 AND floor((x + 0.5::DOUBLE) / 0.1::DOUBLE) BETWEEN 0 AND 9 GROUP BY ALL"))


def g11(spark, d):
    target = views.boxes(spark, d).select("hru", (F.col("x0") + 0.85).alias("x"), (F.col("y0") + 0.85).alias("y"))
    n = views.box_rows(spark, d)
    look = raster.nearest_lookup(target, 0.0, float(n), 1.0, 1.0, 12, n)
    return raster.resample(views.gridded(spark, d, F.max), look).select("hru", "t", "value")


QUERIES["g11_nearest_resample"] = (g11, with_views("pixels boxes box_rows", "k AS (SELECT hru, CAST(floor(x0 + 0.85) AS INT) AS ix, CAST(floor(rows - (y0 + 0.85)) AS INT) AS iy FROM boxes, box_rows), v AS (SELECT CAST(floor(cell / 12) % rows AS INT) AS iy, CAST(cell % 12 AS INT) AS ix, t, max(value) AS value FROM pixels, box_rows GROUP BY ALL)", "SELECT hru, t, value FROM k JOIN v USING (ix, iy)"))


def g10_overlap(spark, d):
    """Cells of 1 by 0.8 onto cells of 0.7 by 0.9 that start a little aside."""
    n = views.box_rows(spark, d)
    return rounded(raster.overlap_average(views.gridded(spark, d, F.max), (0.0, float(n), 1.0, 0.8, 12, n), (0.4, n - 0.3, 0.7, 0.9, 17, n), ["t"]), "value")


QUERIES["g10_overlap_average"] = (
    g10_overlap,
    with_views("pixels box_rows", """v AS (SELECT CAST(floor(cell / 12) % rows AS INT) AS iy, CAST(cell % 12 AS INT) AS ix, t, max(value) AS value FROM pixels, box_rows GROUP BY ALL),
    xs AS (SELECT ix, CAST(tx AS INT) AS tx, least(ix + 1, 0.4::DOUBLE + (tx + 1) * 0.7::DOUBLE) - greatest(ix, 0.4::DOUBLE + tx * 0.7::DOUBLE) AS wx FROM (SELECT unnest(range(12)) AS ix), (SELECT unnest(range(17)) AS tx)),
    ys AS (SELECT iy, CAST(ty AS INT) AS ty, least((iy + 1) * 0.8::DOUBLE, 0.3::DOUBLE + (ty + 1) * 0.9::DOUBLE) - greatest(iy * 0.8::DOUBLE, 0.3::DOUBLE + ty * 0.9::DOUBLE) AS wy FROM (SELECT unnest(range(rows)) AS iy FROM box_rows), (SELECT unnest(range(rows)) AS ty FROM box_rows))""",
    "SELECT t, ty, tx, round(sum(wx * wy * value) / sum(wx * wy), 4) AS value FROM v JOIN xs USING (ix) JOIN ys USING (iy) WHERE wx > 1e-9 AND wy > 1e-9 AND value IS NOT NULL GROUP BY ALL"),
)


def g13(spark, d):
    """The largest value of each cell and day, put on a shifted grid of half the columns that has the least values."""
    n = views.box_rows(spark, d)
    other = views.gridded(spark, d, F.min).where("ix % 2 = 0").withColumn("ix", (F.col("ix") / 2).cast("int"))
    out = raster.on_common_grid(views.gridded(spark, d, F.max), (0.0, float(n), 1.0, 1.0, 12, n), other, (2.5, n + 1.25, 2.0, 1.0, 6, n), ["t"])
    return out.select("t", "iy", "ix", "value", "source_value")


QUERIES["g13_on_common_grid"] = (
    g13,
    with_views("pixels box_rows", "v AS (SELECT CAST(floor(cell / 12) % rows AS INT) AS iy, CAST(cell % 12 AS INT) AS ix, t, min(value) AS lo, max(value) AS hi FROM pixels, box_rows GROUP BY ALL)",
    "SELECT o.t, o.iy, CAST(o.ix / 2 AS INT) AS ix, o.lo AS value, s.hi AS source_value FROM v o CROSS JOIN box_rows LEFT JOIN v s ON s.t = o.t AND s.ix = floor(2.5 + o.ix + 1) AND s.iy = floor(o.iy + 0.5 - 1.25) WHERE o.ix % 2 = 0 AND floor(2.5 + o.ix + 1) BETWEEN 0 AND 11 AND floor(o.iy + 0.5 - 1.25) BETWEEN 0 AND rows - 1"),
)
QUERIES["j13_attach_to_fabric"] = (lambda s, d: views.boxes(s, d).join(views.one(s, d, "A").groupBy("hru").agg(r4(F.avg("value")).alias("mean")), "hru").select("hru", r4(F.col("x0")).alias("x0"), "mean"), with_views("boxes series", "", "SELECT b.hru, round(x0, 4) AS x0, m.mean FROM boxes b JOIN (SELECT hru, round(avg(value), 4) AS mean FROM series WHERE source = 'A' GROUP BY hru) m ON b.hru = m.hru"))
