"""Coverings, projections by attributes, snow by year, and results from parts."""

from __future__ import annotations

import datetime as dt
import gzip
import io
import struct
import tarfile

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import functions as F

from catchment.functions import projections
from catchment.functions.projections import _E, _E2, A
from catchment.operators import covering, geometry
from catchment.plans import pipelines, views
from catchment.plans.queries_space import FORMS, JOINED, r4, rounded
from catchment.plans.targets import swe
from catchment.plans.views import with_views
from catchment.sources import fabric, tables
from catchment.sources.archives import SNOW_MEMBER
from catchment.sources.tables import scratch
from catchment.streaming.partials import STATS, PartStore

QUERIES: dict = {}


def sizes(spark, d):
    """Squares of sides from 0.5 to 500, one per supplier."""
    k = F.col("s_suppkey")
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    b = views.table(spark, d, "supplier").select(k.alias("hru"), (k * 37 % 997 + 0.25).cast("double").alias("x0"), (k * 53 % 991 + 0.25).cast("double").alias("y0"), (0.5 * F.pow(F.lit(10.0), k % 4)).alias("side"))
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("side"), F.col("y0") + F.col("side")
    return b.withColumn("rings", F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1))))


def g8_covered(spark, d):
    p = views.table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") * 7919 % 10007 / 10.0 + 0.025).cast("double").alias("x"), (F.col("c_custkey") * 104729 % 10009 / 10.0 + 0.025).cast("double").alias("y"))
    return covering.locate(p, covering.covering(sizes(spark, d))).select("c_custkey", "hru")


QUERIES["g8_locate_covered"] = (
    g8_covered,
    """WITH b AS (SELECT s_suppkey AS hru, CAST(s_suppkey * 37 % 997 + 0.25 AS DOUBLE) AS x0, CAST(s_suppkey * 53 % 991 + 0.25 AS DOUBLE) AS y0, 0.5::DOUBLE * pow(10.0, s_suppkey % 4) AS side FROM supplier),
    p AS (SELECT c_custkey, CAST(c_custkey * 7919 % 10007 / 10.0 + 0.025 AS DOUBLE) AS x, CAST(c_custkey * 104729 % 10009 / 10.0 + 0.025 AS DOUBLE) AS y FROM customer)
    SELECT c_custkey, min(hru) AS hru FROM p LEFT JOIN b ON x > x0 AND x < x0 + side AND y > y0 AND y < y0 + side GROUP BY c_custkey""",
)


def g4_lambert(spark, d):
    """Points of two regions, each projected with its own attributes and brought back through its grid mapping."""
    north = F.col("hru") % 2 == 0
    of = lambda a, b: F.when(north, F.lit(a)).otherwise(F.lit(b))
    p = views.centroids(spark, d).select("hru", (of(-100.0, -157.0) + F.col("x") * 10).alias("lon"), (of(42.5, 20.5) + F.col("y") * 10).alias("lat"), of(25.0, 18.0).alias("lat1"), of(60.0, 23.0).alias("lat2"), of(42.5, 20.5).alias("lat0"), of(-100.0, -157.0).alias("lon0"), of(0.0, 5e5).alias("fe"))
    x, y = projections.to_lambert_by(F.col("lon"), F.col("lat"), *map(F.col, ("lat1", "lat2", "lat0", "lon0", "fe")))
    mapping = F.struct(F.lit("lambert_conformal_conic").alias("grid_mapping_name"), F.array("lat1", "lat2").alias("standard_parallel"), F.col("lat0").alias("latitude_of_projection_origin"), F.col("lon0").alias("longitude_of_central_meridian"), F.col("fe").alias("false_easting"), F.lit(0.0).alias("false_northing"))
    lon, lat = projections.geographic(F.col("px"), F.col("py"), mapping)
    return p.withColumns({"px": x, "py": y}).withColumns({"glon": lon, "glat": lat}).select("hru", F.round("px", 2).alias("x"), F.round("py", 2).alias("y"), F.round("glon", 6).alias("lon"), F.round("glat", 6).alias("lat"))


def _t(s: str) -> str:
    return f"(tan(pi() / 4 - asin({s}) / 2) / pow((1 - {_E!r}::DOUBLE * ({s})) / (1 + {_E!r}::DOUBLE * ({s})), {_E / 2!r}::DOUBLE))"


def _m(lat: str) -> str:
    return f"(cos(radians({lat})) / sqrt(1 - {_E2!r}::DOUBLE * pow(sin(radians({lat})), 2)))"


QUERIES["g4_lambert_by_attributes"] = (
    g4_lambert,
    with_views("centroids", f"""p AS (SELECT hru, CASE hru % 2 WHEN 0 THEN -100 ELSE -157 END AS lon0, CASE hru % 2 WHEN 0 THEN 42.5 ELSE 20.5 END::DOUBLE AS lat0, CASE hru % 2 WHEN 0 THEN 25 ELSE 18 END AS lat1, CASE hru % 2 WHEN 0 THEN 60 ELSE 23 END AS lat2, CASE hru % 2 WHEN 0 THEN 0 ELSE 500000 END AS fe, x AS dx, y AS dy FROM centroids),
    q AS (SELECT *, lon0 + dx * 10 AS lon, lat0 + dy * 10 AS lat, ln({_m('lat1')} / {_m('lat2')}) / ln({_t('sin(radians(lat1))')} / {_t('sin(radians(lat2))')}) AS n FROM p),
    r AS (SELECT *, {A!r}::DOUBLE * {_m('lat1')} / (n * pow({_t('sin(radians(lat1))')}, n)) AS f FROM q)""",
    f"SELECT hru, round(fe + f * pow({_t('sin(radians(lat))')}, n) * sin(n * radians(lon - lon0)), 2) AS x, round(f * pow({_t('sin(radians(lat0))')}, n) - f * pow({_t('sin(radians(lat))')}, n) * cos(n * radians(lon - lon0)), 2) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM r"),
)


def swe_years(spark, d):
    """Daily snow of four sources, one of which only even years have and one only odd ones, built by year, filled and put together."""
    li = views.table(spark, d, "lineitem").withColumn("t", F.to_date("l_shipdate"))
    label = F.when(F.col("l_returnflag") == "A", "daymet").when(F.col("l_returnflag") == "R", "snodas").when(F.year("t") % 2 == 0, "era5").otherwise("margulis")
    day = li.groupBy(label.alias("label"), (F.col("l_suppkey") % 20).alias("hru"), "t").agg(F.avg("l_quantity").alias("value"))
    day.write.parquet(path := f"{scratch(spark)}/swe")
    day = spark.read.parquet(path)
    hrus = day.select("hru").distinct()
    centroids = hrus.select("hru", (F.col("hru") % 5).cast("double").alias("x"), (F.floor(F.col("hru") / 5) * 11 / 10).alias("y"))  # as 1.1 is exact in the SQL
    ends = day.agg(F.min(F.year("t")), F.max(F.year("t"))).first()
    sources = {x: day.where(F.col("label") == x).drop("label") for x in ("daymet", "snodas", "era5", "margulis")}
    out = swe.build_years(spark, sources, hrus, range(ends[0], ends[1] + 1), f"{scratch(spark)}/years", "or", centroids)
    return rounded(out.select("hru", "t", "lower_bound", "upper_bound", "n_sources", "nn_filled"), "lower_bound", "upper_bound")


QUERIES["e6_swe_by_year"] = (
    swe_years,
    """WITH s AS (SELECT CASE l_returnflag WHEN 'A' THEN 'daymet' WHEN 'R' THEN 'snodas' ELSE CASE WHEN year(l_shipdate) % 2 = 0 THEN 'era5' ELSE 'margulis' END END AS label, l_suppkey % 20 AS hru, CAST(l_shipdate AS DATE) AS t, avg(l_quantity) AS v FROM lineitem GROUP BY ALL),
    i AS (SELECT hru, t, CASE WHEN label IN ('era5', 'margulis') THEN v * 1000 ELSE v END / 25.4 AS value FROM s),
    b AS (SELECT hru, t, min(value) AS lower_bound, max(value) AS upper_bound, count(value) AS n FROM i GROUP BY ALL),
    days AS (SELECT CAST(m AS DATE) AS t FROM (SELECT unnest(generate_series(make_timestamp(CAST(min(year(t)) AS BIGINT), 1, 1, 0, 0, 0), make_timestamp(CAST(max(year(t)) AS BIGINT), 12, 31, 0, 0, 0), INTERVAL 1 DAY)) AS m FROM s)),
    f AS (SELECT hru, t, lower_bound, upper_bound, CAST(coalesce(n, 0) AS TINYINT) AS n_sources FROM (SELECT DISTINCT hru FROM s) CROSS JOIN days LEFT JOIN b USING (hru, t)),
    p AS (SELECT DISTINCT hru, CAST(hru % 5 AS DOUBLE) AS x, CAST((hru // 5) * 1.1 AS DOUBLE) AS y FROM s),
    near AS (SELECT * FROM (SELECT a.hru, c.hru AS donor, row_number() OVER (PARTITION BY a.hru ORDER BY (a.x - c.x) * (a.x - c.x) + (a.y - c.y) * (a.y - c.y), c.hru) AS k FROM p a JOIN p c ON a.hru <> c.hru) WHERE k <= 10),
    g AS (SELECT f.hru, f.t, arg_min(o.lower_bound, k) AS lo, arg_min(o.upper_bound, k) AS hi FROM f JOIN near ON near.hru = f.hru JOIN f o ON o.hru = donor AND o.t = f.t WHERE f.n_sources = 0 AND o.n_sources > 0 GROUP BY ALL)
    SELECT hru, t, round(coalesce(lower_bound, lo), 4) AS lower_bound, round(coalesce(upper_bound, hi), 4) AS upper_bound, n_sources, CAST(CASE WHEN lo IS NOT NULL THEN 1 ELSE 0 END AS TINYINT) AS nn_filled FROM f LEFT JOIN g USING (hru, t)""",
)


def from_parts(spark, d):
    """The grid in three parts that land out of order; one of them lands with other values first."""
    grid = views.grid(spark, d).withColumn("part", (F.col("cell") % 3).cast("string"))
    weights = views.weights(spark, d)
    store = PartStore(spark, f"{scratch(spark)}/parts")
    part = lambda k: grid.where(F.col("part") == k)
    for some in (part("1"), part("0").withColumn("value", -F.col("value")), part("2"), part("0")):
        store.add(some, weights, ["value"], cell=("cell",))
    out = None
    for stat in ("mean", *(f"masked_{s}" for s in STATS)):
        one = store.result(stat, weights).select("hru", "t", r4(F.col("value").cast("double")).alias(stat))
        out = one if out is None else out.join(one, ["hru", "t"])
    return out


QUERIES["s10_results_from_parts"] = (
    from_parts,
    with_views("pixels grid weights cells", JOINED, f"SELECT hru, t, round(CASE WHEN count(value) = n_cells THEN {FORMS['mean']} END, 4) AS mean, {', '.join(f'round(CAST({FORMS[s]} AS DOUBLE), 4) AS masked_{s}' for s in STATS)} FROM j JOIN cells USING (hru) GROUP BY hru, t, n_cells"),
)


def pruned(spark, d):
    """The boxes as well-known binary in a packed fabric, read back for the middle of their place."""
    def encode(frames):
        for f in frames:
            blobs = []
            for x, y, side in zip(f["x0"], f["y0"], f["side"], strict=True):
                ring = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
                blobs.append(struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<dd", *p) for p in ring))
            yield f.assign(geometry=blobs)

    boxes = sizes(spark, d).drop("rings")
    made = boxes.mapInPandas(encode, "hru long, x0 double, y0 double, side double, geometry binary")
    ends = F.struct(F.col("x0").alias("xmin"), F.col("y0").alias("ymin"), (F.col("x0") + F.col("side")).alias("xmax"), (F.col("y0") + F.col("side")).alias("ymax"))
    path = f"{scratch(spark)}/fabric"
    fabric.write_fabric(made.select("hru", ends.alias("bbox"), "geometry"), path, 9)
    return fabric.read_fabric(spark, path, (300.0, 300.0, 600.0, 700.0)).select("hru", r4(geometry.area(F.col("rings"))).alias("area"))


QUERIES["s3_pruned_fabric"] = (
    pruned,
    """WITH b AS (SELECT s_suppkey AS hru, CAST(s_suppkey * 37 % 997 + 0.25 AS DOUBLE) AS x0, CAST(s_suppkey * 53 % 991 + 0.25 AS DOUBLE) AS y0, 0.5::DOUBLE * pow(10.0, s_suppkey % 4) AS side FROM supplier)
    SELECT hru, round(side * side, 4) AS area FROM b WHERE x0 <= 600 AND x0 + side >= 300 AND y0 <= 700 AND y0 + side >= 300""",
)


def _pack(path):
    """Writes one day's pixels (rows, iy, ix, value) as an archive; a task that is repeated writes the same file again."""
    def run(key, frame):
        rows = int(frame["rows"].iloc[0])
        grid = np.full((rows, 12), -9999, ">i2")
        some = frame[frame["value"].notna()]
        grid[some["iy"], some["ix"]] = some["value"]
        head = f"Number of rows: {rows}\nNumber of columns: 12\nMinimum x-axis coordinate: 0\nMaximum y-axis coordinate: {rows}\nX-axis resolution: 1\nY-axis resolution: 1\n"
        day = key[0].strftime("%Y%m%d")
        store, at = fs.FileSystem.from_uri(path)
        with store.open_output_stream(f"{at}/day_{day}.tar") as out, tarfile.open(fileobj=out, mode="w|") as tar:
            for end, body in (("txt", head.encode()), ("dat", grid.tobytes())):
                packed = gzip.compress(body)
                info = tarfile.TarInfo(f"us_{SNOW_MEMBER}_{day}.{end}.gz")
                info.size = len(packed)
                tar.addfile(info, io.BytesIO(packed))
        return pd.DataFrame({"t": [key[0]]})

    return run


def snow_days(spark, d):
    """Every day's pixels go to an archive in the shared folder, and those of two years come back through the data source."""
    path = scratch(spark).removeprefix("file://").removeprefix("file:")
    store, at = fs.FileSystem.from_uri(path)
    store.create_dir(at, recursive=True)
    pixels = views.gridded(spark, d, F.min).withColumn("rows", F.lit(views.box_rows(spark, d)))
    pixels.groupBy("t").applyInPandas(_pack(path), "t date").write.format("noop").mode("overwrite").save()
    target = views.boxes(spark, d).select("hru", (F.col("x0") + 0.85).alias("x"), (F.col("y0") + 0.85).alias("y"))
    return pipelines.snow_source(spark, path, target, dt.date(1996, 1, 1), dt.date(1997, 12, 31), days=64).select("hru", "t", "value")


QUERIES["s8_snow_source"] = (
    snow_days,
    with_views("pixels boxes box_rows", "k AS (SELECT hru, CAST(floor(x0 + 0.85) AS INT) AS ix, CAST(floor(rows - (y0 + 0.85)) AS INT) AS iy FROM boxes, box_rows), v AS (SELECT CAST(floor(cell / 12) % rows AS INT) AS iy, CAST(cell % 12 AS INT) AS ix, t, min(value) AS value FROM pixels, box_rows GROUP BY ALL)", "SELECT hru, t, CAST(value AS DOUBLE) AS value FROM k JOIN v USING (ix, iy) WHERE value IS NOT NULL AND t BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"),
)


def grid_files(spark, d):
    """Grid files by name pattern, other files beside them, and two cadences of one source under keys of their own."""
    path = scratch(spark)
    grid = views.grid(spark, d).select("t", "cell", "value")
    grid.write.parquet(f"{path}/grids/yearly")
    views.hourly(spark, d).write.mode("overwrite").json(f"{path}/grids/notes")
    rows = tables.read_grids(spark, f"{path}/grids", "t date, cell long, value double")
    yearly = rows.select(F.lit("era5_land").alias("source"), F.lit("ro").alias("var"), (F.col("cell") % 20).alias("hru"), "t", "value").groupBy("source", "var", "hru", "t").agg(F.avg("value").alias("value"))
    daily = views.pixels(spark, d).groupBy(F.lit("era5_land_sd").alias("source"), F.lit("sd").alias("var"), (F.col("cell") % 20).alias("hru"), "t").agg(F.avg("value").alias("value"))
    tables.write_series(yearly, f"{path}/series")
    tables.write_series(daily, f"{path}/series")
    period = (dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    both = [tables.read_series(spark, f"{path}/series", source, var, period) for source, var in (("era5_land", "ro"), ("era5_land_sd", "sd"))]
    return rounded(both[0].unionByName(both[1]).groupBy("source", "var", "hru").agg(F.count("*").alias("n"), F.avg("value").alias("mean")), "mean")


QUERIES["s1_s14_two_cadences"] = (
    grid_files,
    with_views("pixels grid", "s AS (SELECT 'era5_land' AS source, 'ro' AS var, cell % 20 AS hru, t, avg(value) AS value FROM grid GROUP BY ALL UNION ALL SELECT 'era5_land_sd', 'sd', cell % 20, t, avg(value) FROM pixels GROUP BY ALL)", "SELECT source, var, hru, count(*) AS n, round(avg(value), 4) AS mean FROM s WHERE t BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' GROUP BY ALL"),
)
