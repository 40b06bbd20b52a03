"""Round trips through written tables, regrouped years and consolidated grids as queries."""

from __future__ import annotations

import datetime as dt
import gzip
import io
import tarfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from catchment.functions import projections
from catchment.operators import raster
from catchment.operators.bounds import multi_source_bounds
from catchment.plans import pipelines, queries_time, views, yearly
from catchment.plans.queries_time import r4, rounded
from catchment.plans.views import with_views
from catchment.sources import tables
from catchment.sources.archives import SNOW_MEMBER

QUERIES: dict = {}


def s2(spark, d):
    path = f"{tables.scratch(spark)}/series"
    tables.write_series(views.series(spark, d).withColumn("var", F.lit("v")).select("source", "var", "hru", "t", "value"), path)
    out = tables.read_series(spark, path, "B", "v", (dt.date(1996, 3, 1), dt.date(1999, 6, 1)))
    return out.select("source", "var", "hru", "t", r4(F.col("value")).alias("value"))


QUERIES["s2_read_series"] = (s2, with_views("series", "", "SELECT source, 'v' AS var, hru, t, round(value, 4) AS value FROM series WHERE source = 'B' AND t BETWEEN DATE '1996-03-01' AND DATE '1999-06-01'"))


def s11(spark, d):
    path = f"{tables.scratch(spark)}/target"
    tables.write_target(multi_source_bounds([views.one(spark, d, x) for x in "ABC"]), path)
    out = tables.read_target(spark, path, dt.date(1997, 1, 1), dt.date(1998, 12, 1))
    return out.groupBy("hru").agg(F.count("*").alias("n"), F.sum(F.col("n_sources").cast("long")).alias("sources"), F.min("t").alias("first"), F.max("t").alias("last"))


QUERIES["s11_s15_target_round_trip"] = (s11, with_views("series", "b AS (SELECT hru, t, count(value) AS k FROM series GROUP BY ALL)", "SELECT hru, count(*) AS n, CAST(sum(k) AS BIGINT) AS sources, min(t) AS first, max(t) AS last FROM b WHERE t BETWEEN DATE '1997-01-01' AND DATE '1998-12-01' GROUP BY hru"))


def _years(spark, d):
    """The years of the series, and what builds one of them."""
    s = views.series(spark, d)
    ends = s.agg(F.min(F.year("t")), F.max(F.year("t"))).first()
    one = lambda y: multi_source_bounds([s.where((F.col("source") == x) & (F.year("t") == y)) for x in "ABC"])
    return range(ends[0], ends[1] + 1), one


def s12(spark, d):
    years, one = _years(spark, d)
    path = f"{tables.scratch(spark)}/years"
    yearly.run_years(spark, years, one, path)
    return rounded(yearly.stitch(spark, path, years), "lower_bound", "upper_bound")


QUERIES["s12_stitched_years"] = (s12, queries_time.QUERIES["a9_multi_source_bounds"][1])


def s10_resumed(spark, d):
    """A run over every other year that a run over all years goes on from."""
    years, one = _years(spark, d)
    path = f"{tables.scratch(spark)}/years"
    first = yearly.run_years(spark, years[::2], one, path)
    then = yearly.run_years(spark, years, one, path)
    if set(first) & set(then) or len(first) + len(then) != len(years):
        raise ValueError("years were built twice or not at all")
    return rounded(yearly.stitch(spark, path, years), "lower_bound", "upper_bound")


QUERIES["s10_resumed_years"] = (s10_resumed, queries_time.QUERIES["a9_multi_source_bounds"][1])


def s13(spark, d):
    path = f"{tables.scratch(spark)}/regions"
    views.table(spark, d, "customer").select("c_custkey", F.when(F.col("c_nationkey") < 10, "na").otherwise("eu").alias("region")).write.partitionBy("region").parquet(path)
    return tables.read_region(spark, path, "na").select("c_custkey", "region")


QUERIES["s13_read_region"] = (s13, "SELECT c_custkey, 'na' AS region FROM customer WHERE c_nationkey < 10")


def s9(spark, d):
    o = views.table(spark, d, "orders").withColumn("var", F.when(F.col("o_orderstatus") == "F", "F").otherwise("other"))
    part = lambda var: o.where(F.col("var") == var).groupBy(F.year("o_orderdate").alias("year"), "var").agg(r4(F.avg("o_totalprice")).alias("value"))
    return tables.stack_pair(part("F"), part("other"))


QUERIES["s9_stack_pair"] = (s9, "SELECT CAST(year(o_orderdate) AS INT) AS year, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'other' END AS var, round(avg(o_totalprice), 4) AS value FROM orders GROUP BY ALL")


def u2(spark, d):
    li = views.table(spark, d, "lineitem")
    days = li.select(F.to_date("l_shipdate").alias("t"), "l_quantity").groupBy("t").agg(F.avg("l_quantity").alias("value"))
    every = spark.range(1).select(F.explode(F.sequence(F.lit("1997-10-01").cast("date"), F.lit("1999-09-30").cast("date"))).alias("t"))
    halves = every.join(days, "t", "left").select(F.lit(1).alias("cell"), "t", (F.year("t") + F.when(F.month("t") >= 10, 1).otherwise(0)).alias("water_year"), "value")
    return rounded(raster.calendar_year(halves, 1998, ["cell"]).select("t", "water_year", "value"), "value")


QUERIES["u2_calendar_year"] = (u2, "WITH v AS (SELECT CAST(l_shipdate AS DATE) AS t, avg(l_quantity) AS value FROM lineitem GROUP BY 1) SELECT CAST(m AS DATE) AS t, CAST(CASE WHEN month(m) >= 10 THEN 1999 ELSE 1998 END AS INT) AS water_year, round(value, 4) AS value FROM generate_series(TIMESTAMP '1998-01-01', TIMESTAMP '1998-12-31', INTERVAL 1 DAY) g(m) LEFT JOIN v ON v.t = m")


def e8(spark, d):
    c = views.centroids(spark, d)
    x, y = projections.to_sinusoidal(F.lit(-100.0) + F.col("x") * 5, F.lit(40.0) + F.col("y") * 5)
    tile = F.concat(F.lit("h"), (F.col("hru") % 4).cast("string"))
    pixels = c.select(tile.alias("tile"), F.lit(1).alias("t"), x.alias("x"), y.alias("y"), (F.col("hru") % 3600).cast("double").alias("value"))
    return rounded(pipelines.et_tiles(pixels, raster.target_grid(-102.0, 38.0, -98.0, 42.0, 1.0), ["tile"]), "value")


QUERIES["e8_et_tiles"] = (
    e8,
    with_views("centroids", """p AS (SELECT 'h' || (hru % 4) AS tile, -100.0::DOUBLE + x * 5 AS lon, 40.0::DOUBLE + y * 5 AS lat, CAST(hru % 3600 AS DOUBLE) AS value FROM centroids),
    f AS (SELECT tile, lon, lat, CASE WHEN value <= CASE WHEN max(value) OVER (PARTITION BY tile) > 5000 THEN 32700 ELSE 3270 END THEN value END AS value FROM p),
    m AS (SELECT lon, lat, value FROM f QUALIFY row_number() OVER (PARTITION BY lon, lat ORDER BY tile) = 1)""",
    "SELECT 1 AS t, CAST(floor(42 - lat) AS INT) AS ty, CAST(floor(lon + 102) AS INT) AS tx, round(avg(value), 4) AS value FROM m WHERE floor(42 - lat) BETWEEN 0 AND 3 AND floor(lon + 102) BETWEEN 0 AND 3 GROUP BY ALL"),
)


def _archive(key, frame):
    """One day's grid (rows, iy, ix, value) as an archive: gzipped header and big-endian numbers in a tar file."""
    rows = int(frame["rows"].iloc[0])
    grid = np.full((rows, 12), -9999, ">i2")
    some = frame[frame["value"].notna()]
    grid[some["iy"], some["ix"]] = some["value"]
    day = key[0].strftime("%Y%m%d")
    head = f"Number of rows: {rows}\nNumber of columns: 12\nMinimum x-axis coordinate: 0\nMaximum y-axis coordinate: {rows}\nX-axis resolution: 1\nY-axis resolution: 1\n"
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for end, body in (("txt", head.encode()), ("dat", grid.tobytes())):
            info = tarfile.TarInfo(f"{SNOW_MEMBER}_{day}.{end}.gz")
            packed = gzip.compress(body)
            info.size = len(packed)
            tar.addfile(info, io.BytesIO(packed))
    return pd.DataFrame({"path": [f"archives/day_{day}.tar"], "content": [out.getvalue()]})


def e9(spark, d):
    """Every day's pixels are packed into an archive, and the archives go all the way to the boxes."""
    target = views.boxes(spark, d).select("hru", (F.col("x0") + 0.85).alias("x"), (F.col("y0") + 0.85).alias("y"))
    files = views.gridded(spark, d, F.min).withColumn("rows", F.lit(views.box_rows(spark, d))).groupBy("t").applyInPandas(_archive, "path string, content binary")
    return pipelines.snow_archives(files, target).select("hru", "t", "value")


QUERIES["e9_snow_archives"] = (e9, with_views("pixels boxes box_rows", "k AS (SELECT hru, CAST(floor(x0 + 0.85) AS INT) AS ix, CAST(floor(rows - (y0 + 0.85)) AS INT) AS iy FROM boxes, box_rows), v AS (SELECT CAST(floor(cell / 12) % rows AS INT) AS iy, CAST(cell % 12 AS INT) AS ix, t, min(value) AS value FROM pixels, box_rows GROUP BY ALL)", "SELECT hru, t, CAST(value AS DOUBLE) AS value FROM k JOIN v USING (ix, iy) WHERE value IS NOT NULL"))
