"""Views that give the provided tables the roles of grids, weights and series, as DataFrames and as SQL.

The tables hold no grids, so: line items are grid values (a cell per part, a year per
shipment year, missing where all were returned), parts are weights (two polygons each),
three monthly averages are sources, events are hourly data, orders are composites and
suppliers are polygons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.sources.tables import cut

N_HRU = 400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, d: str) -> DataFrame:
    """(cell, t, value, quality): every line item as one pixel of a day."""
    q = (F.round(F.col("l_discount") * 100) * 10).alias("quality")
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("cell"), F.to_date("l_shipdate").alias("t"), F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("value"), q)


def grid(spark: SparkSession, d: str) -> DataFrame:
    """(cell, t, value, quality): one value per cell and year."""
    return pixels(spark, d).groupBy("cell", F.trunc("t", "year").alias("t")).agg(F.avg("value").alias("value"), F.max("quality").alias("quality"))


def weights(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select(F.col("p_partkey").alias("cell"), F.col("p_size").cast("double").alias("area"))
    return p.select("cell", (F.col("cell") % N_HRU).alias("hru"), "area").unionByName(p.select("cell", ((F.col("cell") + 7) % N_HRU).alias("hru"), "area"))


def series(spark: SparkSession, d: str) -> DataFrame:
    """(source, hru, t, value) of A, B and C; C ends with 1999."""
    li = table(spark, d, "lineitem")
    hru, month = (F.col("l_suppkey") % 20).alias("hru"), lambda c: F.to_date(F.trunc(c, "month")).alias("t")
    a = li.groupBy(hru, month("l_shipdate")).agg(F.avg("l_quantity").alias("value"), F.avg(F.col("l_extendedprice") / 1000).alias("b"))
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    c = li.select("l_orderkey", "l_suppkey").join(o, F.col("l_orderkey") == F.col("o_orderkey")).where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    c = c.groupBy(hru, month("o_orderdate")).agg(F.avg(F.col("o_totalprice") / 1000).alias("value"))
    ab = a.select(F.explode(F.array(F.struct(F.lit("A").alias("source"), F.col("value")), F.struct(F.lit("B").alias("source"), F.col("b").alias("value")))).alias("s"), "hru", "t")
    return ab.select("s.source", "hru", "t", "s.value").unionByName(c.select(F.lit("C").alias("source"), "hru", "t", "value"))


def one(spark: SparkSession, d: str, source: str) -> DataFrame:
    return series(spark, d).where(F.col("source") == source).drop("source")


def by_source(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The three sources' (hru, t, value), worked out once and written; each is read with its filter."""
    rows = cut(series(spark, d))
    return {x: rows.where(F.col("source") == x).drop("source") for x in "ABC"}


def hourly(spark: SparkSession, d: str) -> DataFrame:
    """(hru, ts, value): the greatest event value of each hour, missing where it is below 20."""
    ts = F.date_trunc("hour", "ts")
    v = F.max("value")
    return table(spark, d, "events").groupBy((F.col("user_id") % 25).alias("hru"), ts.alias("ts")).agg(F.when(v >= 20, v).alias("value"))


def daily(spark: SparkSession, d: str) -> DataFrame:
    """(source, hru, t, value): mean event value per day, event types as sources."""
    return table(spark, d, "events").groupBy(F.col("event_type").alias("source"), (F.col("user_id") % 25).alias("hru"), F.to_date("ts").alias("t")).agg(F.avg("value").alias("value"))


def composites(spark: SparkSession, d: str) -> DataFrame:
    """(hru, t, value): totals of 8-day bins from 1 January on; missing where the polygon id is 3 and the bin is the tenth."""
    o = table(spark, d, "orders")
    k = F.floor((F.dayofyear("o_orderdate") - 1) / 8).cast("int")
    t = F.date_add(F.to_date(F.trunc("o_orderdate", "year")), k * 8)
    hru = F.col("o_custkey") % 5
    return o.groupBy(hru.alias("hru"), t.alias("t"), k.alias("k")).agg(F.sum(F.col("o_totalprice") / 1000).alias("s")).select("hru", "t", F.when(~((F.col("hru") == 3) & (F.col("k") == 9)), F.col("s")).alias("value"))


def boxes(spark: SparkSession, d: str) -> DataFrame:
    """(hru, rings, x0, y0): boxes of side 1.7 at thirds of a unit, one per supplier."""
    x0, y0 = F.col("s_suppkey") % 10 + F.lit(0.3), F.floor(F.col("s_suppkey") / 10) + F.lit(0.3)
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    a, b, c, e = F.col("x0"), F.col("y0"), F.col("x0") + 1.7, F.col("y0") + 1.7
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("hru"), x0.cast("double").alias("x0"), y0.cast("double").alias("y0"))
    return s.withColumn("rings", F.array(F.array(p(a, b), p(c, b), p(c, e), p(a, e))))


def box_rows(spark: SparkSession, d: str) -> int:
    """Rows of a grid of unit cells, twelve columns wide, that all boxes' centres lie in."""
    return (table(spark, d, "supplier").agg(F.max("s_suppkey")).first()[0] or 0) // 10 + 2


def box_unit(spark: SparkSession, d: str) -> float:
    """Metres per unit of the boxes' pattern: it stays within 3000 km in height and 4000 km in width."""
    return min(3e6 / box_rows(spark, d), 3.3e5)


def albers_boxes(spark: SparkSession, d: str) -> DataFrame:
    """(hru, rings, x0, y0, side): the boxes' pattern in metres of the equal-area system."""
    u = box_unit(spark, d)
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("hru"), (-2.2e6 + (F.col("s_suppkey") % 10 + 0.3) * u).alias("x0"), (3e5 + (F.floor(F.col("s_suppkey") / 10) + 0.3) * u).alias("y0"), F.lit(1.7 * u).alias("side"))
    x0, y0, x1, y1 = F.col("x0"), F.col("y0"), F.col("x0") + F.col("side"), F.col("y0") + F.col("side")
    return b.withColumn("rings", F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1))))


def lonlat_grid(spark: SparkSession, d: str) -> tuple[float, float, float, float, int, int]:
    """(x0, y0, dx, dy, nx, ny) in degrees, rows from the south: a geographic grid that covers these boxes."""
    n = box_rows(spark, d)
    return -140.0, 10.0, 30.0 / n, 30.0 / n, -(-80 * n // 30), -(-46 * n // 30)


def gridded(spark: SparkSession, d: str, how) -> DataFrame:
    """(t, iy, ix, value): all pixels folded onto that grid by their cell's number."""
    n = box_rows(spark, d)
    return pixels(spark, d).groupBy("t", F.pmod(F.floor(F.col("cell") / 12), F.lit(n)).cast("int").alias("iy"), (F.col("cell") % 12).cast("int").alias("ix")).agg(how("value").alias("value"))


def centroids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("hru"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


def meta(spark: SparkSession, d: str) -> DataFrame:
    """(hru, area_m2) of the twenty polygons of the monthly series: a million square metres per supplier."""
    return table(spark, d, "supplier").groupBy((F.col("s_suppkey") % 20).alias("hru")).agg((F.count("*") * 1e6).alias("area_m2"))


SQL = {
    "pixels": "pixels AS (SELECT l_partkey AS cell, CAST(l_shipdate AS DATE) AS t, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS value, round(l_discount * 100) * 10 AS quality FROM lineitem)",
    "grid": "grid AS (SELECT cell, CAST(date_trunc('year', t) AS DATE) AS t, avg(value) AS value, max(quality) AS quality FROM pixels GROUP BY ALL)",
    "weights": f"weights AS (SELECT p_partkey AS cell, p_partkey % {N_HRU} AS hru, CAST(p_size AS DOUBLE) AS area FROM part UNION ALL SELECT p_partkey, (p_partkey + 7) % {N_HRU}, CAST(p_size AS DOUBLE) FROM part)",
    "cells": "cells AS (SELECT hru, count(*) AS n_cells, sum(area) AS all_area FROM weights GROUP BY hru)",
    "series": """series AS (
        SELECT 'A' AS source, l_suppkey % 20 AS hru, CAST(date_trunc('month', l_shipdate) AS DATE) AS t, avg(l_quantity) AS value FROM lineitem GROUP BY ALL
        UNION ALL SELECT 'B', l_suppkey % 20 AS hru, CAST(date_trunc('month', l_shipdate) AS DATE) AS t, avg(l_extendedprice / 1000) FROM lineitem GROUP BY ALL
        UNION ALL SELECT 'C', l_suppkey % 20 AS hru, CAST(date_trunc('month', o_orderdate) AS DATE) AS t, avg(o_totalprice / 1000) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY ALL)""",
    "hourly": "hourly AS (SELECT user_id % 25 AS hru, date_trunc('hour', ts) AS ts, CASE WHEN max(value) >= 20 THEN max(value) END AS value FROM events GROUP BY ALL)",
    "daily": "daily AS (SELECT event_type AS source, user_id % 25 AS hru, CAST(ts AS DATE) AS t, avg(value) AS value FROM events GROUP BY ALL)",
    "composites": """bins AS (SELECT o_custkey % 5 AS hru, CAST(floor((dayofyear(o_orderdate) - 1) / 8) AS INT) AS k, CAST(date_trunc('year', o_orderdate) AS DATE) AS y, sum(o_totalprice / 1000) AS s FROM orders GROUP BY ALL),
        composites AS (SELECT hru, y + k * 8 AS t, CASE WHEN NOT (hru = 3 AND k = 9) THEN s END AS value FROM bins)""",
    "boxes": "boxes AS (SELECT s_suppkey AS hru, CAST(s_suppkey % 10 + 0.3 AS DOUBLE) AS x0, CAST(floor(s_suppkey / 10) + 0.3 AS DOUBLE) AS y0 FROM supplier)",
    "box_rows": "box_rows AS (SELECT max(s_suppkey) // 10 + 2 AS rows FROM supplier)",
    "albers_boxes": "albers_boxes AS (SELECT s_suppkey AS hru, -2.2e6 + (s_suppkey % 10 + 0.3::DOUBLE) * least(3e6 / rows, 3.3e5) AS x0, 3e5 + (s_suppkey // 10 + 0.3::DOUBLE) * least(3e6 / rows, 3.3e5) AS y0, 1.7::DOUBLE * least(3e6 / rows, 3.3e5) AS side FROM supplier, box_rows)",
    "lonlat_grid": "lonlat_grid AS (SELECT 30.0::DOUBLE / rows AS dx, (80 * rows + 29) // 30 AS nx, (46 * rows + 29) // 30 AS ny FROM box_rows)",
    "centroids": "centroids AS (SELECT vec_id AS hru, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)",
    "meta": "meta AS (SELECT s_suppkey % 20 AS hru, count(*) * 1e6 AS area_m2 FROM supplier GROUP BY 1)",
}


def with_views(names: str, more: str, body: str) -> str:
    """SQL of ``body`` over the named views and further ones in ``more``."""
    parts = [SQL[n] for n in names.split()] + ([more] if more else [])
    return f"WITH {', '.join(parts)} {body}"
