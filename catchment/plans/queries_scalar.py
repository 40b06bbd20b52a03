"""Conversions, masks, filters and calendar arithmetic as queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.functions import masks, missing, timeaxis, units
from catchment.plans import views
from catchment.plans.views import with_views
from catchment.sources import filenames

QUERIES: dict = {}
DAYS = "dayofmonth(last_day(t))"


def r4(c):
    """Four digits; the shift keeps exact halves from falling either way. The SQL has the same shift."""
    return F.round(c + 3e-7, 4)


def _convert(f, source="A"):
    return lambda spark, d: views.one(spark, d, source).select("hru", "t", r4(f(F.col("value"), F.col("t"))).alias("value"))


def _convert_sql(expr, source="A"):
    return with_views("series", "", f"SELECT hru, t, round({expr}, 4) AS value FROM series WHERE source = '{source}'")


for _name, _f, _expr in (
    ("p1_metres_to_mm", lambda v, t: units.metres_to_mm(v), "value * 1000"),
    ("p2_three_hourly_mean_to_mm", units.three_hourly_mean_to_mm, f"value * 8 * {DAYS}"),
    ("p3_same", lambda v, t: units.same(v), "value"),
    ("p5_mm_to_inches_per_day", units.mm_to_inches_per_day, f"value / 25.4 / {DAYS}"),
    ("p6_mm_to_inches", lambda v, t: units.mm_to_inches(v), "value / 25.4"),
    ("p7_snow_metres_to_mm", lambda v, t: units.metres_to_mm(v), "value * 1000"),
    ("p8_rate_to_mm_per_month", units.rate_to_mm_per_month, f"value * {DAYS} * 86400"),
    ("p9_percent_to_fraction", lambda v, t: units.percent_to_fraction(v), "value / 100"),
):
    QUERIES[_name] = (_convert(_f), _convert_sql(_expr))


def p4(spark, d):
    s = views.one(spark, d, "A").join(views.meta(spark, d), "hru")
    return s.select("hru", "t", r4(units.mm_to_cfs(F.col("value"), F.col("t"), F.col("area_m2"))).alias("value"))


QUERIES["p4_mm_to_cfs"] = (p4, with_views("series meta", "", f"SELECT hru, t, round(value / 1000 / {DAYS} * area_m2 * 35.3146667 / 86400, 4) AS value FROM series JOIN meta USING (hru) WHERE source = 'A'"))


def p10(spark, d):
    return views.series(spark, d).select("source", "hru", "t", r4(units.water_content(F.col("value"), F.col("source"), ["B", "C"])).alias("value"))


QUERIES["p10_water_content"] = (p10, with_views("series", "", "SELECT source, hru, t, round(CASE WHEN source IN ('B', 'C') THEN value / 100 ELSE value END, 4) AS value FROM series"))


def wide(spark, d) -> DataFrame:
    a, b = (views.one(spark, d, s).withColumnRenamed("value", s.lower()) for s in "AC")
    return a.join(b, ["hru", "t"], "full")


WIDE = "wide AS (SELECT coalesce(x.hru, y.hru) AS hru, coalesce(x.t, y.t) AS t, x.value AS a, y.value AS c FROM (SELECT * FROM series WHERE source = 'A') x FULL JOIN (SELECT * FROM series WHERE source = 'C') y ON x.hru = y.hru AND x.t = y.t)"
QUERIES["p11_total_of_two"] = (lambda s, d: wide(s, d).select("hru", "t", r4(units.total_of(F.col("a"), F.col("c"))).alias("value")), with_views("series", WIDE, "SELECT hru, t, round(a + c, 4) AS value FROM wide"))
QUERIES["p16_spread"] = (lambda s, d: wide(s, d).select("hru", "t", r4(units.spread(F.col("a"), F.col("c"))).alias("value")), with_views("series", WIDE, "SELECT hru, t, round(c - a, 4) AS value FROM wide"))


def p12(spark, d):
    e = views.table(spark, d, "embeddings")
    stats = F.transform(F.slice("embedding", 1, 5), lambda x: x.cast("double"))
    return e.select("vec_id", r4(units.statistic(stats, 1)).alias("value"))


QUERIES["p12_statistic"] = (p12, "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 4) AS value FROM embeddings")
QUERIES["p13_canonical_names"] = (
    lambda s, d: views.table(s, d, "events").select("event_id", "ts", "value").withColumnsRenamed({"ts": "time", "value": "valid_area_fraction"}),
    "SELECT event_id, ts AS time, value AS valid_area_fraction FROM events",
)
QUERIES["p14_wrap_longitude"] = (
    lambda s, d: views.table(s, d, "part").select("p_partkey", r4(units.wrap_longitude((F.col("p_partkey") % 360).cast("double"))).alias("lon")),
    "SELECT p_partkey, round(CAST(CASE WHEN p_partkey % 360 >= 180 THEN p_partkey % 360 - 360 ELSE p_partkey % 360 END AS DOUBLE), 4) AS lon FROM part",
)
QUERIES["p15_cell_centre"] = (
    lambda s, d: views.table(s, d, "part").select("p_partkey", r4(units.cell_centre(F.lit(-125.0), F.lit(0.25), F.col("p_partkey"))).alias("lon"), r4(units.cell_centre(F.lit(53.0), F.lit(-0.25), F.col("p_partkey"))).alias("lat")),
    "SELECT p_partkey, round(-125.0::DOUBLE + 0.25::DOUBLE * (p_partkey + 0.5::DOUBLE), 4) AS lon, round(53.0::DOUBLE - 0.25::DOUBLE * (p_partkey + 0.5::DOUBLE), 4) AS lat FROM part",
)


def p17(spark, d):
    code = F.col("l_partkey") % 256
    return views.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", units.bit_field(code, 0, 2).cast("int").alias("quality"), units.bit_field(code, 2, 1).cast("int").alias("cloud"), units.bit_field(code, 3, 1).cast("int").alias("source"), units.bit_field(code, 4, 4).cast("int").alias("land_cover"))


QUERIES["p17_bit_fields"] = (p17, "SELECT l_orderkey, l_linenumber, CAST((l_partkey % 256) & 3 AS INT) AS quality, CAST(((l_partkey % 256) >> 2) & 1 AS INT) AS cloud, CAST(((l_partkey % 256) >> 3) & 1 AS INT) AS source, CAST(((l_partkey % 256) >> 4) & 15 AS INT) AS land_cover FROM lineitem")


def f1(spark, d):
    p = views.pixels(spark, d).select("cell", "t", (F.col("value") * 3).alias("snow"), F.col("quality").alias("ci"))
    g = masks.quality_gate(p, "snow", "ci")
    return g.groupBy("cell").agg(F.count("snow").alias("n_snow"), F.count("ci").alias("n_ci"), r4(F.sum("snow")).alias("snow"), r4(F.sum("valid_mask")).alias("valid"))


QUERIES["f1_quality_gate"] = (f1, with_views("pixels", "g AS (SELECT cell, CASE WHEN quality <= 100 AND quality > 70 AND value * 3 <= 100 THEN value * 3 END AS snow, CASE WHEN quality <= 100 THEN quality END AS ci, CASE WHEN quality <= 100 AND quality > 70 THEN 1.0 ELSE 0.0 END::DOUBLE AS valid FROM pixels)", "SELECT cell, count(snow) AS n_snow, count(ci) AS n_ci, round(sum(snow), 4) AS snow, round(sum(valid), 4) AS valid FROM g GROUP BY cell"))


def _mask(f, scale):
    return lambda s, d: views.pixels(s, d).select("cell", f(F.col("value") * scale).alias("v")).groupBy("cell").agg(F.count("v").alias("n"), r4(F.sum("v")).alias("total"))


def _mask_sql(cond, scale):
    return with_views("pixels", f"m AS (SELECT cell, value * {scale} AS v FROM pixels)", f"SELECT cell, count(CASE WHEN {cond} THEN v END) AS n, round(sum(CASE WHEN {cond} THEN v END), 4) AS total FROM m GROUP BY cell")


QUERIES["f2_et_fill"] = (_mask(masks.et_fill, 100), _mask_sql("v <= 3270", 100))
QUERIES["f4_snow_fill"] = (_mask(masks.snow_fill, -300), _mask_sql("v > -9990", -300))
QUERIES["f5_flag_list"] = (_mask(lambda v: masks.without_flags(masks.within(v, 2, 40), [7.0, 21.0]), 1), _mask_sql("v BETWEEN 2 AND 40 AND v NOT IN (7, 21)", 1))


def f3(spark, d):
    p = views.pixels(spark, d).select((F.col("cell") % 50).alias("tile"), "t", (F.col("value") * F.when(F.col("cell") % 50 < 25, 1000).otherwise(90)).alias("value"))
    return masks.et_fill_by_tile(p, "value", ["tile"]).groupBy("tile").agg(F.count("value").alias("n"), r4(F.sum("value")).alias("total"))


QUERIES["f3_et_fill_by_tile"] = (f3, with_views("pixels", "p AS (SELECT cell % 50 AS tile, value * CASE WHEN cell % 50 < 25 THEN 1000 ELSE 90 END AS value FROM pixels), l AS (SELECT tile, CASE WHEN max(value) > 5000 THEN 32700 ELSE 3270 END AS lim FROM p GROUP BY tile)", "SELECT tile, count(CASE WHEN value <= lim THEN 1 END) AS n, round(sum(CASE WHEN value <= lim THEN value END), 4) AS total FROM p JOIN l USING (tile) GROUP BY tile"))
QUERIES["f6_clip"] = (lambda s, d: masks.clip(views.centroids(s, d), 0.1, -0.1, -0.1, 0.1, "y", "x").select("hru"), with_views("centroids", "", "SELECT hru FROM centroids WHERE y BETWEEN -0.1 AND 0.1 AND x BETWEEN -0.1 AND 0.1"))


def f7(spark, d):
    c = views.centroids(spark, d).withColumn("source", F.col("hru") % 3)
    return masks.common_extent(c, "source", "y", "x").select("hru", "source")


QUERIES["f7_common_extent"] = (f7, with_views("centroids", "e AS (SELECT hru % 3 AS source, min(x) AS w, max(x) AS e, min(y) AS s, max(y) AS n FROM centroids GROUP BY 1), o AS (SELECT max(w) AS w, min(e) AS e, max(s) AS s, min(n) AS n FROM e)", "SELECT hru, hru % 3 AS source FROM centroids, o WHERE x BETWEEN w AND o.e AND y BETWEEN s AND n"))


def f8(spark, d):
    b = views.boxes(spark, d)
    rect = F.struct(F.when(F.col("hru") % 11 != 0, F.col("x0")).alias("w"), F.col("y0").alias("s"), (F.col("x0") + 1.7).alias("e"), (F.col("y0") + 1.7).alias("n"))
    g = b.select("hru", F.when(F.col("hru") % 7 != 0, F.array(rect)).alias("rects"))
    return g.where(masks.overlaps_box(F.col("rects"), 5.0, 2.0, 3.0, 4.0)).select("hru")


QUERIES["f8_granule_overlap"] = (f8, with_views("boxes", "", "SELECT hru FROM boxes WHERE hru % 7 = 0 OR hru % 11 = 0 OR x0 <= 4 AND x0 + 1.7 >= 2 AND y0 <= 5 AND y0 + 1.7 >= 3"))
QUERIES["f9_not_empty"] = (lambda s, d: masks.not_empty(views.table(s, d, "documents").select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("n_chars")).alias("length"))).select("doc_id"), "SELECT doc_id FROM documents WHERE doc_id % 9 <> 0 AND n_chars > 0")
QUERIES["f10_year_window"] = (lambda s, d: masks.year_window(views.pixels(s, d).withColumn("year", F.year("t")), 1997, 1999).groupBy("year").agg(F.count("*").alias("n")), with_views("pixels", "", "SELECT CAST(year(t) AS INT) AS year, count(*) AS n FROM pixels WHERE year(t) BETWEEN 1997 AND 1999 GROUP BY 1"))


def f11(spark, d):
    p = views.pixels(spark, d).withColumn("year", F.year("t"))
    masks.check_coverage(p, 1996, 2000)
    return p.agg(F.min("year").alias("first"), F.max("year").alias("last"))


QUERIES["f11_check_coverage"] = (f11, with_views("pixels", "", "SELECT CAST(min(year(t)) AS INT) AS first, CAST(max(year(t)) AS INT) AS last FROM pixels"))


def f12(spark, d):
    s = views.table(spark, d, "supplier").select(F.col("s_suppkey").alias("source"), F.when(F.col("s_suppkey") % 3 != 0, F.array(F.when(F.col("s_suppkey") % 3 == 1, "or").otherwise("na"))).alias("fabrics"))
    return masks.in_scope(s, "or").select("source")


QUERIES["f12_in_scope"] = (f12, "SELECT s_suppkey AS source FROM supplier WHERE s_suppkey % 3 IN (0, 1)")
QUERIES["f13_available"] = (lambda s, d: masks.available(views.table(s, d, "customer").select(F.col("c_custkey").alias("source")), views.table(s, d, "orders").select(F.col("o_custkey").alias("source"))), "SELECT c_custkey AS source FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")


def f14(spark, d):
    p = views.daily(spark, d)
    a = masks.first_of_month(p, 2024, 1, ["source", "hru"]).select("source", "hru", "t", r4(F.col("value")).alias("value"), F.lit("first").alias("kind"))
    b = masks.nearest_date(p.where("value is not null"), "2024-01-15", ["source", "hru"], "value").select("source", "hru", "t", r4(F.col("value")).alias("value"), F.lit("nearest").alias("kind"))
    return a.unionByName(b)


QUERIES["f14_snapshots"] = (f14, with_views("daily", "", """SELECT source, hru, min(t) AS t, round(arg_min(value, t), 4) AS value, 'first' AS kind FROM daily WHERE year(t) = 2024 AND month(t) = 1 GROUP BY ALL
    UNION ALL SELECT source, hru, t, round(value, 4), 'nearest' FROM (SELECT *, row_number() OVER (PARTITION BY source, hru ORDER BY abs(date_diff('day', t, DATE '2024-01-15')), t) AS k FROM daily) WHERE k = 1"""))
QUERIES["f15_season"] = (lambda s, d: views.one(s, d, "A").groupBy("hru", timeaxis.season(F.col("t")).alias("season")).agg(r4(F.avg("value")).alias("value")), with_views("series", "", "SELECT hru, CASE WHEN month(t) IN (12, 1, 2) THEN 'DJF' WHEN month(t) IN (3, 4, 5) THEN 'MAM' WHEN month(t) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END AS season, round(avg(value), 4) AS value FROM series WHERE source = 'A' GROUP BY ALL"))


def _dates(spark, d) -> DataFrame:
    return views.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("t"))


def _date_query(name, columns, sql):
    QUERIES[name] = (lambda s, d: _dates(s, d).select("o_orderkey", *columns()), f"SELECT o_orderkey, {sql} FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS t FROM orders)")


_date_query("t5_month_start", lambda: [timeaxis.month_start(F.col("t")).alias("m")], "CAST(date_trunc('month', t) AS DATE) AS m")
_date_query("t7_mid_month", lambda: [c.alias(n) for c, n in zip(timeaxis.mid_month(F.col("t")), "mab", strict=True)], "CAST(date_trunc('month', t) AS DATE) + 14 AS m, CAST(date_trunc('month', t) AS DATE) AS a, CAST(date_trunc('month', t) + INTERVAL 1 MONTH AS DATE) AS b")
_date_query("t9_period_ends", lambda: [timeaxis.period_end(F.trunc("t", "month") if k == "month" else F.trunc("t", "year") if k == "year" else F.col("t"), k).alias(k) for k in ("day", "month", "year")], "t + 1 AS day, CAST(date_trunc('month', t) + INTERVAL 1 MONTH AS DATE) AS month, CAST(date_trunc('year', t) + INTERVAL 1 YEAR AS DATE) AS year")
_date_query("t10_month_offset", lambda: [timeaxis.from_month_offset((F.col("o_orderkey") % 1500).cast("int")).alias("m")], "CAST(DATE '1901-01-01' + to_months(CAST(o_orderkey % 1500 AS INT)) AS DATE) AS m")
_date_query("t11_day_tokens", lambda: [timeaxis.from_day_of_year(F.year("t"), F.dayofyear("t")).alias("a"), timeaxis.from_water_year_day(F.year("t"), (F.col("o_orderkey") % 365).cast("int")).alias("b")], "t AS a, make_date(CAST(year(t) - 1 AS INT), 10, 1) + CAST(o_orderkey % 365 AS INT) AS b")
_date_query("t12_mid_year", lambda: [timeaxis.mid_year(F.year("t")).alias("m")], "make_date(CAST(year(t) AS INT), 7, 1) AS m")
_date_query("t13_days_in_month", lambda: [timeaxis.days_in_month(F.col("t")).alias("n")], "CAST(dayofmonth(last_day(t)) AS INT) AS n")
QUERIES["t6_day_floor"] = (lambda s, d: views.table(s, d, "events").select("event_id", timeaxis.day_floor(F.col("ts")).alias("t")), "SELECT event_id, CAST(ts AS DATE) AS t FROM events")


def _period(spark, d):
    r = _dates(spark, d).agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    return timeaxis.parse_period(f"{r['a']}/{r['b']}")


ENDS = "e AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders)"
QUERIES["t2_months_in_period"] = (lambda s, d: timeaxis.months_in_period(s, *_period(s, d)), f"WITH {ENDS} SELECT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month FROM e, generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH) g(m)")
QUERIES["t2_years_in_period"] = (lambda s, d: timeaxis.years_in_period(s, *_period(s, d)), f"WITH {ENDS} SELECT CAST(y AS INT) AS year FROM e, generate_series(year(a), year(b)) g(y)")
QUERIES["t8_spine"] = (
    lambda s, d: timeaxis.spine(s, *_period(s, d), "month").withColumn("step", F.lit("month")).unionByName(timeaxis.spine(s, *_period(s, d), "day").withColumn("step", F.lit("day"))),
    f"WITH {ENDS} SELECT CAST(m AS DATE) AS t, 'month' AS step FROM e, generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH) g(m) WHERE m >= a UNION ALL SELECT CAST(m AS DATE), 'day' FROM e, generate_series(CAST(a AS TIMESTAMP), b, INTERVAL 1 DAY) g(m)",
)


def t4(spark, d):
    p = _dates(spark, d).select("o_orderkey", F.col("t").alias("start"), F.date_add("t", (F.col("o_orderkey") % 900).cast("int")).alias("end"))
    return timeaxis.split_by_year(p).select("o_orderkey", "year", "part_start", "part_end")


QUERIES["t4_split_by_year"] = (t4, "WITH p AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 900 AS INT) AS b FROM orders) SELECT o_orderkey, CAST(y AS INT) AS year, greatest(a, make_date(CAST(y AS INT), 1, 1)) AS part_start, least(b, make_date(CAST(y AS INT), 12, 31)) AS part_end FROM p, LATERAL (SELECT unnest(generate_series(year(a), year(b))) AS y)")


def t3(spark, d):
    p = _dates(spark, d).select("o_orderkey", F.year("t").alias("y"))
    a, b = timeaxis.clamp_period(F.col("y"), F.col("y") + 3, F.lit(1997), F.lit(1999))
    return p.select("o_orderkey", a.alias("first"), b.alias("last"))


QUERIES["t3_clamp_period"] = (t3, "SELECT o_orderkey, CAST(CASE WHEN y <= 1999 AND y + 3 >= 1997 THEN greatest(y, 1997) END AS INT) AS first, CAST(CASE WHEN y <= 1999 AND y + 3 >= 1997 THEN least(y + 3, 1999) END AS INT) AS last FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders)")


def t1(spark, d):
    start, end = timeaxis.parse_period("1997-03-15/1998-06-30")
    return views.table(spark, d, "orders").where(timeaxis.in_period(F.col("o_orderdate"), start, end)).select("o_orderkey")


QUERIES["t1_in_period"] = (t1, "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1997-03-15' AND o_orderdate < DATE '1998-07-01'")


def t14(spark, d):
    s = views.table(spark, d, "supplier")
    text = F.concat(F.lit("Name: "), "s_name", F.lit("\nno pair here\nBalance : "), F.col("s_suppkey").cast("string"), F.lit("\nURL: http://x\nName: last"))
    m = timeaxis.header_map(text)
    return s.select("s_suppkey", m["Name"].alias("name"), m["Balance"].alias("balance"), m["URL"].alias("url"))


QUERIES["t14_header_map"] = (t14, "SELECT s_suppkey, 'last' AS name, CAST(s_suppkey AS VARCHAR) AS balance, 'http://x' AS url FROM supplier")


def s7(spark, d):
    o = _dates(spark, d)
    n = o.select("o_orderkey", "t", F.concat(F.lit("MOD.A"), F.year("t"), F.lpad(F.dayofyear("t").cast("string"), 3, "0"), F.lit(".hdf")).alias("a"), F.concat(F.lit("x_"), F.date_format("t", "yyyyMM"), F.lit("_y.nc")).alias("b"), F.concat(F.lit("SNODAS_"), F.date_format("t", "yyyyMMdd"), F.lit(".tar")).alias("c"), F.concat(F.lit("WY"), F.year("t"), F.lit("_"), F.lpad(((F.year("t") + 1) % 100).cast("string"), 2, "0")).alias("w"), F.concat(F.lit("recharge_"), F.year("t"), F.lit(".tif")).alias("e"), F.concat(F.lit("k_"), F.year("t"), F.lit("_agg.nc")).alias("g"))
    w0, w1 = filenames.water_years(F.col("w"))
    return n.select("o_orderkey", filenames.acquisition_date(F.col("a")).alias("a"), filenames.year_month(F.col("b")).alias("b"), filenames.archive_date(F.col("c")).alias("c"), w0.alias("w0"), w1.alias("w1"), filenames.trailing_year(F.col("e")).alias("e"), filenames.aggregated_year(F.col("g")).alias("g"))


QUERIES["s7_file_names"] = (s7, "SELECT o_orderkey, t AS a, CAST(date_trunc('month', t) AS DATE) AS b, t AS c, CAST(year(t) AS INT) AS w0, CAST(year(t) + 1 AS INT) AS w1, CAST(year(t) AS INT) AS e, CAST(year(t) AS INT) AS g FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS t FROM orders)")


def m_sums(spark, d):
    p = views.pixels(spark, d)
    v = F.col("value")
    return p.groupBy("cell").agg(r4(missing.sum_or_zero(v)).alias("zero"), r4(missing.strict_sum(v)).alias("strict"), r4(missing.ratio(F.sum(v), F.sum("quality"))).alias("ratio"))


QUERIES["m2_m3_missing_sums"] = (m_sums, with_views("pixels", "", "SELECT cell, round(coalesce(sum(value), 0), 4) AS zero, round(CASE WHEN count(value) = count(*) THEN sum(value) END, 4) AS strict, round(CASE WHEN sum(quality) <> 0 THEN sum(value) / sum(quality) END, 4) AS ratio FROM pixels GROUP BY cell"))
QUERIES["p18_difference_of_means"] = (lambda s, d: views.table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("cell")).agg(r4(F.avg("l_quantity") - F.avg(F.col("l_extendedprice") / 1000)).alias("difference")), "SELECT l_partkey AS cell, round(avg(l_quantity) - avg(l_extendedprice / 1000), 4) AS difference FROM lineitem GROUP BY 1")
START, END = dt.date(1996, 1, 1), dt.date(2000, 12, 31)
