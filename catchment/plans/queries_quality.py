"""Diagnostics, checks and set operations as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchment.operators import diagnostics as dg
from catchment.operators import quality as q
from catchment.plans import queries_time, views
from catchment.plans.queries_time import CFS, SPINE, _bounds_sql
from catchment.plans.views import with_views
from catchment.sources import tables

QUERIES: dict = {}


def r4(c):
    """Four digits; the shift keeps exact halves from falling either way. The SQL has the same shift."""
    return F.round(c + 3e-7, 4)


def rounded(df, *names):
    return df.withColumns({n: r4(F.col(n).cast("double")) for n in names})


RUNOFF = _bounds_sql("series meta", f"{SPINE}, {CFS}", "aligned")
B = f"b AS ({RUNOFF})"


def on_bounds(body: str) -> str:
    return f"WITH {B} {body}"


QUERIES["a18_area_weighted_mean"] = (lambda s, d: rounded(dg.area_weighted_mean(views.one(s, d, "A"), views.meta(s, d), area="area_m2"), "mean"), with_views("series meta", "", "SELECT round(sum(value * area_m2) / sum(area_m2), 4) AS mean FROM series JOIN meta USING (hru) WHERE source = 'A'"))
QUERIES["a19_area_weighted_series"] = (lambda s, d: rounded(dg.area_weighted_series(views.one(s, d, "A"), views.meta(s, d), area="area_m2"), "mean"), with_views("series meta", "", "SELECT t, round(sum(value * area_m2) / sum(area_m2), 4) AS mean FROM series JOIN meta USING (hru) WHERE source = 'A' GROUP BY t"))
QUERIES["a21_contributors_per_time"] = (lambda s, d: dg.contributors_per_time(queries_time.e2(s, d), 3), on_bounds("SELECT t, count(*) FILTER (n_sources = 0) AS n_0, count(*) FILTER (n_sources = 1) AS n_1, count(*) FILTER (n_sources = 2) AS n_2, count(*) FILTER (n_sources = 3) AS n_3 FROM b GROUP BY t"))


def cover(spark, d):
    return views.daily(spark, d).select("hru", "t", "value", (F.col("hru") / 25.0).cast("double").alias("vaf"))


def _cover_summary(spark, d):
    return dg.coverage_by_day(cover(spark, d), "value", 50.0, "vaf", 0.4)


COVER = "c AS (SELECT t, count(value) AS n_finite, count(*) FILTER (value > 50) AS n_above, count(*) FILTER (hru / 25.0 >= 0.4) AS n_covered, count(*) FILTER (value > 50 AND hru / 25.0 >= 0.4) AS n_overlap FROM daily GROUP BY t)"
QUERIES["a22_coverage_by_day"] = (_cover_summary, with_views("daily", COVER, "SELECT * FROM c"))
QUERIES["o3_best_day"] = (lambda s, d: dg.best_day(_cover_summary(s, d), month=1), with_views("daily", COVER, "SELECT * FROM c WHERE month(t) = 1 ORDER BY n_overlap DESC, t LIMIT 1"))
QUERIES["a23_missing_count"] = (lambda s, d: rounded(dg.missing_count(views.pixels(s, d)), "missing_share"), with_views("pixels", "", "SELECT count(*) FILTER (value IS NULL) AS n_missing, round(count(*) FILTER (value IS NULL) / count(*), 4) AS missing_share FROM pixels"))
QUERIES["a25_percentiles"] = (lambda s, d: rounded(dg.percentiles(views.series(s, d), ["source"], [0.02, 0.95, 0.98]), "p2", "p95", "p98"), with_views("series", "", "SELECT source, round(quantile_cont(value, 0.02), 4) AS p2, round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.98), 4) AS p98 FROM series GROUP BY source"))
QUERIES["a26_histogram"] = (lambda s, d: rounded(dg.histogram(views.series(s, d), "source"), "density"), with_views("series", "l AS (SELECT source, min(value) AS lo, max(value) AS hi, count(value) AS a FROM series GROUP BY 1), k AS (SELECT source, lo, hi, a, CAST(least(floor((value - lo) / (hi - lo) * 60) + 1, 60) AS INT) AS bin FROM series JOIN l USING (source) WHERE hi > lo)", "SELECT source, bin, count(*) AS n, round(count(*) / (a * (hi - lo) / 60), 4) AS density FROM k GROUP BY source, bin, a, hi, lo"))
QUERIES["a27_describe"] = (lambda s, d: rounded(dg.describe(views.series(s, d), "value"), "mean", "std", "min", "p25", "p50", "p75", "max", "total"), with_views("series", "", "SELECT count(value) AS n, round(avg(value), 4) AS mean, round(stddev(value), 4) AS std, round(min(value), 4) AS min, round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.75), 4) AS p75, round(max(value), 4) AS max, round(sum(value), 4) AS total FROM series"))
QUERIES["a28_granules_by_token"] = (lambda s, d: dg.granules_by(views.table(s, d, "pages").select(F.regexp_extract("url", r"://([^/]+)/", 1).alias("host"), F.col("url").alias("path")), "host").select("host", F.concat_ws("|", "paths").alias("paths")), "SELECT regexp_extract(url, '://([^/]+)/', 1) AS host, string_agg(url, '|' ORDER BY url) AS paths FROM pages GROUP BY 1")
QUERIES["a29_mean_over_time"] = (lambda s, d: rounded(dg.mean_over_time(views.pixels(s, d), ["cell"]), "value"), with_views("pixels", "", "SELECT cell, round(avg(value), 4) AS value FROM pixels GROUP BY cell"))
QUERIES["a30_mean_over_space"] = (lambda s, d: rounded(dg.mean_over_space(views.pixels(s, d)), "value"), with_views("pixels", "", "SELECT t, round(avg(value), 4) AS value FROM pixels GROUP BY t"))
QUERIES["a31_climatology"] = (lambda s, d: rounded(dg.climatology(views.pixels(s, d)), "value"), with_views("pixels", "", "SELECT CAST(month(t) AS INT) AS month, round(avg(value), 4) AS value FROM pixels GROUP BY 1"))
QUERIES["a32_field_statistics"] = (lambda s, d: rounded(dg.field_statistics(views.pixels(s, d), "value", 40.0), "least", "greatest", "mean", "missing_share", "p99"), with_views("pixels", "", "SELECT round(min(value), 4) AS least, round(max(value), 4) AS greatest, round(avg(value), 4) AS mean, round(count(*) FILTER (value IS NULL) / count(*), 4) AS missing_share, round(quantile_cont(value, 0.99), 4) AS p99, count(*) FILTER (value > 40) AS n_above FROM pixels"))


def a33(spark, d):
    labels = spark.createDataFrame([(0.0, "best"), (10.0, "good"), (20.0, "fair")], "quality double, label string")
    return rounded(dg.category_shares(views.pixels(spark, d), "quality", labels), "percent")


QUERIES["a33_category_shares"] = (a33, with_views("pixels", "", "SELECT quality, CASE quality WHEN 0 THEN 'best' WHEN 10 THEN 'good' WHEN 20 THEN 'fair' ELSE 'Unknown' END AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS percent FROM pixels GROUP BY quality"))
QUERIES["j12_code_labels"] = QUERIES["a33_category_shares"]
QUERIES["a34_side_by_side"] = (lambda s, d: rounded(dg.side_by_side(views.one(s, d, "A"), views.one(s, d, "C")), "a", "b"), with_views("series", "", "SELECT t, round(avg(value) FILTER (source = 'A'), 4) AS a, round(avg(value) FILTER (source = 'C'), 4) AS b FROM series GROUP BY t HAVING count(*) FILTER (source = 'A') > 0 AND count(*) FILTER (source = 'C') > 0"))
QUERIES["a35_peak"] = (lambda s, d: rounded(dg.peak(dg.mean_over_space(views.one(s, d, "A"))), "value"), with_views("series", "", "SELECT t, round(avg(value), 4) AS value FROM series WHERE source = 'A' GROUP BY t ORDER BY avg(value) DESC, t LIMIT 1"))
QUERIES["a36_period_of"] = (lambda s, d: dg.period_of(views.pixels(s, d)), with_views("pixels", "", "SELECT min(t) AS first, max(t) AS last FROM pixels"))
QUERIES["q1_missing_variables"] = (lambda s, d: q.missing_variables(views.table(s, d, "events").select(F.col("event_type").alias("var")), s.createDataFrame([("click",), ("scroll",)], "var string")), "SELECT 'scroll' AS var WHERE 'scroll' NOT IN (SELECT event_type FROM events)")
QUERIES["q2_grid_shapes"] = (lambda s, d: q.grid_shapes(views.pixels(s, d).select(F.year("t").alias("file"), (F.col("cell") % 10).alias("iy"), (F.col("cell") % 12).alias("ix"))), "SELECT a AS n_iy, b AS n_ix, count(*) AS n_files FROM (SELECT year(l_shipdate), max(l_partkey % 10) + 1 AS a, max(l_partkey % 12) + 1 AS b FROM lineitem GROUP BY 1) GROUP BY 1, 2")


def q3(spark, d):
    h = views.table(spark, d, "supplier").select(F.col("s_suppkey").alias("day"), F.lit(100).alias("rows"), (F.lit(200) + F.when(F.col("s_suppkey") % 17 == 5, 1).otherwise(0)).alias("columns"), (F.lit(-124.0) + (F.col("s_suppkey") % 4) * 0.002).alias("min_x"), F.lit(52.0).alias("max_y"))
    return rounded(q.grid_drift(h).select("day", "drift", "state"), "drift")


QUERIES["q3_grid_drift"] = (q3, "SELECT s_suppkey AS day, round((s_suppkey % 4) * 0.002::DOUBLE, 4) AS drift, CASE WHEN s_suppkey % 17 = 5 THEN 'broken' WHEN s_suppkey % 4 = 0 THEN 'same' WHEN s_suppkey % 4 <= 2 THEN 'accepted' ELSE 'broken' END AS state FROM supplier")
QUERIES["q4_set_difference"] = (lambda s, d: q.set_difference(views.table(s, d, "customer").select(F.col("c_custkey").alias("hru")), views.table(s, d, "orders").select((F.col("o_custkey") + 5).alias("hru")), "hru"), "SELECT c_custkey AS hru, 'left' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey + 5 FROM orders) UNION ALL SELECT DISTINCT o_custkey + 5, 'right' FROM orders WHERE o_custkey + 5 NOT IN (SELECT c_custkey FROM customer)")
QUERIES["u3_set_difference"] = QUERIES["q4_set_difference"]
QUERIES["q5_repeated"] = (lambda s, d: q.repeated(views.table(s, d, "orders"), "o_custkey"), "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")


def q6(spark, d):
    f = views.pixels(spark, d).groupBy((F.year("t") + F.when(F.year("t") % 3 == 0, 100).otherwise(0)).alias("year"), F.when(F.year("t") % 2 == 0, F.col("cell") % 2).otherwise(0).alias("file")).agg(F.count("value").alias("n_rows"))
    return q.year_coverage(f, 1994, 2001)


QUERIES["q6_year_coverage"] = (q6, with_views("pixels", "", "SELECT CAST(y AS INT) AS year, CASE WHEN y % 3 = 0 OR y NOT IN (SELECT year(t) FROM pixels) THEN 'missing' ELSE 'overlap' END AS state FROM generate_series(1994, 2001) g(y) WHERE y % 3 = 0 OR y NOT IN (SELECT year(t) FROM pixels) OR y % 2 = 0"))
QUERIES["q7_months_outside"] = (lambda s, d: q.months_outside(views.pixels(s, d), 1998, 6), with_views("pixels", "", "SELECT CAST(year(t) AS INT) AS year, CAST(month(t) AS INT) AS month, count(*) AS n FROM pixels WHERE NOT (year(t) = 1998 AND month(t) = 6) GROUP BY ALL"))
QUERIES["q8_days_not_once"] = (lambda s, d: q.days_not_once(views.pixels(s, d), 1998), with_views("pixels", "k AS (SELECT t, count(*) AS n FROM pixels GROUP BY t)", "SELECT CAST(m AS DATE) AS t, coalesce(n, 0) AS n FROM generate_series(TIMESTAMP '1998-01-01', TIMESTAMP '1998-12-31', INTERVAL 1 DAY) g(m) LEFT JOIN k ON k.t = m WHERE coalesce(n, 0) <> 1"))


def q9(spark, d):
    p = views.table(spark, d, "part").select(F.col("p_brand").alias("source"), F.col("p_type").alias("var"), F.when(F.col("p_size") > 25, "mm").when(F.col("p_size") > 5, "m").alias("cf_units"), F.lit("mm").alias("units"), "p_partkey")
    return q.unit_mismatches(p.select(F.col("p_partkey").cast("string").alias("source"), "var", "units"), p.select(F.col("p_partkey").cast("string").alias("source"), "var", "cf_units"))


QUERIES["q9_unit_mismatches"] = (q9, "SELECT CAST(p_partkey AS VARCHAR) AS source, p_type AS var, 'mm' AS units, CASE WHEN p_size > 5 THEN 'm' END AS cf_units FROM part WHERE p_size <= 25")
QUERIES["q10_unknown_sources"] = (lambda s, d: q.unknown_sources(views.table(s, d, "orders").groupBy(F.col("o_orderpriority").alias("target")).agg(F.collect_set(F.col("o_custkey") % 40).alias("sources")), views.table(s, d, "customer").where("c_custkey % 40 < 30").select((F.col("c_custkey") % 40).alias("source"))), "SELECT DISTINCT o_orderpriority AS target, o_custkey % 40 AS source FROM orders WHERE o_custkey % 40 NOT IN (SELECT c_custkey % 40 FROM customer WHERE c_custkey % 40 < 30)")
QUERIES["q11_method_differences"] = (lambda s, d: q.method_differences(views.table(s, d, "part").select(F.col("p_partkey").alias("var"), F.lit("time: sum").alias("cell_methods")), views.table(s, d, "part").where("p_size <> 1").select(F.col("p_partkey").alias("var"), F.when(F.col("p_size") > 40, "time: point").otherwise("time: sum").alias("cell_methods"))), "SELECT p_partkey AS var, CASE WHEN p_size = 1 THEN 'missing' ELSE 'differs' END AS state FROM part WHERE p_size = 1 OR p_size > 40")
QUERIES["q12_low_coverage"] = (lambda s, d: rounded(q.low_coverage(views.pixels(s, d).withColumn("valid_area_fraction", F.when(F.col("value") > 5 * (F.year("t") - 1994), 1.0).otherwise(0.0)), 0.3), "zero_share"), with_views("pixels", "", "SELECT CAST(year(t) AS INT) AS year, round(count(*) FILTER (value IS NULL OR value <= 5 * (year(t) - 1994)) / count(*), 4) AS zero_share FROM pixels GROUP BY 1 HAVING count(*) FILTER (value IS NULL OR value <= 5 * (year(t) - 1994)) / count(*) > 0.3"))
QUERIES["q13_empty_share"] = (lambda s, d: rounded(q.empty_share(queries_time.e2(s, d)), "empty_share"), on_bounds("SELECT count(*) FILTER (n_sources = 0) AS n_empty, count(*) AS n_rows, round(count(*) FILTER (n_sources = 0) / count(*), 4) AS empty_share FROM b"))
QUERIES["q14_bound_invariants"] = (lambda s, d: rounded(q.bound_invariants(queries_time.e2(s, d)), "least", "greatest"), on_bounds("SELECT bool_and(coalesce(lower_bound <= upper_bound, true)) AS ordered, bool_and(coalesce(lower_bound >= 0 AND upper_bound <= 1, true)) AS in_unit_range, round(min(lower_bound), 4) AS least, round(max(upper_bound), 4) AS greatest FROM b"))
QUERIES["q15_percent_difference"] = (lambda s, d: rounded(q.percent_difference(views.one(s, d, "A"), views.one(s, d, "C"), "hru"), "a", "b", "pct"), with_views("series", "m AS (SELECT hru, avg(value) FILTER (source = 'A') AS a, avg(value) FILTER (source = 'C') AS b FROM series GROUP BY hru)", "SELECT hru, round(a, 4) AS a, round(b, 4) AS b, round(100 * (b - a) / a, 4) AS pct FROM m"))
QUERIES["q16_magnitude_ratio"] = (lambda s, d: rounded(q.magnitude_ratio(views.one(s, d, "A"), 1234.5), "total", "ratio"), with_views("series", "", "SELECT round(sum(value), 4) AS total, round(sum(value) / 1234.5, 4) AS ratio FROM series WHERE source = 'A'"))


def q18(spark, d):
    from catchment.operators.nnfill import fill

    raw = queries_time.gappy(spark, d)
    return rounded(q.fill_effect(raw, fill(raw, views.centroids(spark, d), 3, 0.02)), "fill_rate")


QUERIES["q18_fill_effect"] = (q18, with_views("centroids", f"{queries_time.GAPPY}, got AS (SELECT DISTINCT g.hru, g.t FROM gappy g JOIN near n ON g.hru = n.hru JOIN gappy o ON o.hru = n.donor AND o.t = g.t WHERE g.lower_bound IS NULL AND o.lower_bound IS NOT NULL)", "SELECT (SELECT count(*) FROM gappy WHERE lower_bound IS NULL) AS n_gaps, (SELECT count(*) FROM got) AS n_filled, CAST(0 AS BIGINT) AS n_changed, round((SELECT count(*) FROM got) / (SELECT count(*) FROM gappy WHERE lower_bound IS NULL), 4) AS fill_rate"))
QUERIES["q19_superseded"] = (lambda s, d: q.superseded(views.table(s, d, "orders").select(F.col("o_custkey").alias("source")).distinct(), views.table(s, d, "customer").select(F.col("c_custkey").alias("source"), F.when(F.col("c_custkey") % 4 == 0, "superseded").otherwise("current").alias("status"), (F.col("c_custkey") + 1).alias("replaced_by"))), "SELECT c_custkey AS source, c_custkey + 1 AS replaced_by FROM customer WHERE c_custkey % 4 = 0 AND c_custkey IN (SELECT o_custkey FROM orders)")


def q20(spark, d):
    from catchment.operators.geometry import extent

    box = extent(views.boxes(spark, d))
    grid = views.boxes(spark, d).select((F.col("x0") - 1).alias("w"), (F.col("y0") - 1).alias("s"), (F.col("x0") + 1.5).alias("e"), (F.col("y0") + 3).alias("n"))
    return rounded(q.enclosure(grid, box), "west", "south", "east", "north")


QUERIES["q20_enclosure"] = (q20, "SELECT 1.0::DOUBLE AS west, 1.0::DOUBLE AS south, -0.2::DOUBLE AS east, 1.3::DOUBLE AS north, false AS encloses")
QUERIES["w7_order_breaks"] = (lambda s, d: q.order_breaks(views.table(s, d, "customer"), "c_custkey", "c_nationkey", 100), "SELECT count(*) AS n_breaks FROM (SELECT c_nationkey - lag(c_nationkey) OVER (ORDER BY c_custkey) AS x FROM customer) WHERE x < 0")
QUERIES["u1_concat"] = (lambda s, d: rounded(tables.concat_granules([views.pixels(s, d).where(c).select(F.col("cell").alias("iy"), (F.col("cell") % 3).alias("ix"), "t", "value") for c in ("cell % 2 = 0", "cell % 2 = 1")], ["value"]).groupBy("ix").agg(F.count("*").alias("n"), F.sum("value").alias("total")), "total"), with_views("pixels", "", "SELECT cell % 3 AS ix, count(*) AS n, round(sum(value), 4) AS total FROM pixels GROUP BY 1"))
QUERIES["s6_merge_groups"] = (lambda s, d: rounded(tables.merge_groups([views.one(s, d, x).withColumnRenamed("value", x.lower()) for x in "AC"], ("hru", "t")), "a", "c"), with_views("series", "", "SELECT hru, t, round(max(value) FILTER (source = 'A'), 4) AS a, round(max(value) FILTER (source = 'C'), 4) AS c FROM series WHERE source IN ('A', 'C') GROUP BY ALL"))
QUERIES["s10_undone"] = (lambda s, d: tables.undone(views.table(s, d, "customer").select(F.col("c_custkey").alias("k")), views.table(s, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")), ["k"]), "SELECT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
QUERIES["j9_semi_anti"] = QUERIES["s10_undone"]
QUERIES["s16_stale"] = (lambda s, d: tables.stale(views.table(s, d, "lineitem").select(F.col("l_orderkey").alias("year"), F.col("l_shipdate").alias("modified")), views.table(s, d, "orders").where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("year"), (F.col("o_orderdate") + F.expr("interval 1000 day")).alias("modified"))), "SELECT year FROM (SELECT l_orderkey AS year, max(l_shipdate) AS i FROM lineitem GROUP BY 1) LEFT JOIN (SELECT o_orderkey AS year, o_orderdate + INTERVAL 1000 DAY AS o FROM orders WHERE o_orderkey % 5 <> 0) USING (year) WHERE o IS NULL OR i > o")
QUERIES["u4_unmatched_years"] = (lambda s, d: q.unmatched_years(views.pixels(s, d).select(F.year("t").alias("year")), views.table(s, d, "orders").where("year(o_orderdate) > 1996").select(F.year("o_orderdate").alias("year"))), "SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS year, 'left' AS side FROM lineitem WHERE year(l_shipdate) NOT IN (SELECT year(o_orderdate) FROM orders WHERE year(o_orderdate) > 1996) UNION ALL SELECT DISTINCT CAST(year(o_orderdate) AS INT), 'right' FROM orders WHERE year(o_orderdate) > 1996 AND year(o_orderdate) NOT IN (SELECT year(l_shipdate) FROM lineitem)")
QUERIES["u5_output_union"] = (lambda s, d: views.table(s, d, "orders").groupBy("o_custkey").agg(F.concat_ws(",", F.array_sort(F.array_union(F.collect_set("o_orderstatus"), F.collect_set(F.substring("o_orderpriority", 1, 1))))).alias("files")), "SELECT o_custkey, string_agg(x, ',' ORDER BY x) AS files FROM (SELECT o_custkey, o_orderstatus AS x FROM orders UNION SELECT o_custkey, o_orderpriority[1] FROM orders) GROUP BY 1")
