"""Resampling, normalization, bounds and the target products as queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catchment.functions import masks
from catchment.functions.timeaxis import spine
from catchment.operators import bounds, diagnostics, nnfill, normalize, temporal
from catchment.plans import pipelines, views
from catchment.plans.targets import aet, recharge, runoff, soil_moisture, swe
from catchment.plans.views import with_views

QUERIES: dict = {}
PERIOD = (dt.date(1996, 1, 1), dt.date(2000, 12, 31))
WINDOW = (dt.date(1997, 1, 1), dt.date(1998, 12, 31))
JANUARY = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
DAYS = "dayofmonth(last_day(t))"


def r4(c):
    """Four digits; the shift keeps exact halves from falling either way. The SQL has the same shift."""
    return F.round(c + 3e-7, 4)


def rounded(df, *names):
    return df.withColumns({n: r4(F.col(n).cast("double")) for n in names})


INC = """steps AS (SELECT *, row_number() OVER w AS n, value - lag(value) OVER w AS d FROM hourly WINDOW w AS (PARTITION BY hru ORDER BY ts)),
    inc AS (SELECT hru, ts, CASE WHEN d >= 0 THEN d ELSE value END AS value FROM steps WHERE n > 1),
    days AS (SELECT hru, CAST(ts - INTERVAL 1 HOUR AS DATE) AS t, coalesce(sum(value), 0) AS value FROM inc GROUP BY ALL)"""
QUERIES["w5_increments"] = (lambda s, d: rounded(temporal.increments(views.hourly(s, d), ["hru"]), "value"), with_views("hourly", INC, "SELECT hru, ts, round(value, 4) AS value FROM inc"))
QUERIES["a10_hourly_to_daily"] = (lambda s, d: rounded(temporal.hourly_to_daily(views.hourly(s, d), ["hru"]), "value"), with_views("hourly", INC, "SELECT hru, t, round(value, 4) AS value FROM days"))
QUERIES["a11_hourly_mean"] = (lambda s, d: rounded(temporal.hourly_mean(views.hourly(s, d), ["hru"]), "value"), with_views("hourly", "", "SELECT hru, CAST(ts AS DATE) AS t, round(avg(value), 4) AS value FROM hourly GROUP BY ALL"))
QUERIES["a12_daily_to_monthly"] = (
    lambda s, d: rounded(temporal.daily_to_monthly(views.daily(s, d), ["source", "hru"], "sum").withColumn("kind", F.lit("sum")).unionByName(temporal.daily_to_monthly(views.daily(s, d), ["source", "hru"], "point").withColumn("kind", F.lit("point"))), "value"),
    with_views("daily", "", "SELECT source, hru, last_day(t) AS t, round(coalesce(sum(value), 0), 4) AS value, 'sum' AS kind FROM daily GROUP BY ALL UNION ALL SELECT source, hru, last_day(t), round(avg(value), 4), 'point' FROM daily GROUP BY ALL"),
)


def a13(spark, d):
    catalog = spark.createDataFrame([("click", "time: sum"), ("view", "time: point"), ("error", "time: sum")], "var string, cell_methods string")
    return rounded(temporal.daily_to_monthly_by_catalog(views.daily(spark, d).withColumnRenamed("source", "var"), catalog, ["hru"]), "value")


QUERIES["a13_reducer_from_catalog"] = (a13, with_views("daily", "", "SELECT hru, var, t, round(CASE WHEN var = 'view' THEN m ELSE s END, 4) AS value FROM (SELECT hru, source AS var, last_day(t) AS t, avg(value) AS m, coalesce(sum(value), 0) AS s FROM daily WHERE source IN ('click', 'view', 'error') GROUP BY ALL)"))


def a14(spark, d):
    h = views.table(spark, d, "events").groupBy(F.col("event_type").alias("var"), (F.col("user_id") % 25).alias("hru"), F.date_trunc("hour", "ts").alias("ts")).agg(F.max("value").alias("value"))
    return rounded(pipelines.hourly_archive(h, {"click": "sum", "view": "point"}, ["hru"])[1], "value")


QUERIES["a14_hourly_archive"] = (a14, """WITH h AS (SELECT event_type AS var, user_id % 25 AS hru, date_trunc('hour', ts) AS ts, max(value) AS value FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL),
    s AS (SELECT *, row_number() OVER w AS n, value - lag(value) OVER w AS d FROM h WINDOW w AS (PARTITION BY var, hru ORDER BY ts)),
    days AS (SELECT var, hru, CAST(ts - INTERVAL 1 HOUR AS DATE) AS t, sum(CASE WHEN d >= 0 THEN d ELSE value END) AS value FROM s WHERE n > 1 AND var = 'click' GROUP BY ALL
        UNION ALL SELECT var, hru, CAST(ts AS DATE), avg(value) FROM h WHERE var = 'view' GROUP BY ALL)
    SELECT hru, var, t, round(CASE WHEN var = 'click' THEN s ELSE m END, 4) AS value FROM (SELECT hru, var, last_day(t) AS t, sum(value) AS s, avg(value) AS m FROM days GROUP BY ALL)""")
QUERIES["a15_annual"] = (
    lambda s, d: rounded(temporal.annual(views.series(s, d), ["source", "hru"]).withColumn("kind", F.lit("sum")).unionByName(temporal.annual(views.series(s, d), ["source", "hru"], "mean").withColumn("kind", F.lit("mean"))), "value"),
    with_views("series", "", "SELECT source, hru, CAST(date_trunc('year', t) AS DATE) AS t, round(sum(value), 4) AS value, 'sum' AS kind FROM series GROUP BY ALL UNION ALL SELECT source, hru, CAST(date_trunc('year', t) AS DATE), round(avg(value), 4), 'mean' FROM series GROUP BY ALL"),
)
MONTHLY = """c AS (SELECT *, least(t + 8, make_date(CAST(year(t) + 1 AS INT), 1, 1)) AS e FROM composites),
    m AS (SELECT hru, t, e, value, CAST(g.m AS DATE) AS m FROM c, LATERAL (SELECT unnest(generate_series(CAST(date_trunc('month', t) AS TIMESTAMP), CAST(e - 1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS m) g),
    span AS (SELECT hru, min(t) AS a, max(e) AS b FROM c GROUP BY hru),
    mm AS (SELECT hru, m AS t, CASE WHEN count(value) = count(*) THEN sum(value * date_diff('day', greatest(t, m), least(e, CAST(m + INTERVAL 1 MONTH AS DATE))) / date_diff('day', t, e)) END AS value FROM m GROUP BY hru, m),
    monthly AS (SELECT hru, t, value FROM mm JOIN span USING (hru) WHERE t >= a AND CAST(t + INTERVAL 1 MONTH AS DATE) <= b)"""
QUERIES["a16_composites_to_monthly"] = (lambda s, d: rounded(temporal.composites_to_monthly(views.composites(s, d), ["hru"]), "value"), with_views("composites", MONTHLY, "SELECT hru, t, round(value, 4) AS value FROM monthly"))
QUERIES["a17_composites_in_month"] = (lambda s, d: rounded(temporal.composites_in_month(views.composites(s, d), ["hru"], 1998, 3), "value"), with_views("composites", MONTHLY, "SELECT hru, round(CASE WHEN count(value) = count(*) THEN sum(value * date_diff('day', greatest(t, m), least(e, DATE '1998-04-01')) / date_diff('day', t, e)) END, 4) AS value, m AS t FROM m WHERE m = DATE '1998-03-01' GROUP BY hru, m"))


def _normal(name, sql_keys, sql_where, **how):
    keys = ["source", "hru"]
    lim = f"lim AS (SELECT {sql_keys}, min(value) AS lo, max(value) AS hi FROM k {sql_where} GROUP BY ALL), k AS (SELECT *, month(t) AS mo FROM series)"
    lim = f"k AS (SELECT *, month(t) AS mo FROM series), lim AS (SELECT {sql_keys}, min(value) AS lo, max(value) AS hi FROM k {sql_where} GROUP BY ALL)"
    QUERIES[name] = (lambda s, d: rounded(normalize.normalize(views.series(s, d), keys, **how), "value"), with_views("series", lim, f"SELECT source, hru, t, round(CASE WHEN hi > lo THEN (value - lo) / (hi - lo) END, 4) AS value FROM k LEFT JOIN lim USING ({sql_keys})"))


IN_WINDOW = "WHERE t >= DATE '1997-01-01' AND t < DATE '1999-01-01'"
_normal("w1_normalize", "source, hru", "")
_normal("w2_normalize_by_month", "source, hru, mo", "", monthly=True)
_normal("w3_normalize_over_window", "source, hru", IN_WINDOW, window=WINDOW)
_normal("w4_normalize_by_month_over_window", "source, hru, mo", IN_WINDOW, window=WINDOW, monthly=True)
SPINE = "months AS (SELECT CAST(m AS DATE) AS t FROM generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-12-31', INTERVAL 1 MONTH) g(m)), ids AS (SELECT DISTINCT hru FROM meta)"
QUERIES["j3_align"] = (lambda s, d: rounded(bounds.align(views.one(s, d, "C"), spine(s, *PERIOD, "month"), views.meta(s, d)), "value"), with_views("series meta", SPINE, "SELECT hru, t, round(value, 4) AS value FROM ids CROSS JOIN months LEFT JOIN (SELECT * FROM series WHERE source = 'C') USING (hru, t)"))
BOUNDS = "SELECT hru, t, {lo} AS lower_bound, {up} AS upper_bound, CAST(count(value) AS TINYINT) AS n_sources FROM {of} GROUP BY hru, t"


def _bounds_sql(views_, more, of):
    return with_views(views_, more, BOUNDS.format(lo="round(min(value), 4)", up="round(max(value), 4)", of=of))


QUERIES["a9_multi_source_bounds"] = (lambda s, d: rounded(bounds.multi_source_bounds([views.one(s, d, x) for x in "ABC"]), "lower_bound", "upper_bound"), _bounds_sql("series", "", "series"))
CFS = f"""mm AS (SELECT source, hru, t, CASE source WHEN 'A' THEN value / 1000 * 1000 WHEN 'B' THEN value * 8 * {DAYS} ELSE value END AS mm FROM series WHERE t >= DATE '1996-01-01' AND t <= DATE '2000-12-31'),
    cfs AS (SELECT source, hru, t, mm / 1000 / {DAYS} * area_m2 * 35.3146667 / 86400 AS value FROM mm JOIN meta USING (hru)),
    sources AS (SELECT unnest(['A', 'B', 'C']) AS source),
    aligned AS (SELECT hru, t, value FROM ids CROSS JOIN months CROSS JOIN sources LEFT JOIN cfs USING (source, hru, t))"""


def e2(spark, d):
    a = views.one(spark, d, "A").withColumn("value", F.col("value") / 1000)
    out = runoff.build({"era5": a, "gldas": views.one(spark, d, "B"), "mwbm": views.one(spark, d, "C")}, views.meta(spark, d), PERIOD)
    return rounded(out, "lower_bound", "upper_bound")


QUERIES["e2_runoff_bounds"] = (e2, _bounds_sql("series meta", f"{SPINE}, {CFS}", "aligned"))


def e3(spark, d):
    return rounded(aet.build({"mod16": views.composites(spark, d), "ssebop": views.one(spark, d, "B"), "mwbm": views.one(spark, d, "C")}, views.meta(spark, d), PERIOD), "lower_bound", "upper_bound")


QUERIES["e3_aet_bounds"] = (e3, _bounds_sql("series composites meta", f"""{SPINE}, {MONTHLY},
    every AS (SELECT 'A' AS source, hru, t, value FROM monthly UNION ALL SELECT source, hru, t, value FROM series WHERE source IN ('B', 'C')),
    inch AS (SELECT source, hru, t, value / 25.4 / {DAYS} AS value FROM every), sources AS (SELECT unnest(['A', 'B', 'C']) AS source),
    aligned AS (SELECT hru, t, value FROM ids CROSS JOIN months CROSS JOIN sources LEFT JOIN inch USING (source, hru, t))""", "aligned"))
ANNUAL = f"""mm AS (SELECT source, hru, t, CASE source WHEN 'B' THEN value * {DAYS} * 86400 ELSE value * 1000 END AS value FROM series WHERE t >= DATE '1996-01-01' AND t <= DATE '2000-12-31'),
    y AS (SELECT source, hru, CAST(date_trunc('year', t) AS DATE) AS t, sum(value) AS value FROM mm GROUP BY ALL),
    lim AS (SELECT source, hru, min(value) AS lo, max(value) AS hi FROM y {IN_WINDOW} GROUP BY ALL),
    scaled AS (SELECT source, hru, t, CASE WHEN hi > lo THEN (value - lo) / (hi - lo) END AS value FROM y LEFT JOIN lim USING (source, hru)),
    years AS (SELECT CAST(m AS DATE) AS t FROM generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-12-31', INTERVAL 1 YEAR) g(m)), sources AS (SELECT unnest(['A', 'B', 'C']) AS source),
    aligned AS (SELECT hru, t, value FROM ids CROSS JOIN years CROSS JOIN sources LEFT JOIN scaled USING (source, hru, t))"""


def e4(spark, d):
    x = views.by_source(spark, d)
    out = recharge.build({"reitz": x["A"], "watergap": x["B"], "era5": x["C"]}, views.meta(spark, d), PERIOD, WINDOW)
    return rounded(out, "lower_bound", "upper_bound")


QUERIES["e4_recharge_bounds"] = (e4, _bounds_sql("series meta", f"{SPINE}, {ANNUAL}", "aligned"))


def _soil(k):
    def run(spark, d):
        out = soil_moisture.build(views.by_source(spark, d), views.meta(spark, d), PERIOD, WINDOW)[k]
        return rounded(out, "lower_bound", "upper_bound")

    return run


SOIL = f"""k AS (SELECT *, month(t) AS mo FROM series WHERE t >= DATE '1996-01-01' AND t <= DATE '2000-12-31'), lim AS (SELECT source, hru, mo, min(value) AS lo, max(value) AS hi FROM k {IN_WINDOW} GROUP BY ALL),
    scaled AS (SELECT source, hru, t, CASE WHEN hi > lo THEN (value - lo) / (hi - lo) END AS value FROM k LEFT JOIN lim USING (source, hru, mo)), sources AS (SELECT unnest(['A', 'B', 'C']) AS source),
    aligned AS (SELECT hru, t, value FROM ids CROSS JOIN months CROSS JOIN sources LEFT JOIN scaled USING (source, hru, t))"""
QUERIES["e5_soil_moisture_monthly"] = (_soil(0), _bounds_sql("series meta", f"{SPINE}, {SOIL}", "aligned"))
QUERIES["e5_soil_moisture_annual"] = (_soil(1), _bounds_sql("series meta", f"{SPINE}, {ANNUAL}".replace(f"CASE source WHEN 'B' THEN value * {DAYS} * 86400 ELSE value * 1000 END", "value").replace("sum(value) AS value FROM mm", "avg(value) AS value FROM mm"), "aligned"))


def e6(spark, d):
    day = views.daily(spark, d)
    take = lambda x: day.where(F.col("source") == x).drop("source")
    out = swe.build({"daymet": take("click"), "snodas": take("view"), "era5": take("error"), "margulis": take("signup")}, day.select("hru").distinct(), JANUARY)
    return rounded(out, "lower_bound", "upper_bound")


QUERIES["e6_swe_bounds"] = (e6, _bounds_sql("daily", """inch AS (SELECT source, hru, t, CASE WHEN source = 'error' THEN value * 1000 ELSE value END / 25.4 AS value FROM daily), sources AS (SELECT unnest(['click', 'view', 'error']) AS source),
    days AS (SELECT CAST(m AS DATE) AS t FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) g(m)),
    aligned AS (SELECT hru, t, value FROM (SELECT DISTINCT hru FROM daily) CROSS JOIN days CROSS JOIN sources LEFT JOIN inch USING (source, hru, t))""", "aligned"))
QUERIES["f16_agreeing"] = (lambda s, d: masks.agreeing(e2(s, d), 3), with_views("series meta", f"{SPINE}, {CFS}, b AS ({BOUNDS.format(lo='round(min(value), 4)', up='round(max(value), 4)', of='aligned')})", "SELECT * FROM b WHERE n_sources >= 3"))


def gappy(spark, d):
    """Bounds of the embedding points at four times; every fifth point has none."""
    c = views.centroids(spark, d)
    t = F.explode(F.sequence(F.lit("2000-01-01").cast("date"), F.lit("2000-04-01").cast("date"), F.expr("interval 1 month"))).alias("t")
    v = F.when((F.col("hru") + F.month("t")) % 5 != 0, (F.col("hru") * 10 + F.month("t")).cast("double"))
    return c.select("hru", t).select("hru", "t", v.alias("lower_bound"), (v + 1).alias("upper_bound"), F.when(v.isNull(), 0).otherwise(2).cast("tinyint").alias("n_sources"))


GAPPY = """gappy AS (SELECT hru, t, CASE WHEN (hru + month(t)) % 5 <> 0 THEN CAST(hru * 10 + month(t) AS DOUBLE) END AS lower_bound, CAST(CASE WHEN (hru + month(t)) % 5 <> 0 THEN 2 ELSE 0 END AS TINYINT) AS n_sources FROM centroids, (SELECT unnest([DATE '2000-01-01', DATE '2000-02-01', DATE '2000-03-01', DATE '2000-04-01']) AS t)),
    near AS (SELECT * FROM (SELECT a.hru, b.hru AS donor, row_number() OVER (PARTITION BY a.hru ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.hru) AS rank FROM centroids a JOIN centroids b ON a.hru <> b.hru) WHERE rank <= 3)"""
QUERIES["j7_nearest"] = (lambda s, d: nnfill.nearest(views.centroids(s, d).select("hru"), views.centroids(s, d), 3, 0.02).withColumn("rank", F.col("rank").cast("long")), with_views("centroids", GAPPY, "SELECT hru, donor, rank FROM near"))
QUERIES["w6_nearest_fill"] = (
    lambda s, d: nnfill.fill(gappy(s, d), views.centroids(s, d), 3, 0.02).select("hru", "t", "lower_bound", "upper_bound", "n_sources", "nn_filled"),
    with_views("centroids", f"{GAPPY}, got AS (SELECT g.hru, g.t, arg_min(o.lower_bound, n.rank) AS v FROM gappy g JOIN near n ON g.hru = n.hru JOIN gappy o ON o.hru = n.donor AND o.t = g.t WHERE g.lower_bound IS NULL AND o.lower_bound IS NOT NULL GROUP BY ALL)", "SELECT hru, t, coalesce(lower_bound, v) AS lower_bound, coalesce(lower_bound, v) + 1 AS upper_bound, n_sources, CAST(CASE WHEN lower_bound IS NULL AND v IS NOT NULL THEN 1 ELSE 0 END AS TINYINT) AS nn_filled FROM gappy LEFT JOIN got USING (hru, t)"),
)
CHAINED = """edges AS (SELECT g.hru, g.t, n.donor, n.rank, o.lower_bound IS NOT NULL AS seen FROM gappy g JOIN near n ON g.hru = n.hru JOIN gappy o ON o.hru = n.donor AND o.t = g.t WHERE g.lower_bound IS NULL AND (o.lower_bound IS NOT NULL OR n.donor < g.hru)),
    can AS (SELECT hru, t FROM edges WHERE seen UNION SELECT e.hru, e.t FROM edges e JOIN can c ON c.hru = e.donor AND c.t = e.t WHERE NOT e.seen),
    up AS (SELECT e.hru, e.t, arg_min(e.donor, e.rank) AS d, arg_min(e.seen, e.rank) AS s FROM edges e LEFT JOIN can c ON c.hru = e.donor AND c.t = e.t WHERE e.seen OR c.hru IS NOT NULL GROUP BY ALL),
    way AS (SELECT hru, t, d, s FROM up UNION ALL SELECT w.hru, w.t, u.d, u.s FROM way w JOIN up u ON u.hru = w.d AND u.t = w.t WHERE NOT w.s),
    got AS (SELECT w.hru, w.t, o.lower_bound AS v FROM way w JOIN gappy o ON o.hru = w.d AND o.t = w.t WHERE w.s)"""
QUERIES["w6_chained_fill"] = (
    lambda s, d: nnfill.fill(gappy(s, d), views.centroids(s, d), 3, 0.02, "chained"),
    with_views("centroids", f"{GAPPY}, {CHAINED}", "SELECT hru, t, coalesce(lower_bound, v) AS lower_bound, coalesce(lower_bound, v) + 1 AS upper_bound, n_sources, CAST(CASE WHEN lower_bound IS NULL AND v IS NOT NULL THEN 1 ELSE 0 END AS TINYINT) AS nn_filled FROM gappy LEFT JOIN got USING (hru, t)").replace("WITH ", "WITH RECURSIVE ", 1),
)
QUERIES["j2_attach"] = (lambda s, d: bounds.attach(views.one(s, d, "A"), views.meta(s, d)).select("hru", "t", r4(F.col("value")).alias("value"), "area_m2"), with_views("series meta", "", "SELECT hru, t, round(value, 4) AS value, area_m2 FROM series JOIN meta USING (hru) WHERE source = 'A'"))
QUERIES["j5_limits_by_month"] = (lambda s, d: rounded(views.one(s, d, "A").withColumn("month", F.month("t")).join(views.one(s, d, "A").groupBy("hru", F.month("t").alias("month")).agg(F.min("value").alias("low"), F.max("value").alias("high")), ["hru", "month"]).select("hru", "t", "low", "high"), "low", "high"), with_views("series", "a AS (SELECT *, month(t) AS mo FROM series WHERE source = 'A')", "SELECT hru, t, round(min(value) OVER w, 4) AS low, round(max(value) OVER w, 4) AS high FROM a WINDOW w AS (PARTITION BY hru, mo)"))
QUERIES["j10_merge_variables"] = (lambda s, d: rounded(bounds.merge_variables([views.one(s, d, x).withColumnRenamed("value", x.lower()) for x in "ABC"]), "a", "b", "c"), with_views("series", "", "SELECT hru, t, round(max(value) FILTER (source = 'A'), 4) AS a, round(max(value) FILTER (source = 'B'), 4) AS b, round(max(value) FILTER (source = 'C'), 4) AS c FROM series GROUP BY ALL"))
QUERIES["a20_monthly_mean"] = (lambda s, d: rounded(diagnostics.monthly_mean(views.daily(s, d), ["source", "hru"]), "value"), with_views("daily", "", "SELECT source, hru, CAST(date_trunc('month', t) AS DATE) AS t, round(avg(value), 4) AS value FROM daily GROUP BY ALL"))
