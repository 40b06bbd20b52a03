"""Grids in other systems than the polygons': projected cells, sinusoidal pixels, kept weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchment.functions.projections import _E, _E2, A, ALBERS, SPHERE, _albers
from catchment.operators import cutting, raster, zonal
from catchment.plans import pipelines, runs, views
from catchment.plans.queries_space import r4, rounded
from catchment.plans.views import with_views
from catchment.plans.weightstore import WeightStore, by_place
from catchment.sources.specs import SourceSpec
from catchment.sources.tables import scratch

QUERIES: dict = {}


def positive(u: str, v: str) -> str:
    """SQL for the mean of max(line, 0) along a line from u to v."""
    hi, lo = f"greatest({u}, {v})", f"least({u}, {v})"
    return f"(CASE WHEN {lo} >= 0 THEN ({u} + {v}) / 2 WHEN {hi} <= 0 THEN 0 ELSE {hi} * {hi} / (2 * ({hi} - {lo})) END)"


def _albers_sql(lon: str, lat: str) -> tuple[str, str]:
    n, c, rho0 = _albers(ALBERS)
    s = f"sin(radians({lat}))"
    q = f"({1 - _E2!r}::DOUBLE * ({s} / (1 - {_E2!r}::DOUBLE * {s} * {s}) - ln((1 - {_E!r}::DOUBLE * {s}) / (1 + {_E!r}::DOUBLE * {s})) / (2 * {_E!r}::DOUBLE)))"
    rho, theta = f"({A!r}::DOUBLE * sqrt({c!r}::DOUBLE - {n!r}::DOUBLE * {q}) / {n!r}::DOUBLE)", f"({n!r}::DOUBLE * radians({lon} - {ALBERS['lon0']!r}::DOUBLE))"
    return f"{rho} * sin({theta})", f"{rho0!r}::DOUBLE - {rho} * cos({theta})"


#: The other way round than the operator: edges of the cell within the box, whose sides are upright.
_X, _Y = _albers_sql("(-140 + i * dx)", "(10 + j * dx)")
SHARES = f"""nodes AS (SELECT i, j, {_X} AS x, {_Y} AS y FROM (SELECT unnest(range(nx + 1)) AS i, dx, ny FROM lonlat_grid), (SELECT unnest(range(ny + 1)) AS j FROM lonlat_grid)),
    edges AS (SELECT a.i, a.j, b.i AS i2, b.j AS j2, a.x AS xa, a.y AS ya, b.x AS xb, b.y AS yb FROM nodes a JOIN nodes b ON (b.i = a.i + 1 AND b.j = a.j) OR (b.i = a.i AND b.j = a.j + 1)),
    turns AS (SELECT i AS ix, j AS iy, xa, ya, xb, yb FROM edges WHERE i2 > i UNION ALL SELECT i - 1, j, xa, ya, xb, yb FROM edges WHERE j2 > j
        UNION ALL SELECT i, j - 1, xb, yb, xa, ya FROM edges WHERE i2 > i UNION ALL SELECT i, j, xb, yb, xa, ya FROM edges WHERE j2 > j),
    span AS (SELECT ix, iy, min(xa) AS w, max(xa) AS e, min(ya) AS s, max(ya) AS n FROM turns, lonlat_grid WHERE ix >= 0 AND iy >= 0 AND ix < nx AND iy < ny GROUP BY ix, iy),
    near AS (SELECT ix, iy, hru, x0, y0, side FROM span JOIN albers_boxes ON w < x0 + side AND e > x0 AND s < y0 + side AND n > y0),
    cut AS (SELECT ix, iy, hru, side, greatest(y0, least(y0 + side, ya)) AS p, greatest(y0, least(y0 + side, yb)) AS q, xa - x0 AS xa, ya, xb - x0 AS xb, yb FROM near JOIN turns USING (ix, iy) WHERE ya <> yb),
    ends AS (SELECT ix, iy, hru, side, q - p AS h, xa + (p - ya) * (xb - xa) / (yb - ya) AS u, xa + (q - ya) * (xb - xa) / (yb - ya) AS v FROM cut),
    shares AS (SELECT CAST(iy AS INT) AS iy, CAST(ix AS INT) AS ix, hru, abs(sum(h * ({positive('u', 'v')} - {positive('(u - side)', '(v - side)')}))) / (side * side) AS share FROM ends GROUP BY iy, ix, hru, side)"""


def projected(spark, d):
    boxes = views.albers_boxes(spark, d)
    return cutting.cell_weights(boxes, cutting.lonlat_cells(spark, *views.lonlat_grid(spark, d), near=boxes)).join(boxes.select("hru", "side"), "hru")


QUERIES["g5_projected_weights"] = (
    lambda s, d: projected(s, d).withColumn("share", F.col("area") / (F.col("side") * F.col("side"))).where("share > 1e-9").select("iy", "ix", "hru", r4(F.col("share")).alias("share")),
    with_views("box_rows albers_boxes lonlat_grid", SHARES, "SELECT iy, ix, hru, round(share, 4) AS share FROM shares WHERE share > 1e-9"),
)
# The cells of a polygon make up its area.
QUERIES["g5_projected_totals"] = (
    lambda s, d: projected(s, d).groupBy("hru", "side").agg(F.sum("area").alias("a"), F.count_if(F.col("area") > 1e-9 * F.col("side") * F.col("side")).alias("n_cells")).select("hru", "n_cells", r4(F.col("a") / 1e6).alias("km2")),
    with_views("box_rows albers_boxes lonlat_grid", SHARES, "SELECT hru, count(*) FILTER (WHERE share > 1e-9) AS n_cells, round(any_value(side) * any_value(side) / 1e6, 4) AS km2 FROM shares JOIN albers_boxes USING (hru) GROUP BY hru"),
)


def projected_mean(spark, d):
    _, _, _, _, nx, ny = views.lonlat_grid(spark, d)
    cells = views.grid(spark, d).select("t", (F.floor(F.col("cell") * 7919 / nx) % ny).cast("int").alias("iy"), (F.col("cell") * 7919 % nx).cast("int").alias("ix"), "value")
    values = cells.groupBy("t", "iy", "ix").agg(F.avg("value").alias("value"))
    return rounded(zonal.aggregate(values, projected(spark, d).select("iy", "ix", "hru", "area"), ["value"], "masked_mean"), "value")


QUERIES["e1_projected_mean"] = (
    projected_mean,
    with_views("pixels grid box_rows albers_boxes lonlat_grid", f"{SHARES}, v AS (SELECT t, CAST(floor(cell * 7919 / nx) % ny AS INT) AS iy, CAST(cell * 7919 % nx AS INT) AS ix, avg(value) AS value FROM grid, lonlat_grid GROUP BY ALL)",
    "SELECT hru, t, round(sum(share * value) / sum(CASE WHEN value IS NOT NULL THEN share END), 4) AS value FROM v JOIN shares USING (iy, ix) GROUP BY ALL"),
)


def reuse(spark, d):
    """Batches wanted and recomputed: at first, again, with one polygon moved within its square, and on another grid."""
    boxes = views.albers_boxes(spark, d)
    u = views.box_unit(spark, d)
    x0, y0, dx, dy, nx, ny = views.lonlat_grid(spark, d)
    moved = F.col("hru") == F.lit(boxes.agg(F.max("hru")).first()[0])
    point = lambda p: F.struct((p["x"] + F.when(moved, 0.05 * u).otherwise(0.0)).alias("x"), p["y"].alias("y"))
    other = boxes.withColumn("rings", F.transform("rings", lambda r: F.transform(r, point)))
    store = WeightStore(spark, f"{scratch(spark)}/weights")
    rows = []
    for step, (fabric, n) in enumerate(((boxes, nx), (boxes, nx), (other, nx), (boxes, nx + 1))):
        cut = lambda some, n=n: cutting.cell_weights(some, cutting.lonlat_cells(spark, x0, y0, dx, dy, n, ny, near=some), 12 * u)
        placed = by_place(fabric, 4 * u, F.col("x0"), F.col("y0"))
        kept, counts = store.weights(placed.select("hru", "rings", "batch"), f"{x0}/{y0}/{dx}/{dy}/{n}/{ny}", cut)
        total = kept.agg(F.sum("area")).first()[0] / u / u
        rows.append((step, counts["wanted"], counts["recomputed"], counts["polygons"], float(total)))
    return rounded(spark.createDataFrame(rows, "step int, n_batches long, n_recomputed long, n_polygons long, total double"), "total")


QUERIES["g6_weight_reuse"] = (
    reuse,
    with_views("box_rows albers_boxes", "b AS (SELECT hru, floor(x0 / (4 * least(3e6 / rows, 3.3e5))) AS bx, floor(y0 / (4 * least(3e6 / rows, 3.3e5))) AS b_y FROM albers_boxes, box_rows), n AS (SELECT bx, b_y, count(*) AS n, max(hru) = (SELECT max(hru) FROM b) AS last FROM b GROUP BY ALL), c AS (SELECT count(*) AS batches, sum(n) AS polygons, sum(CASE WHEN last THEN n END) AS moved FROM n)",
    """SELECT CAST(step AS INT) AS step, batches AS n_batches, CAST(CASE step WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE batches END AS BIGINT) AS n_recomputed, CAST(CASE step WHEN 1 THEN 0 WHEN 2 THEN moved ELSE polygons END AS BIGINT) AS n_polygons,
    round(CAST(1.7::DOUBLE * 1.7::DOUBLE * polygons AS DOUBLE), 4) AS total FROM c, (SELECT unnest(range(4)) AS step)"""),
)


def sinusoidal(spark, d):
    """Pixel grid (x0, y1, dx, dy) in metres and target grid in degrees; the target's cells are finer than the pixels."""
    n = views.box_rows(spark, d)
    return (-8.4e6, 5e6, 3e6 / n, 3e6 / n), (-110.0, 45.0, 20.0 / n, 20.0 / n, -(-50 * n // 20), -(-27 * n // 20))


R = f"{SPHERE!r}::DOUBLE"


def _swept_sql(lon: str) -> str:
    """All longitudes of this grid are west of 0, so the strip is turned around."""
    a, at = f"({R} * -{lon})", lambda x: f"least(greatest(acos(least(greatest(({x}) / ({R} * -{lon}), -1), 1)), p), r)"
    lo, hi = at("-l - u"), at("-l")
    return f"(u * (r - p) - (u * ({hi} - p) + {a} * (sin({lo}) - sin({hi})) + (l + u) * ({lo} - {hi})))"


AREAS = f"""g AS (SELECT rows, 3e6 / rows AS u, 20.0::DOUBLE / rows AS d, (50 * rows + 19) // 20 AS nx, (27 * rows + 19) // 20 AS ny FROM box_rows),
    px AS (SELECT iy, ix, -8.4e6 + ix * u AS l, u, (5e6 - iy * u) / {R} AS n, (5e6 - (iy + 1) * u) / {R} AS s FROM (SELECT unnest(range(rows)) AS iy, u FROM g), (SELECT unnest(range(12)) AS ix)),
    ys AS (SELECT px.*, ty, greatest(s, radians(45 - (ty + 1) * d)) AS p, least(n, radians(45 - ty * d)) AS r FROM px, (SELECT unnest(range(ny)) AS ty, d FROM g)),
    xs AS (SELECT ys.*, tx, radians(-110 + tx * d) AS a, radians(-110 + (tx + 1) * d) AS b FROM ys, (SELECT unnest(range(nx)) AS tx, d FROM g) WHERE r > p AND least(l / ({R} * cos(r)), l / ({R} * cos(p))) < radians(-110 + (tx + 1) * d) AND greatest((l + u) / ({R} * cos(r)), (l + u) / ({R} * cos(p))) > radians(-110 + tx * d)),
    areas AS (SELECT iy, ix, CAST(ty AS INT) AS ty, CAST(tx AS INT) AS tx, {R} * ({_swept_sql('b')} - {_swept_sql('a')}) AS area, u FROM xs)"""
TILE_VALUES = "v AS (SELECT CAST(floor(cell / 12) % rows AS INT) AS iy, CAST(cell % 12 AS INT) AS ix, t, max(value) AS value FROM pixels, box_rows GROUP BY ALL)"


def g10_sinusoidal(spark, d):
    source, grid = sinusoidal(spark, d)
    values = views.gridded(spark, d, F.max)
    return rounded(raster.average_by_weights(values, raster.sinusoidal_weights(values, source, grid), ["t"]), "value")


QUERIES["g10_sinusoidal_overlap"] = (
    g10_sinusoidal,
    with_views("pixels box_rows", f"{AREAS}, {TILE_VALUES}", "SELECT t, ty, tx, round(sum(area * value) / sum(area), 4) AS value FROM v JOIN areas USING (iy, ix) WHERE area > 1e-9 * u * u AND value IS NOT NULL GROUP BY ALL"),
)


def e8_overlap(spark, d):
    """Every part as a pixel of one of two tiles that share all of them; the first tile that has a pixel wins, whatever it holds."""
    source, grid = sinusoidal(spark, d)
    n = views.box_rows(spark, d)
    pixels = views.pixels(spark, d).select((F.col("cell") % 2).cast("string").alias("tile"), "t", F.pmod(F.floor(F.col("cell") / 24), F.lit(n)).cast("int").alias("iy"), (F.floor(F.col("cell") / 2) % 12).cast("int").alias("ix"), F.when(F.col("value") > 45, 32761.0).otherwise(F.col("value")).alias("value"))
    once = pixels.groupBy("tile", "t", "iy", "ix").agg(F.max("value").alias("value"))
    return rounded(pipelines.et_tiles_by_overlap(once, source, grid, ["tile", "t"]), "value")


QUERIES["e8_et_tiles_by_overlap"] = (
    e8_overlap,
    with_views("pixels box_rows", f"""{AREAS}, o AS (SELECT CAST(cell % 2 AS INT) AS tile, t, CAST(floor(cell / 24) % rows AS INT) AS iy, CAST(floor(cell / 2) % 12 AS INT) AS ix, max(value) AS value FROM pixels, box_rows GROUP BY ALL),
    m AS (SELECT t, iy, ix, CASE WHEN value <= 45 THEN value END AS value FROM o QUALIFY row_number() OVER (PARTITION BY t, iy, ix ORDER BY tile) = 1)""",
    "SELECT t, ty, tx, round(sum(area * value) / sum(area), 4) AS value FROM m JOIN areas USING (iy, ix) WHERE area > 1e-9 * u * u AND value IS NOT NULL GROUP BY ALL"),
)


def regions(spark, d):
    """Yearly grid files of a western and an eastern region, run for every other year first and then for all of them."""
    x0, y0, dx, dy, nx, ny = views.lonlat_grid(spark, d)
    cells = views.grid(spark, d).select("t", (F.floor(F.col("cell") * 7919 / nx) % ny).cast("int").alias("iy"), (F.col("cell") * 7919 % nx).cast("int").alias("ix"), "value")
    values = cells.groupBy("t", "iy", "ix").agg(F.avg("value").alias("value"))
    path, west = scratch(spark), F.col("ix") < nx // 3
    boxes = views.albers_boxes(spark, d)
    grid = cutting.lonlat_cells(spark, x0, y0, dx, dy, nx, ny, near=boxes)
    landed = {}
    for name, part in (("west", west), ("east", ~west)):
        values.where(part).repartition("t").write.parquet(f"{path}/grids/{name}")
        landed[name] = runs.Landed(f"{path}/grids/{name}", "t date, iy int, ix int, value double", grid.where(part), f"{name}/{dx}")
    spec = SourceSpec("demo", ("value",), "masked_mean")
    ends = values.agg(F.min(F.year("t")), F.max(F.year("t"))).first()
    years = range(ends[0], ends[1] + 1)
    for some in (years[::2], years):
        out = runs.run_regions(spark, spec, landed, boxes, some, f"{path}/out", f"{path}/weights", batch_side=4 * views.box_unit(spark, d))
    return rounded(out.select("region", "hru", "t", "value"), "value")


QUERIES["x5_regions_by_year"] = (
    regions,
    with_views("pixels grid box_rows albers_boxes lonlat_grid", f"{SHARES}, v AS (SELECT t, CAST(floor(cell * 7919 / nx) % ny AS INT) AS iy, CAST(cell * 7919 % nx AS INT) AS ix, avg(value) AS value, any_value(nx) AS nx FROM grid, lonlat_grid GROUP BY ALL)",
    "SELECT CASE WHEN ix < nx // 3 THEN 'west' ELSE 'east' END AS region, hru, t, round(sum(share * value) / sum(CASE WHEN value IS NOT NULL THEN share END), 4) AS value FROM v JOIN shares USING (iy, ix) WHERE share > 1e-9 GROUP BY ALL"),
)
