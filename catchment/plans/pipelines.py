"""End-to-end plans: zonal aggregation of a source, and consolidation of raw grids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.functions.masks import et_fill_by_tile
from catchment.operators import raster, temporal, zonal
from catchment.operators.quality import drift_summary
from catchment.sources.archives import snow_headers, snow_pixels
from catchment.sources.snow_source import register
from catchment.sources.specs import SourceSpec
from catchment.sources.tables import cut


def aggregate_source(grid: DataFrame, weights: DataFrame, spec: SourceSpec, time: str = "t", cell: tuple[str, ...] = ("iy", "ix")) -> DataFrame:
    """Pixel hook, weighted statistic of all variables in one pass, polygon hook."""
    pixels = grid.transform(spec.before) if spec.before else grid
    out = zonal.aggregate(pixels, weights, list(spec.variables), spec.stat, time, cell)
    return out.transform(spec.after) if spec.after else out


def to_long(wide: DataFrame, source: str, variables: list[str], time: str = "t") -> DataFrame:
    """(source, var, hru, t, value) from one column per variable."""
    return wide.unpivot(["hru", time], variables, "var", "value").withColumn("source", F.lit(source)).select("source", "var", "hru", time, "value")


def hourly_archive(hourly: DataFrame, kinds: dict[str, str], by: list[str], per_year: bool = False) -> tuple[DataFrame, DataFrame]:
    """(daily, monthly) of hourly variables (var, ts, value): accumulations are summed, states averaged."""
    daily = None
    for kind in temporal.KINDS:
        some = hourly.where(F.col("var").isin([v for v, k in kinds.items() if k == kind]))
        one = temporal.hourly_to_daily(some, [*by, "var"], per_year=per_year) if kind == "sum" else temporal.hourly_mean(some, [*by, "var"])
        daily = one if daily is None else daily.unionByName(one)
    monthly = None
    for kind in temporal.KINDS:
        one = temporal.daily_to_monthly(daily.where(F.col("var").isin([v for v, k in kinds.items() if k == kind])), [*by, "var"], kind)
        monthly = one if monthly is None else monthly.unionByName(one)
    return daily, monthly


def et_tiles(pixels: DataFrame, grid: tuple, tile: list[str]) -> DataFrame:
    """Evapotranspiration tiles: fill by tile, first tile on shared edges, average onto a fixed grid."""
    clean = et_fill_by_tile(pixels, "value", tile)
    return raster.sinusoidal_to_grid(raster.mosaic(clean, ["t", "x", "y"], tile[0]), grid, "average", ["t"])


def et_tiles_by_overlap(pixels: DataFrame, source: tuple[float, float, float, float], grid: tuple, tile: list[str]) -> DataFrame:
    """The same for pixels numbered (iy, ix) on one sinusoidal grid, averaged by the area that they share with each cell.

    The weights do not depend on time: they are made once for all days and tiles.
    """
    clean = raster.mosaic(et_fill_by_tile(pixels, "value", tile), ["t", "iy", "ix"], tile[0])
    return raster.average_by_weights(clean, raster.sinusoidal_weights(pixels, source, grid), ["t"])


def snow_archives(files: DataFrame, targets: DataFrame, day: str = r"(\d{8})") -> DataFrame:
    """Daily archives (path, content) onto the target points (x, y): checked headers, decoded pixels, a lookup made once.

    The day is the first group of ``day`` in the path, as yyyymmdd. The grid is that of the
    first day; archives that differ from it by more than half a pixel or in shape raise.
    """
    date = F.to_date(F.regexp_extract("path", day, 1), "yyyyMMdd")
    heads = cut(snow_headers(files).withColumn("day", date))  # read three times below
    g = heads.orderBy("day").first()
    if g is None:
        raise FileNotFoundError("no snow archives")
    drift_summary(heads, half_pixel=g["dx"] / 2)
    lookup = raster.nearest_lookup(targets, g["min_x"], g["max_y"], g["dx"], g["dy"], g["columns"], g["rows"])
    pixels = snow_pixels(files).select(date.alias("t"), "iy", "ix", "value")
    return raster.resample(pixels, lookup)


def snow_source(spark: SparkSession, path: str, targets: DataFrame, first: dt.date, last: dt.date, pattern: str = r"(\d{8}).*\.tar$", days: int = 8) -> DataFrame:
    """The same from a folder of archives, for the days from ``first`` to ``last``.

    Headers are read without their grids, grids are inflated once, and archives of other days are not opened.
    """
    register(spark)
    rows = lambda mode: spark.read.format("snow_archives").options(pattern=pattern, mode=mode, days=days).load(path).where(F.col("t").between(first, last))
    heads = cut(rows("headers"))
    g = heads.orderBy("t", "path").first()
    if g is None:
        raise FileNotFoundError("no snow archives")
    drift_summary(heads.withColumn("day", F.col("t")), half_pixel=g["dx"] / 2)
    lookup = raster.nearest_lookup(targets, g["min_x"], g["max_y"], g["dx"], g["dy"], g["columns"], g["rows"])
    return raster.resample(rows("pixels"), lookup)
