"""Snow water equivalent: daily bounds in inches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.functions.masks import in_scope
from catchment.functions.timeaxis import day_floor, in_period, labels as calendar
from catchment.functions.units import mm_to_inches
from catchment.operators.bounds import bounds_on_calendar
from catchment.operators.nnfill import fill, nearest
from catchment.plans.yearly import run_years, stitch
from catchment.sources.specs import SHIMS, catalog, shims_by
from catchment.sources.tables import cut


def scoped(hrus: DataFrame, labels: list[str], token: str | None) -> list[str]:
    """Labels whose source may be used for the fabric's region."""
    open_ = {r["source"] for r in in_scope(catalog(hrus.sparkSession), token).select("source").distinct().collect()}
    shims = shims_by("label", SHIMS["snow_water_equivalent"])
    return [x for x in labels if shims[x].source in open_]


def build(sources: dict[str, DataFrame], hrus: DataFrame, period: tuple[dt.date, dt.date], token: str | None = None, centroids: DataFrame | None = None, donors: str = "observed") -> DataFrame:
    """One plan for all years. A source without data in a year counts as absent there; a year without any raises."""
    shims = shims_by("label", SHIMS["snow_water_equivalent"])
    parts = []
    for label in scoped(hrus, list(sources), token):
        rows = sources[label].where(in_period(F.col("t"), *period)).select("hru", day_floor(F.col("t")).alias("t"), mm_to_inches(shims[label].convert(F.col("value"), F.col("t"))).alias("value"))
        parts.append(rows)
    out = bounds_on_calendar(parts, hrus, calendar(*period, "day"))
    return fill(out, centroids, donors=donors) if centroids is not None else out


def build_years(spark: SparkSession, sources: dict[str, DataFrame], hrus: DataFrame, years: Iterable[int], path: str, token: str | None = None, centroids: DataFrame | None = None, donors: str = "observed", inputs: DataFrame | None = None) -> DataFrame:
    """The same year by year: each year is written once, with the sources that have data in it, and all are put together.

    A run that broke off goes on where it stopped, and with ``inputs`` (year, modified) years
    older than their inputs are redone. A year without any source raises, and so does a
    request that leaves no source in scope.
    """
    labels = scoped(hrus, list(sources), token)
    if not labels:
        raise ValueError(f"none of {sorted(sources)} may be used for {token}")

    if centroids is not None and "donor" not in centroids.columns:
        centroids = cut(nearest(hrus.select("hru"), centroids, 10, 1.0))  # neighbours are the same in all years

    def one(year: int) -> DataFrame:
        period = (dt.date(year, 1, 1), dt.date(year, 12, 31))
        there = {x: sources[x] for x in labels if not sources[x].where(in_period(F.col("t"), *period)).isEmpty()}
        if not there:
            raise ValueError(f"no source at all in {year}")
        return build(there, hrus, period, token, centroids, donors)

    run_years(spark, years, one, path, inputs)
    return stitch(spark, path, years)


def check_years(bounds: DataFrame) -> None:
    empty = bounds.groupBy(F.year("t").alias("year")).agg(F.max("n_sources").alias("n")).where("n = 0").take(5)
    if empty:
        raise ValueError(f"no source at all in {[r['year'] for r in empty]}")
