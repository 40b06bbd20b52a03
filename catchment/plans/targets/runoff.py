"""Runoff: monthly bounds in cubic feet per second."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.functions.timeaxis import in_period, labels, month_start
from catchment.functions.units import mm_to_cfs
from catchment.operators.bounds import bounds_on_calendar
from catchment.operators.nnfill import fill
from catchment.sources.specs import SHIMS, shims_by


def monthly(series: DataFrame, label: str, target: str, period: tuple[dt.date, dt.date]) -> DataFrame:
    """One source's rows in the period, in the target's common unit, at month starts."""
    shim = shims_by("label", SHIMS[target])[label]
    rows = series.where(in_period(F.col("t"), *period))
    return rows.select("hru", month_start(F.col("t")).alias("t"), shim.convert(F.col("value"), F.col("t")).alias("value"))


def build(sources: dict[str, DataFrame], meta: DataFrame, period: tuple[dt.date, dt.date], centroids: DataFrame | None = None, donors: str = "observed") -> DataFrame:
    """(hru, t, lower_bound, upper_bound, n_sources) from series by label; filled from neighbours if centroids are given."""
    parts = []
    for label, series in sources.items():
        rows = monthly(series, label, "runoff", period).join(meta.select("hru", "area_m2"), "hru")
        parts.append(rows.select("hru", "t", mm_to_cfs(F.col("value"), F.col("t"), F.col("area_m2")).alias("value")))
    out = bounds_on_calendar(parts, meta, labels(*period, "month"))
    return fill(out, centroids, donors=donors) if centroids is not None else out
