"""Recharge: annual bounds of series scaled to a reference window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.functions.timeaxis import in_period, labels
from catchment.operators.bounds import bounds_on_calendar
from catchment.operators.nnfill import fill
from catchment.operators.normalize import normalize
from catchment.operators.temporal import annual
from catchment.sources.specs import SHIMS, shims_by


def build(sources: dict[str, DataFrame], hrus: DataFrame, period: tuple[dt.date, dt.date], window: tuple[dt.date, dt.date] | None = None, centroids: DataFrame | None = None, donors: str = "observed") -> DataFrame:
    """Reads the union of period and window; limits come from the window (the period by default)."""
    window = window or period
    shims = shims_by("label", SHIMS["recharge"])
    parts = []
    for label, series in sources.items():
        t = F.col("t")
        rows = series.where(in_period(t, *period) | in_period(t, *window))
        mm = rows.select("hru", "t", shims[label].convert(F.col("value"), t).alias("value"))
        scaled = normalize(annual(mm, ["hru"]), ["hru"], window=window)
        parts.append(scaled.where(in_period(t, *period)))
    out = bounds_on_calendar(parts, hrus, labels(*period, "year"))
    return fill(out, centroids, donors=donors) if centroids is not None else out
