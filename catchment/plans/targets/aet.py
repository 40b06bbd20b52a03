"""Actual evapotranspiration: monthly bounds in inches per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.functions.timeaxis import labels
from catchment.functions.units import mm_to_inches_per_day
from catchment.operators.bounds import bounds_on_calendar
from catchment.operators.nnfill import fill
from catchment.operators.temporal import composites_to_monthly
from catchment.plans.targets.runoff import monthly


def build(sources: dict[str, DataFrame], hrus: DataFrame, period: tuple[dt.date, dt.date], composites: str = "mod16", centroids: DataFrame | None = None, donors: str = "observed") -> DataFrame:
    """Composite sources go to calendar months before the period is cut, so that its edges are whole."""
    parts = []
    for label, series in sources.items():
        rows = composites_to_monthly(series, ["hru"]) if label == composites else series
        mm = monthly(rows, label, "aet", period)
        parts.append(mm.select("hru", "t", mm_to_inches_per_day(F.col("value"), F.col("t")).alias("value")))
    out = bounds_on_calendar(parts, hrus, labels(*period, "month"))
    return fill(out, centroids, donors=donors) if centroids is not None else out
