"""Soil moisture: monthly and annual bounds of scaled series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.functions.timeaxis import in_period, labels, month_start
from catchment.operators.bounds import bounds_on_calendar
from catchment.operators.nnfill import fill
from catchment.operators.normalize import normalize
from catchment.operators.temporal import annual


def build(sources: dict[str, DataFrame], hrus: DataFrame, period: tuple[dt.date, dt.date], window: tuple[dt.date, dt.date] | None = None, centroids: DataFrame | None = None, donors: str = "observed") -> tuple[DataFrame, DataFrame]:
    """(monthly, annual): monthly limits per calendar month, annual ones over the whole window; the window defaults to the period."""
    window = window or period
    by_month, by_year = [], []
    for series in sources.values():
        t = F.col("t")
        rows = series.where(in_period(t, *period) | in_period(t, *window)).select("hru", month_start(t).alias("t"), "value")
        by_month.append(normalize(rows, ["hru"], window=window, monthly=True).where(in_period(t, *period)))
        by_year.append(normalize(annual(rows, ["hru"], "mean"), ["hru"], window=window).where(in_period(t, *period)))
    out = bounds_on_calendar(by_month, hrus, labels(*period, "month")), bounds_on_calendar(by_year, hrus, labels(*period, "year"))
    return out if centroids is None else tuple(fill(b, centroids, donors=donors) for b in out)
