"""Scaling each series to 0..1 between its limits.

Limits are one small row per series (and calendar month), so they are aggregated and joined
back; no window gathers a series in one task. NULLs stay NULL, an empty range gives NULL,
values outside the reference window may lie beyond 0 and 1.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.functions.missing import unit_range
from catchment.functions.timeaxis import in_period


def normalize(df: DataFrame, by: list[str], value: str = "value", t: str = "t", window: tuple[dt.date, dt.date] | None = None, monthly: bool = False) -> DataFrame:
    """``df`` with ``value`` scaled; limits from the rows in ``window`` (all by default), per calendar month if ``monthly``."""
    keyed = df.withColumn("__month", F.month(t)) if monthly else df
    keys = [*by, "__month"] if monthly else by
    base = keyed.where(in_period(F.col(t), *window)) if window else keyed
    limits = base.groupBy(*keys).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    out = keyed.join(limits, keys, "left").withColumn(value, unit_range(F.col(value), F.col("__low"), F.col("__high")))
    return out.select(*df.columns)
