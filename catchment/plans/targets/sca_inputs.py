"""Inputs for snow-covered area: gated fraction and coverage. How bounds follow from them is not defined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.functions.masks import quality_gate
from catchment.functions.units import percent_to_fraction
from catchment.operators.zonal import aggregate


def build(grid: DataFrame, weights: DataFrame, snow: str = "snow", index: str = "ci", cell: tuple[str, ...] = ("iy", "ix")) -> DataFrame:
    """(hru, t, snow_fraction, valid_area_fraction); the gate runs on pixels, before the average."""
    out = aggregate(quality_gate(grid, snow, index), weights, [snow, "valid_mask"], "masked_mean", cell=cell)
    return out.select("hru", "t", percent_to_fraction(F.col(snow)).alias("snow_fraction"), F.col("valid_mask").alias("valid_area_fraction"))
