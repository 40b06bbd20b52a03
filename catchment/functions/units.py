"""Unit conversions as column expressions. A missing input gives a missing output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catchment.functions.timeaxis import days_in_month

# Cubic feet in a cubic metre, millimetres in an inch, seconds in a day.
CUBIC_FEET = 35.3146667
MM_PER_INCH = 25.4
DAY_S = 86400


def metres_to_mm(v: Column) -> Column:
    """Depth in metres (runoff, recharge, snow water) to mm."""
    return v * 1000


def three_hourly_mean_to_mm(v: Column, t: Column) -> Column:
    """Mean 3-hour accumulation of a month to the month's total in mm."""
    return v * 8 * days_in_month(t)


def same(v: Column) -> Column:
    """Already in the common unit."""
    return v


def mm_to_cfs(v: Column, t: Column, area_m2: Column) -> Column:
    """mm per month over an area to cubic feet per second."""
    return v / 1000 / days_in_month(t) * area_m2 * CUBIC_FEET / DAY_S


def mm_to_inches_per_day(v: Column, t: Column) -> Column:
    return v / MM_PER_INCH / days_in_month(t)


def mm_to_inches(v: Column) -> Column:
    return v / MM_PER_INCH


def rate_to_mm_per_month(v: Column, t: Column) -> Column:
    """kg m-2 s-1 to mm per month."""
    return v * days_in_month(t) * DAY_S


def percent_to_fraction(v: Column) -> Column:
    return v / 100


def water_content(v: Column, source: Column, mass_sources: list[str]) -> Column:
    """kg m-2 in a 10 cm layer to a volumetric fraction for ``mass_sources``; others pass."""
    return F.when(source.isin(*mass_sources), v / 100).otherwise(v)


def total_of(a: Column, b: Column) -> Column:
    """Sum of two variables, NULL if either is missing."""
    return a + b


def statistic(values: Column, at: int, size: int = 5) -> Column:
    """One of a fixed number of statistics in an array; another size raises."""
    return F.when(values.isNull(), None).when(F.size(values) == size, F.element_at(values, at)).otherwise(F.raise_error(F.concat(F.lit(f"expected {size} statistics, got "), F.size(values).cast("string"))))


def wrap_longitude(lon: Column) -> Column:
    """0..360 to -180..180."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def cell_centre(origin: Column, step: Column, index: Column) -> Column:
    """Centre of a cell from the grid's edge, its step (negative downwards) and the index."""
    return origin + step * (index + 0.5)


def bit_field(code: Column, first: int, width: int) -> Column:
    """``width`` bits of a quality code, from bit ``first`` up."""
    return F.shiftright(code, first).bitwiseAND(F.lit((1 << width) - 1))


def spread(low: Column, high: Column) -> Column:
    return high - low
