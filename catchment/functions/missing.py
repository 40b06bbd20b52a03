"""Missing values are NULL, never NaN: helpers that keep it so."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """NaN becomes NULL; to be applied where data comes in."""
    return F.when(~F.isnan(c), c)


def sum_or_zero(c: Column) -> Column:
    """Aggregate: sum of what is there, 0 if nothing is."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def strict_sum(c: Column) -> Column:
    """Aggregate: sum, NULL as soon as one value is missing."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0 or missing."""
    return F.when(b != 0, a / F.when(b != 0, b))


def unit_range(v: Column, low: Column, high: Column) -> Column:
    """(v - low) / (high - low); NULL for an empty range. Values beyond the limits stay beyond 0 and 1."""
    return F.when(high > low, (v - low) / F.when(high > low, high - low))
