"""Dates and keys that are part of file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catchment.functions.timeaxis import from_day_of_year


def _int(name: Column, pattern: str, group: int = 1) -> Column:
    found = F.regexp_extract(name, pattern, group)
    return F.when(found != "", found.cast("int"))


def acquisition_date(name: Column) -> Column:
    """"...A2005017..." to 17 January 2005."""
    return from_day_of_year(_int(name, r"A(\d{4})\d{3}"), _int(name, r"A\d{4}(\d{3})"))


def year_month(name: Column) -> Column:
    """"....200501...." to 1 January 2005."""
    return F.make_date(_int(name, r"[._](\d{4})\d{2}[._]"), _int(name, r"[._]\d{4}(\d{2})[._]"), F.lit(1))


def archive_date(name: Column) -> Column:
    """"SNODAS_20050117.tar" to 17 January 2005."""
    return F.make_date(_int(name, r"_(\d{4})\d{4}\."), _int(name, r"_\d{4}(\d{2})\d{2}\."), _int(name, r"_\d{6}(\d{2})\."))


def water_years(name: Column) -> tuple[Column, Column]:
    """"WY1999_00" to (1999, 2000): the second year rolls over the century."""
    first, last = _int(name, r"WY(\d{4})_\d{2}"), _int(name, r"WY\d{4}_(\d{2})")
    century = F.floor(first / 100).cast("int") * 100
    return first, (century + last + F.when(last < F.pmod(first, F.lit(100)), 100).otherwise(0)).cast("int")


def trailing_year(name: Column) -> Column:
    """"name_2005.tif" to 2005."""
    return _int(name, r"_(\d{4})\.[A-Za-z0-9]+$")


def aggregated_year(name: Column) -> Column:
    """"key_2005_agg.ext" to 2005."""
    return _int(name, r"_(\d{4})_agg\b")
